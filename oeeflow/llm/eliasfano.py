"""Elias-Fano sequences in memory-mapped files: build, and successor search for many values."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

_ONE = np.uint64(1)
_63 = np.uint64(63)


def _or_into(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """``words[at] |= bits`` for rising ``at`` with repeats."""
    if len(at):
        begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        words[at[begins]] |= np.bitwise_or.reduceat(bits, begins)


_ONES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_M1, _M2, _M4 = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
#: Place of the r-th one of a byte, at 8 * byte + r.
_IN_BYTE = np.array([([i for i in range(8) if x >> i & 1] + [8] * 8)[:8] for x in range(256)], np.uint8).ravel()


def _select(bits: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th one (from 0) of each 64-bit word, which has that many."""
    x = bits - ((bits >> _ONE) & _M1)
    x = (x & _M2) + ((x >> np.uint64(2)) & _M2)
    upto = ((x + (x >> np.uint64(4))) & _M4) * _ONES  # byte i: ones of the bytes 0 to i
    rank = rank.astype(np.uint64)
    shift = np.bitwise_count((((rank * _ONES) | _HIGH) - upto) & _HIGH).astype(np.uint64) << np.uint64(3)
    rank -= ((upto << np.uint64(8)) >> shift) & np.uint64(255)
    byte = (bits >> shift) & np.uint64(255)
    return (shift + _IN_BYTE[(byte << np.uint64(3)) + rank]).astype(np.int64)


class EliasFano:
    """A rising sequence of n integers below ``universe``: the low bits of each packed side by side,
    the high parts in unary, and the count of ones before each word of the unary bits."""

    FIELDS = ("low", "high", "ones")

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.l, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        v = values.astype(np.uint64)
        n = len(v)
        l = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * l // 64 + 2, np.uint64)
        if l:
            part = v & np.uint64((1 << l) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, off = (at >> np.uint64(6)).astype(np.int64), at & _63
            _or_into(low, word, part << off)
            over = (off + np.uint64(l)) > np.uint64(64)
            _or_into(low, word[over] + 1, part[over] >> (np.uint64(64) - off[over]))
        at = (v >> np.uint64(l)) + np.arange(n, dtype=np.uint64)
        size = (int(at[-1]) if n else 0) + 2 + (universe >> l)
        high = np.zeros(size // 64 + 1, np.uint64)
        _or_into(high, (at >> np.uint64(6)).astype(np.int64), _ONE << (at & _63))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(n, l, low, high, ones)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero (from 0) of the unary bits."""
        before = self._zeros_before
        word = np.searchsorted(before, k, "right") - 1
        return word * 64 + _select(~self.high[word], k - before[word])

    def _bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and behind last index of the elements with high part h."""
        begin = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) + 1, 0)
        word = begin >> 6
        rest = ~self.high[np.minimum(word, len(self.high) - 1)] >> (begin & 63).astype(np.uint64)
        # the next zero is mostly in the same word
        end = begin + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        far = np.flatnonzero((rest == 0) | (word >= len(self.high)))
        if len(far):
            end[far] = self._zero(h[far])
        return begin - h, end - h

    @property
    def _zeros_before(self) -> np.ndarray:
        if not hasattr(self, "_zb"):
            self._zb = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        return self._zb

    def _low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.l)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & _63
        out = self.low[word] >> off
        out |= np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & _63), np.uint64(0))
        return out & np.uint64((1 << self.l) - 1)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first element not below x, whether it equals x); x below the universe."""
        x = x.astype(np.uint64)
        h = (x >> np.uint64(self.l)).astype(np.int64)
        lo, hi = self._bucket(h)
        end = hi.copy()
        target = x & np.uint64((1 << self.l) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):  # binary search among the elements with the same high part
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low_at(mid) < target[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        found = np.zeros(len(x), bool)
        k = np.flatnonzero(lo < end)
        found[k] = self._low_at(lo[k]) == target[k]
        return lo, found

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, whether it equals x) of the first element not below x among the elements lo to hi - 1."""
        x, h = x.astype(np.uint64), (x >> np.uint64(self.l)).astype(np.int64)
        # of the range, the elements with the same high part
        first, last = self._bucket(h)
        lo, end = np.clip(first, lo, hi), np.clip(last, lo, hi)
        hi, target = end.copy(), x & np.uint64((1 << self.l) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low_at(mid) < target[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        found = np.zeros(len(x), bool)
        k = np.flatnonzero(lo < end)
        found[k] = self._low_at(lo[k]) == target[k]
        return lo, found

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th elements, by select over the unary bits."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = _select(self.high[word], i - self.ones[word])
        return ((word * 64 + place - i).astype(np.uint64) << np.uint64(self.l)) | self._low_at(i)


# ------------------------------------------------------------------ level files

def _filesystem(path: str):
    from pyarrow import fs
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_level(folder: str, name: str, **parts) -> str:
    """One file with named arrays and Elias-Fano sequences. It gets its name when it is whole; a repeated
    task attempt puts the same bytes in its place. Returns the path."""
    flat: list[tuple[str, np.ndarray]] = []
    head: dict = {"arrays": [], "sequences": {}}
    for key, part in parts.items():
        if isinstance(part, EliasFano):
            head["sequences"][key] = [part.n, part.l]
            flat += [(f"{key}.{f}", getattr(part, f)) for f in EliasFano.FIELDS]
        else:
            flat.append((key, part))
    at = 0
    for key, array in flat:
        head["arrays"].append([key, array.dtype.str, len(array), at])
        at += -(-array.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    store, where = _filesystem(f"{folder}/{name}")
    part = f"{where}.{uuid.uuid4().hex}"
    store.create_dir(os.path.dirname(where), recursive=True)
    with store.open_output_stream(part) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for _, array in flat:
            out.write(np.ascontiguousarray(array).tobytes() + b"\0" * (-array.nbytes % 8))
    store.move(part, where)
    return f"{folder}/{name}"


def open_level(path: str) -> dict:
    """The parts of a level file, memory-mapped where the store is a file system of this machine
    (a shared mount is), else read into memory."""
    from pyarrow import fs
    store, where = _filesystem(path)
    if isinstance(store, fs.LocalFileSystem):
        raw = np.memmap(where, np.uint8, "r")
    else:
        with store.open_input_file(where) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8:8 + size].tobytes())
    arrays = {key: np.frombuffer(raw, kind, n, 8 + size + at) if n else np.zeros(0, kind) for key, kind, n, at in head["arrays"]}
    out = {k: v for k, v in arrays.items() if "." not in k}
    for key, (n, l) in head["sequences"].items():
        out[key] = EliasFano(n, l, *(arrays[f"{key}.{f}"] for f in EliasFano.FIELDS))
    return out
