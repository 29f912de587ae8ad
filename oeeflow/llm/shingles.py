"""Word hashes and shingle sets of many texts at once (numpy over Arrow buffers).

A word is a run of bytes other than the six ASCII white-space bytes (the same runs as by code
point, since UTF-8 keeps those bytes to themselves); A-Z are lower-cased. Words and shingles are
known by 64-bit hashes. A text longer than ``CHUNK_BYTES`` is hashed block by block, a word that a
block's end cuts is carried on: besides the text only its hashes grow with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                                0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, size: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < size:
        have = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size + (size >> 2), base, np.uint64))])
        _powers[name] = have
    return have[:size]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _sums(part: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Polynomial hash, not yet mixed, of each run of bytes ``part[s:e]``."""
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power("up", int(_BASE), len(part) + 1)[:len(part)], out=total[1:])
    return (total[e] - total[s]) * _power("down", int(_INVERSE), len(part) + 1)[s]


def _long_text(part: np.ndarray, block: int) -> np.ndarray:
    """The word hashes of one text, ``block`` bytes at a time."""
    found, open_sum, open_size = [], 0, 0  # the word that reaches to the end of the last block
    for lo in range(0, len(part), block):
        here = part[lo:lo + block]
        inside = np.concatenate([[False], ~_SPACE[here], [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        s, e = turns[0::2], turns[1::2]
        sums = _sums(here, s, e)
        if open_size and len(s) and s[0] == 0:
            sums[0] = (open_sum + int(sums[0]) * pow(int(_BASE), open_size, 1 << 64)) % (1 << 64)
            open_size += int(e[0])
        elif open_size:
            found.append(np.array([open_sum], np.uint64))
            open_size = 0
        if len(s) and e[-1] == len(here):
            open_sum = int(sums[-1])
            if len(s) > 1 or s[0] > 0 or not open_size:
                open_size = int(e[-1] - s[-1])
            sums = sums[:-1]
        else:
            open_size = 0
        found.append(sums)
    if open_size:
        found.append(np.array([open_sum], np.uint64))
    return np.concatenate([mix(x) for x in found])


def word_hashes(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first, hashes, bounds) for runs of texts of about ``CHUNK_BYTES``: text ``first + i``
    has the word hashes ``hashes[bounds[i]:bounds[i + 1]]`` in order. A null text has none."""
    if texts.offset:  # a copy: casts and string functions of Arrow misread some views
        texts = texts.take(pa.array(range(len(texts)), pa.int64()))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        lo, hi = int(offsets[first]), int(offsets[stop])
        part, at = raw[lo:hi], offsets[first:stop + 1] - lo
        if len(part) > CHUNK_BYTES:  # one long text
            words = _long_text(part, CHUNK_BYTES)
            yield first, words, np.array([0, len(words)])
            first = stop
            continue
        inside = ~_SPACE[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edge = at[1:-1]
        edge = edge[(edge > 0) & (edge < len(part))]  # words do not run on into the next text
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        yield first, mix(_sums(part, s, e)), np.searchsorted(s, at)
        first = stop


def _windows(words: np.ndarray, size: int, block: int = 1 << 17) -> np.ndarray:
    """Hashes of all ``size``-word windows in order, worked out ``block`` windows at a time."""
    count = len(words) - size + 1
    out = np.zeros(count, np.uint64)
    for lo in range(0, count, block):
        here = out[lo:lo + block]
        for j in range(size):
            here += mix(words[lo + j:lo + j + len(here)] + np.uint64(j + 1)) * _STEP[j % len(_STEP)]
        here[:] = mix(here + np.uint64(size))
    return out


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word windows of one text, in order; of a shorter text its whole
    sequence as one, of no words none."""
    n = len(words)
    if n == 0:
        return words
    return _windows(words, min(n, size))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, words, at in word_hashes(texts):
        # all windows of the run of texts at once; those that span two texts are left out
        every = _windows(words, size) if len(words) >= size else words[:0]
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            yield np.unique(every[lo:hi - size + 1]) if hi - lo >= size else shingle_hashes(words[lo:hi], size)


def set_hash(members: np.ndarray) -> int:
    """Order-free 64-bit hash of a set, as a signed long."""
    with np.errstate(over="ignore"):
        h = mix(np.array([mix(members).sum(dtype=np.uint64) + np.uint64(len(members)) * _BASE], np.uint64))
    return int(h.view(np.int64)[0])
