"""Token ids of whole texts with a public tokenizer file, many texts at a time.

The tokenizer (lower-casing BPE with word ends) never looks across white space, so a text's ids
are the ids of its space-separated chunks, one after another. Chunks repeat, so each Python worker
keeps the ids of the chunks it has met in an Arrow table of bounded size. An unknown chunk that is
one plain word, perhaps with signs behind it, goes to the BPE model directly (that is what the
tokenizer does with such a word); every other chunk (digits, apostrophes, special-token strings,
other scripts) goes through the whole tokenizer by itself.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!#$%&()*+,./:;=?@\[\]^_`{}~\"-]*)")


class ChunkTokenizer:
    """Each text's ids are exactly what ``Tokenizer.encode(text, add_special_tokens=False)``
    gives. ``capacity`` and ``max_bytes`` (chunks and ids) bound the table of known chunks (it is
    emptied when full), never the texts."""

    def __init__(self, path: str, capacity: int = 300_000, max_bytes: int = 48 << 20):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.capacity, self.max_bytes = capacity, max_bytes
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs: dict[str, list[int]] = {"": []}
        # the byte alphabet of the model, asked of the tokenizer's own byte step
        self.alphabet = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self._empty()

    def _empty(self) -> None:
        self.known = pa.array([""], pa.string())
        self.words: dict[str, list[int]] = {}
        self.sizes = np.zeros(1, dtype=np.int32)
        self.pool = np.zeros(0, dtype=np.uint32)

    def _one(self, chunk: str) -> list[int]:
        m = _PLAIN.fullmatch(chunk)
        if not m:
            return self.tok.encode(chunk, add_special_tokens=False).ids
        word, sign = m[1].lower(), m[2]
        ids = self.words.get(word)
        if ids is None:
            ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.alphabet))]
            self.words[word] = ids
        if sign:
            if sign not in self.signs:
                if len(self.signs) > 10_000:
                    self.signs = {}
                self.signs[sign] = self.tok.encode(sign, add_special_tokens=False).ids
            ids = ids + self.signs[sign]
        return ids

    def _learn(self, chunks: pa.Array) -> None:
        ids = [self._one(c) for c in chunks.to_pylist()]
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int32, len(ids))])
        self.pool = np.concatenate([self.pool, np.asarray([i for x in ids for i in x], dtype=np.uint32)])
        self.known = pa.concat_arrays([self.known, chunks])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): all ids of the texts one after another as uint32; text i has
        ``ids[bounds[i]:bounds[i + 1]]``. A null text counts as empty."""
        if texts.offset:  # a copy: casts and string functions of Arrow misread some views
            texts = texts.take(pa.array(range(len(texts)), pa.int64()))
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # strings of special tokens are case-sensitive, all else is lower-cased anyway
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = parts.flatten()
        if len(self.known) > self.capacity or self.known.nbytes + self.pool.nbytes > self.max_bytes:
            self._empty()
        found = pc.index_in(chunks, value_set=self.known)
        which = pc.fill_null(found, -1).to_numpy()
        if found.null_count:
            new, base = chunks.filter(found.is_null()).dictionary_encode(), len(self.known)
            self._learn(new.dictionary)
            which = which.copy()
            which[which < 0] = new.indices.to_numpy() + base
        lens = self.sizes[which]
        ends = np.cumsum(lens, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        index = np.repeat(starts[which] - (ends - lens), lens)
        index += np.arange(total)
        at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return self.pool.take(index), np.concatenate([[0], ends])[at]


_held: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """This worker's tokenizer for ``path``."""
    if path not in _held:
        _held[path] = ChunkTokenizer(path)
    return _held[path]
