"""Space-separated chunks of many texts, each looked up in a table of what is already known."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stripped from both ends of a chunk before it is looked up as a term.
PUNCTUATION = " \t\r\x0b\x0c.,;:!?\"'`()[]{}<>|*#$%&/\\-_+=~^…«»“”„‘’¡¿"


class ChunkTable:
    """Maps chunks to rows of ``width`` numbers by ``learn(chunk)``, asked once per chunk. Holds at
    most about ``capacity`` chunks and ``max_bytes`` of them besides those of one call (it is emptied
    when full); no text is cut."""

    def __init__(self, learn: Callable[[str], tuple], width: int, capacity: int = 500_000, max_bytes: int = 64 << 20):
        self.learn, self.width, self.capacity, self.max_bytes = learn, width, capacity, max_bytes
        self._empty()

    def _empty(self) -> None:
        self.known = pa.array([], pa.string())
        self.values = np.zeros((0, self.width))

    def look_up(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(chunks, values, bounds): text i has the chunks ``bounds[i]`` to ``bounds[i + 1]``, one
        row of ``values`` each. A null text has one empty chunk."""
        if texts.offset:  # a copy: casts and string functions of Arrow misread some views
            texts = texts.take(pa.array(range(len(texts)), pa.int64()))
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), "\n", " ")
        parts = pc.split_pattern(texts, " ")
        chunks = parts.flatten()
        if len(self.known) > self.capacity or self.known.nbytes > self.max_bytes:
            self._empty()
        found = pc.index_in(chunks, value_set=self.known)
        which = pc.fill_null(found, -1).to_numpy()
        if found.null_count:
            new, base = chunks.filter(found.is_null()).dictionary_encode(), len(self.known)
            values = [self.learn(c) for c in new.dictionary.to_pylist()]
            self.values = np.concatenate([self.values, np.array(values, dtype=float).reshape(-1, self.width)])
            self.known = pa.concat_arrays([self.known, new.dictionary])
            which = which.copy()
            which[which < 0] = new.indices.to_numpy() + base
        return chunks, self.values[which], parts.offsets.to_numpy() - parts.offsets[0].as_py()
