"""Language-model scores from an Elias-Fano n-gram trie.

Training counts every word, every pair and (``order`` 3) every triple of neighbours of the training
texts (a text begins with a mark and ends with an end token) as Spark aggregations. The model
interpolates absolutely discounted counts with the next shorter context, down to smoothed words:

    p1(w)    = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w|c)   = max(n(c, w) - D, 0) / n(c) + back(c) p1(w)
    p(w|b,c) = max(n(b, c, w) - D, 0) / n(b, c) + back(b, c) p(w|c)

for pairs counted at least ``min_pair`` times (1: all) and all triples whose first pair is kept; the
mass of the others is part of ``back``, so every context sums to 1. The trie is a set of level files
in the shared folder. Words (Elias-Fano over their hashes, with counts) and the back-off weights of
words (Elias-Fano over their ids) are cut by hash. Pairs and triples take one exchange: every task
counts the triples of a few megabytes of text, cuts them by the hash of their first pair and sends
each shard's sorted, column-wise block as one row; a shard's task merges its blocks as they come. A
pair's count is the sum of its triples, so its file holds both levels: contexts, monotone pointers to
their successors, successors relative to their context, quantised log probabilities (the discounted
part; the shorter contexts' part is added by the weights), then pointers to the third words, those
words and their log probabilities. ``back(b, c)`` is the discount times the number of third words over the
pair's count. A frequent pair reaches its task once for each third word and run of texts, never once
a row; the task holds its distinct triples. Scorers map a file into memory when a text first needs it
and search all distinct grams of a run of texts at once, each inside the range that its context's
pointers give.

Defined results: null and empty texts are one end token; a null id trains and is not held out;
repeated rows are counted and scored each; without training texts every token has probability 1.
An empty table gives an empty result. Other columns are not read. Texts are hashed a run at a time; a
text longer than a run is a run of its own, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oeeflow.llm.common import on_workers, scratch_path, slices, written

END, BEGIN = np.uint64(0x7E57ED0E5EED0001), np.uint64(0x7E57ED0E5EED0002)
SHARD_ROWS = 1 << 20       # words of a word file; of training tokens for each gram file
RUN_TOKENS = 300_000       # tokens of the runs of texts that are counted or scored at once
STEP = 1 / 4096            # quantum of stored log10 probabilities and back-off weights
FLUSH = 1_500_000          # distinct keys that a counting task holds
OPEN_FILES = 512           # files that a scorer keeps mapped


@dataclass
class TrieFiles:
    """Where the level files are; their names follow from the folder and the numbers of shards."""
    n: int = 0             # training tokens N
    v: int = 0             # distinct training tokens V
    discount: float = 0.75
    words: list = field(default_factory=list)      # (path, first id) by hash range
    folder: str = ""
    n_contexts: int = 0    # files of back-off weights, by word id
    n_grams: int = 0       # files of pairs and triples, by hash of the pair


def held_out(id_col: Column, remainder: int = 1) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == remainder


def _tokens(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a run of texts with an end token after each, and the text of each token."""
    n = len(at) - 1
    ends = at[1:] + np.arange(n)
    out = np.empty(len(words) + n, np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = END, words
    return out, np.repeat(np.arange(n), np.diff(at) + 1)


def _counter(extract, names: tuple[str, ...]):
    """mapInArrow function: counts of the uint64 keys that ``extract`` finds, held per task up to
    FLUSH distinct keys at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from oeeflow.llm.shingles import word_hashes
        look = extract()
        held, sums, size = [np.zeros(0, np.uint64)], [np.zeros(0)], 0

        def merged():
            keys, where = np.unique(np.concatenate(held), return_inverse=True)
            return keys, np.bincount(where, weights=np.concatenate(sums), minlength=len(keys))

        def rows(keys, counts):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], list(names))

        for batch in slices(batches):
            for _, words, at in word_hashes(batch.column(0)):
                keys, counts = np.unique(look(words, at), return_counts=True)
                held.append(keys)
                sums.append(counts.astype(float))
                size += len(keys)
                if size > FLUSH:
                    keys, counts = merged()
                    held, sums, size = [keys], [counts], 0
                    if len(keys) > FLUSH // 2:
                        yield rows(keys, counts)
                        held, sums = [np.zeros(0, np.uint64)], [np.zeros(0)]
        yield rows(*merged())
    return run


def _runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(batches, words, bounds) of runs of whole texts of about RUN_TOKENS."""
    from oeeflow.llm.shingles import word_hashes
    held, words, sizes, total = [], [], [], 0
    for batch in slices(batches):
        held.append(batch)
        for _, part, at in word_hashes(batch.column(column)):
            words.append(part)
            sizes.append(np.diff(at))
            total += len(part) + len(at) - 1
        if total > RUN_TOKENS:
            yield held, np.concatenate(words), np.append(0, np.cumsum(np.concatenate(sizes)))
            held, words, sizes, total = [], [], [], 0
    if total:
        yield held, np.concatenate(words), np.append(0, np.cumsum(np.concatenate(sizes)))


class Trie:
    """Reader of the level files."""

    def __init__(self, files: TrieFiles):
        from oeeflow.llm.eliasfano import open_level
        self.f = files
        self.words = [(open_level(p), first) for p, first in files.words]
        self.unknown = files.n + 0.5 * (files.v + 1)
        self.powers = 10.0 ** (-STEP * np.arange(1 << 16))  # of the quantised logarithms
        self.opened: dict[str, dict] = {}

    def level(self, name: str) -> dict:
        from oeeflow.llm.eliasfano import open_level
        if name not in self.opened:
            if len(self.opened) >= OPEN_FILES:
                self.opened.pop(next(iter(self.opened)))
            self.opened[name] = open_level(f"{self.f.folder}/{name}")
        return self.opened[name]

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of distinct hashes; unknown words have id -1 and count 0."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = _shard_of_hash(hashes, len(self.words)) if self.words else None
        for s, (level, first) in enumerate(self.words):
            k = np.flatnonzero(shard == s)
            if len(k):
                at, found = level["hashes"].successor(hashes[k])
                k, at = k[found], at[found]
                ids[k], counts[k] = first + at, level["counts"][at]
        return ids, counts

    def p1(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / self.unknown

    def back(self, contexts: np.ndarray) -> np.ndarray:
        """Back-off weight of each word id (the mark is V, an unknown word -1)."""
        out = np.ones(len(contexts))
        shard = contexts % max(1, self.f.n_contexts)
        for s in np.unique(shard[contexts >= 0]).tolist() if self.f.n_contexts else ():
            k = np.flatnonzero((shard == s) & (contexts >= 0))
            own = self.level(f"contexts-{s}")
            if own["ids"].n:
                at, found = own["ids"].successor(contexts[k].astype(np.uint64))
                out[k[found]] = self.powers[own["back"][at[found]]]
        return out

    def grams(self, b: np.ndarray, c: np.ndarray, of: np.ndarray, w: np.ndarray):
        """Of pairs (b, c): the discounted p(c|b), 0 where there is no such pair. Of triples (pair
        ``of``, third word w): the discounted p(w|b,c). And ``back`` of every pair, 1 where no triple begins with it."""
        two, three, back = np.zeros(len(b)), np.zeros(len(w)), np.ones(len(b))
        if not self.f.n_grams:
            return two, three, back
        shard = np.where((b >= 0) & (c >= 0), _shard_of_pair(b, c, self.f.n_grams), -1)
        by_pair, by_triple = np.argsort(shard, kind="stable"), np.argsort(shard[of], kind="stable")
        pair_at = np.searchsorted(shard[by_pair], np.arange(self.f.n_grams + 1))
        triple_at = np.searchsorted(shard[of][by_triple], np.arange(self.f.n_grams + 1))
        size, powers = np.int64(self.f.v + 1), self.powers
        node = np.full(len(b), -1, np.int64)
        for s in np.flatnonzero(np.diff(pair_at)).tolist():
            k = by_pair[pair_at[s]:pair_at[s + 1]]
            own = self.level(f"grams-{s}")
            if not own["contexts"].n:
                continue
            begins = np.flatnonzero(np.append(True, b[k[1:]] != b[k[:-1]]))  # runs of one context
            place, found = own["contexts"].successor(b[k[begins]].astype(np.uint64))
            place[~found] = 0
            lo, hi = (np.where(found, own["pointers"].get(place + i).astype(np.int64), 0) for i in (0, 1))
            place, lo, hi = (np.repeat(x, np.diff(np.append(begins, len(k)))) for x in (place, lo, hi))
            # successors are stored relative to their context's place
            at, found = own["successors"].find((place * size + c[k]).astype(np.uint64), lo, hi)
            k, at = k[found], at[found]
            node[k] = at
            two[k] = powers[own["prob"][at]]
            first, last = (own["pointers3"].get(at + i).astype(np.int64) for i in (0, 1))
            more = last > first
            back[k[more]] = self.f.discount * (last - first)[more] / own["counts"][at[more]]
            t = by_triple[triple_at[s]:triple_at[s + 1]]
            t = t[(node[of[t]] >= 0) & (w[t] >= 0)]
            if not len(t) or not own["successors3"].n:
                continue
            lo, hi = np.zeros((2, len(b)), np.int64)
            lo[k], hi[k] = first, last
            at, found = own["successors3"].find((node[of[t]] * size + w[t]).astype(np.uint64), lo[of[t]], hi[of[t]])
            three[t[found]] = powers[own["prob3"][at[found]]]
        return two, three, back


def _shard_of_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _shard_of_pair(contexts: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    from oeeflow.llm.shingles import mix
    h = mix(contexts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words.astype(np.uint64))
    return (h % np.uint64(n)).astype(np.int64)


def _contexts(ids: np.ndarray, at: np.ndarray, begin: int) -> np.ndarray:
    """The word before each token; ``begin`` before the first of a text."""
    out = np.empty(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[at[:-1] + np.arange(len(at) - 1)] = begin
    return out


_held: dict[str, Trie] = {}


def _trie(files: TrieFiles) -> Trie:
    key = repr(files)
    if key not in _held:
        _held.clear()
        _held[key] = Trie(files)
    return _held[key]


def _quantised(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(np.maximum(p, 1e-15)) / STEP), 0, 65535).astype(np.uint16)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, behind the number of bytes that the largest needs:
    high bytes of small numbers become long runs that the shuffle's compression takes away."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplaned(raw) -> np.ndarray:
    raw = np.frombuffer(raw, np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = raw[1:].reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.int64)


def _merged(parts: list[tuple], size: int) -> tuple:
    """Blocks of (b, c, number of triples) by pair and (w, n) by triple, as one sorted block."""
    b, c, t, w, n = (np.concatenate(x) for x in zip(*parts))
    firsts, rank = np.unique(b, return_inverse=True)
    pairs, rank = np.unique(rank * np.int64(size) + c, return_inverse=True)
    key = np.repeat(rank, t) * np.int64(size) + w
    order = np.argsort(key, kind="stable")  # few sorted runs
    key, n = key[order], n[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key, n = key[begins], (np.add.reduceat(n, begins) if len(key) else n)
    t = np.bincount(key // size, minlength=len(pairs))
    return firsts[pairs // size], pairs % size, t, key % size, n


def fit_trie(texts: DataFrame, discount: float = 0.75, min_pair: int = 2, order: int = 2) -> TrieFiles:
    """Count the ``text`` column and write the level files; returns where they are."""
    spark = texts.sparkSession
    on_workers(spark)
    folder = scratch_path(spark, "lm-trie")
    texts = texts.select("text")

    # level 1: words
    def all_tokens():
        return lambda words, at: _tokens(words, at)[0]
    counts = written(texts.mapInArrow(_counter(all_tokens, ("h", "n")), "h long, n long")
                     .groupBy("h").agg(F.sum("n").alias("n")), "lm-words")
    files = TrieFiles(discount=discount, folder=folder)
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.max(F.when(F.col("h") == int(END.view(np.int64)), F.col("n"))).alias("texts")).first()
    if not total["n"]:
        return files
    files.n, files.v, n_texts = total["n"], total["v"], total["texts"]
    n_shards = -(-files.v // SHARD_ROWS)

    def shard_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of_hash(h, n_shards), pa.int32()), batch.column(0),
                                              batch.column(1)], ["s", "h", "n"])

    def write_words(key, table):
        from oeeflow.llm.eliasfano import EliasFano, write_level
        h = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        path = write_level(folder, f"words-{key[0].as_py()}", hashes=EliasFano.build(h[order], 1 << 64),
                           counts=table.column("n").to_numpy()[order].astype(np.int64))
        return pa.table({"s": pa.array([key[0].as_py()], pa.int32()), "path": [path], "n": pa.array([len(h)], pa.int64())})

    done = (counts.mapInArrow(shard_words, "s int, h long, n long").groupBy("s")
            .applyInArrow(write_words, "s int, path string, n long").collect())
    first, by_shard = 0, {r["s"]: r for r in done}
    for s in range(n_shards):  # a shard without words has no file; with hashes there is none such
        files.words.append((by_shard[s]["path"], first))
        first += by_shard[s]["n"]

    v = files.v

    def counts_of(trie, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), n_texts, np.int64)  # the mark: once a text
        starts = np.array([f for _, f in files.words])
        shard = np.searchsorted(starts, ids, "right") - 1
        for s, (level, begin) in enumerate(trie.words):
            k = np.flatnonzero((shard == s) & (ids < v))
            out[k] = level["counts"][ids[k] - begin]
        return out

    # levels 2 and 3: triples of ids (b, c, w); b is V before a text, w is V where none follows or is asked for
    size = v + 1
    n_grams, n_contexts = max(1, files.n // SHARD_ROWS), -(-size // SHARD_ROWS)
    block = "s int, b binary, c binary, t binary, w binary, n binary"
    names = ["s", "b", "c", "t", "w", "n"]

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(files)
        for _, words, at in _runs(batches, 0):
            tokens, _ = _tokens(words, at)
            distinct, where = np.unique(tokens, return_inverse=True)
            d = len(distinct)  # places and ids rise together: both follow the hash
            ids = np.append(trie.word_ids(distinct)[0], v)
            pairs, rank = np.unique(_contexts(where, at, d) * np.int64(d + 1) + where, return_inverse=True)
            after = np.append(where[1:], d)
            after[at[1:] + np.arange(len(at) - 1)] = d
            if order < 3:
                after[:] = d
            key, n = np.unique(rank * np.int64(d + 1) + after, return_counts=True)
            of, w = key // (d + 1), ids[key % (d + 1)]
            b, c, t = ids[pairs // (d + 1)], ids[pairs % (d + 1)], np.bincount(of, minlength=len(pairs))
            shard = _shard_of_pair(b, c, n_grams)
            by_pair, by_key = np.argsort(shard, kind="stable"), np.argsort(shard[of], kind="stable")
            cuts = np.arange(n_grams + 1)
            pair_at, key_at = np.searchsorted(shard[by_pair], cuts), np.searchsorted(shard[of][by_key], cuts)
            rows = []
            for s in np.flatnonzero(np.diff(pair_at)).tolist():
                i, j = by_pair[pair_at[s]:pair_at[s + 1]], by_key[key_at[s]:key_at[s + 1]]
                rows.append((s, *map(_planes, (b[i], c[i], t[i], w[j], n[j]))))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if i else pa.int32()) for i, x in enumerate(zip(*rows))], names)

    def write_shard(s: int, blocks: Iterator[tuple]) -> Iterator[tuple]:
        from oeeflow.llm.eliasfano import EliasFano, write_level
        none = np.zeros(0, np.int64)
        held, fresh = [(none,) * 5], 0
        for part in blocks:
            held.append(part)
            fresh += len(part[3])
            if fresh > max(RUN_TOKENS, len(held[0][3])):
                held, fresh = [_merged(held, size)], 0
        b, c, t, w, n = _merged(held, size)
        ends = np.cumsum(t)
        m = np.add.reduceat(n, ends - t) if len(t) else none
        of = np.repeat(np.arange(len(t)), t)
        keep = m >= min_pair
        inner = keep[of] & (w < v)
        w, n, of = w[inner], n[inner], (np.cumsum(keep) - 1)[of[inner]]
        b, c, m = b[keep], c[keep], m[keep]
        own, begins = np.unique(b, return_index=True)
        place = np.searchsorted(own, b)
        write_level(folder, f"grams-{s}", contexts=EliasFano.build(own, size),
                    pointers=EliasFano.build(np.append(begins, len(b)), len(b) + 1),
                    successors=EliasFano.build(place * np.int64(size) + c, len(own) * size + 1),
                    prob=_quantised((m - discount) / counts_of(_trie(files), b)),
                    counts=m.astype(np.uint32 if not len(m) or m.max() < 1 << 32 else np.int64),
                    pointers3=EliasFano.build(np.searchsorted(of, np.arange(len(b) + 1)), len(w) + 1),
                    successors3=EliasFano.build(of * np.int64(size) + w, len(b) * size + 1),
                    prob3=_quantised((n - discount) / m[of]))
        kept = np.add.reduceat(m - discount, begins) if len(b) else np.zeros(0)
        for k in np.unique(own % n_contexts).tolist():
            i = own % n_contexts == k
            yield k, own[i].tobytes(), kept[i].tobytes()

    def by_key(batches: Iterator[pa.RecordBatch]):
        """(first column, iterator of the other columns) of rows that come sorted by the first."""
        def rows():
            for batch in batches:
                columns = [batch.column(i) for i in range(batch.num_columns)]
                for r in range(batch.num_rows):
                    yield columns[0][r].as_py(), [x[r].as_buffer() for x in columns[1:] if x[r].is_valid]
        return groupby(rows(), key=lambda r: r[0])

    def write_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in by_key(batches):
            out = list(write_shard(s, (tuple(map(_unplaned, x)) for _, x in rows if x)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if i else pa.int32()) for i, x in enumerate(zip(*out))],
                                                 ["k", "b", "kept"])

    def write_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from oeeflow.llm.eliasfano import EliasFano, write_level
        for k, rows in by_key(batches):
            left = np.zeros(-(-(size - k) // n_contexts))  # by id div n_contexts, SHARD_ROWS at most
            for x in (x for _, x in rows if x):
                np.add.at(left, np.frombuffer(x[0], np.int64) // n_contexts, np.frombuffer(x[1], float))
            ids = np.flatnonzero(left) * n_contexts + k
            back = 1 - left[left != 0] / counts_of(_trie(files), ids)
            write_level(folder, f"contexts-{k}", ids=EliasFano.build(ids, size), back=_quantised(np.maximum(back, 1e-12)))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], ["k"])

    def every(n: int, name: str, *others: str) -> DataFrame:  # a row without a block for each shard: no file is missing
        return spark.range(n).select(F.col("id").cast("int").alias(name), *(F.lit(None).cast("binary").alias(x) for x in others))

    grams = texts.mapInArrow(count_grams, block).unionByName(every(n_grams, *names))
    partial = written(grams.repartitionById(n_grams, F.col("s")).sortWithinPartitions("s")
                      .mapInArrow(write_grams, "k int, b binary, kept binary"), "lm-contexts")
    done = (partial.unionByName(every(n_contexts, "k", "b", "kept")).repartitionById(n_contexts, F.col("k"))
            .sortWithinPartitions("k").mapInArrow(write_contexts, "k int").count())
    assert done == n_contexts, (done, n_contexts)
    files.n_grams, files.n_contexts = n_grams, n_contexts
    return files


def score_texts(docs: DataFrame, files: TrieFiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, base_score (words alone) and score (the model), log10."""
    id_type = docs.schema[id_col].dataType.simpleString()
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(files)
        for held, words, at in _runs(batches, 1):
            n = len(at) - 1
            tokens, doc = _tokens(words, at)
            distinct, where = np.unique(tokens, return_inverse=True)
            ids, counts = trie.word_ids(distinct)
            p1, d = trie.p1(counts), np.int64(len(distinct))
            # pairs by place of the distinct words, the mark's place being the last; triples by place of the pairs
            key, pair = np.unique(_contexts(where, at, d) * (d + 1) + where, return_inverse=True)
            b, c = np.append(ids, files.v)[key // (d + 1)], ids[key % (d + 1)]
            before = _contexts(pair, at, -1)
            t = np.flatnonzero(before >= 0)
            triples, one, triple = np.unique(before[t] * (d + 1) + where[t], return_index=True, return_inverse=True)
            of, last = triples // (d + 1), pair[t[one]]
            two, three, back = trie.grams(b, c, of, ids[triples % (d + 1)])
            two += trie.back(np.append(ids, files.v))[key // (d + 1)] * p1[key % (d + 1)]
            three += back[of] * two[last]
            logp = np.log10(two)[pair]
            logp[t] = np.log10(three)[triple]

            def sums(x):
                return np.bincount(doc, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([x.column(0) for x in held]), pa.array(np.diff(at) + 1, pa.int64()),
                 pa.array(sums(counts[where] > 0).astype(np.int64)), pa.array(sums(np.log10(p1)[where])), pa.array(sums(logp))],
                ["id", "n_tokens", "n_known", "base_score", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")
            .withColumnRenamed("id", id_col))
