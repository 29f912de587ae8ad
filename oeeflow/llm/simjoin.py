"""N-gram Jaccard join with signature trees.

A text's set is its distinct word shingles. All pairs of texts with Jaccard at least ``threshold``
are linked, exactly; equal sets are collapsed first and stand for each other.

1. Candidate blocks. In any fixed order of all shingles, two linked sets share one of the first
   ``n - ceil(threshold * n) + 1`` shingles of each (prefix filter), and ``k`` of the first
   ``n - ceil(threshold * n) + k``. The order used puts shingles that are common in a bounded
   sample last and is by hash otherwise. A set of which fewer than ``k`` (a share of its size) of
   those shingles occur in any other set of fitting size is linked with nothing and drops out,
   twice over. Sets left that meet in a prefix shingle and have fitting sizes are chained, smallest
   to largest, never paired; connected chains are a block, so linked sets always lie in one block.
2. Signature trees. Within a block (cut into chunks of bounded weight; pairs of chunks with
   compatible sizes go to one task each) the sets are leaves of a tree whose nodes hold the
   OR of token bitmaps and the range of sizes. A dual traversal drops node pairs that cannot reach
   the overlap the threshold needs, then set pairs by their own bitmaps, and pairs that are
   already connected; what is left is intersected exactly.
3. The links found, one star per task, are joined into components.

Defined results: null and empty texts have no shingles, are linked with nothing and are their own
component; a text with fewer words than a shingle is one shingle; repeated rows and ids are copies
of one text; the component is the smallest non-null id (null if there is none); an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.llm.common import on_workers, slices, written
from oeeflow.llm.components import components

SAMPLE_DOCS = 20_000      # texts (about) in which common shingles are looked for
COMMON_IN_SAMPLE = 2      # a shingle in so many of them goes to the end of the order
EXTRA_SHARE = 0.08        # k of the longer prefix, as a share of the set
SALTS = 64                # parts of a common shingle's list
BITMAP_WORDS = 1 << 18    # words of 64 bits in the filter of live sets (2 MB, fixed)
CHUNK_WEIGHT = 1 << 21    # shingles (plus 200 a set) that one tree holds


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x, pa.int64())


# ------------------------------------------------------------------ candidate blocks

def _sizes_fit(small, large, threshold: float):
    return small >= np.ceil(threshold * large - 1e-9)


def _common_shingles(docs: DataFrame, shingle: int, total: int) -> np.ndarray:
    """Shingles in at least ``COMMON_IN_SAMPLE`` texts of a sample of about ``SAMPLE_DOCS`` texts
    chosen by the hash of the text; sorted. Only the order of shingles depends on it."""
    from oeeflow.llm.shingles import shingle_sets
    one_in = max(1, total // SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for members in shingle_sets(batch.column(0), shingle):
                yield pa.RecordBatch.from_arrays([_long(_as_long(members))], ["s"])

    sample = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).distinct()
    common = (sample.mapInArrow(run, "s long").groupBy("s").count()
              .filter(F.col("count") >= COMMON_IN_SAMPLE).select("s"))
    found = common.toArrow().column(0).to_numpy()
    return np.sort(found.view(np.uint64))


def _postings(docs: DataFrame, shingle: int, threshold: float, common) -> DataFrame:
    """(token, salt, pn, sig): a text's first shingles in the order; pn is its size, a mark of the
    shingle before this one, and in the lowest bit whether it belongs to the short prefix. Equal
    texts of a batch give one set of rows."""
    from oeeflow.llm.shingles import set_hash, shingle_sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = common.value
        for batch in slices(batches):
            token, salt, pn, sig, seen = [], [], [], [], set()
            for members in shingle_sets(batch.column(0), shingle):
                n = len(members)
                key = set_hash(members)
                if not n or key in seen:
                    continue
                seen.add(key)
                short = n - math.ceil(threshold * n - 1e-9) + 1
                size = short - 1 + _extra(n)
                if len(late):
                    at = np.searchsorted(late, members)
                    is_common = late[np.minimum(at, len(late) - 1)] == members
                    rare = members[~is_common]
                    prefix = rare[:size] if len(rare) >= size else np.concatenate([rare, members[is_common][:size - len(rare)]])
                    n_rare = min(len(rare), size)
                else:
                    prefix, n_rare = members[:size], size
                before = np.zeros(size, np.int64)  # 0: nothing comes before
                before[1:] = (prefix[:-1] >> np.uint64(32)).astype(np.int64) & ~1 | 2
                before[:short] |= 1
                part = np.full(size, -1, np.int64)
                part[n_rare:] = key % SALTS
                token.append(prefix)
                salt.append(part)
                pn.append((np.int64(n) << 32) | before)
                sig.append(np.full(size, key, np.int64))
            if token:
                yield pa.RecordBatch.from_arrays(
                    [_long(_as_long(np.concatenate(token))), pa.array(np.concatenate(salt), pa.int32()),
                     _long(np.concatenate(pn)), _long(np.concatenate(sig))], ["token", "salt", "pn", "sig"])

    return docs.select("text").mapInArrow(run, "token long, salt int, pn long, sig long")


def _extra(n):
    """k of the longer prefix."""
    return np.maximum(1, np.ceil(EXTRA_SHARE * n)).astype(np.int64) if isinstance(n, np.ndarray) else max(1, math.ceil(EXTRA_SHARE * n))


LIST_SCHEMA = "token long, salt int, pn long, sig long"


def _sorted_lists(postings: DataFrame) -> DataFrame:
    return postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "pn", "sig")


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns token, salt, pn, sig of sorted rows without repeats, in pieces; the last row of a
    piece is the first of the next (so that each pair of neighbours is seen once)."""
    held = None
    for batch in batches:
        cols = tuple(batch.column(i).to_numpy() for i in range(4))
        if held is not None:
            cols = tuple(np.concatenate([h, x]) for h, x in zip(held, cols))
        if not len(cols[0]):
            continue
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[3][1:] != cols[3][:-1])
        cols = tuple(x[new] for x in cols)
        held = tuple(x[-1:] for x in cols)
        yield cols


def _shared(postings: DataFrame, threshold: float) -> DataFrame:
    """The rows whose shingle another set of fitting size has, too (all rows of common shingles,
    whose lists are cut by salt), without repeats. Streams sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_shared = None, False

        def rows(cols, pick):
            return pa.RecordBatch.from_arrays([_long(cols[0][pick]), pa.array(cols[1][pick], pa.int32()),
                                               _long(cols[2][pick]), _long(cols[3][pick])], ["token", "salt", "pn", "sig"])
        for t, p, n, s in _in_runs(batches):
            size = n >> 32
            meets = (t[1:] == t[:-1]) & (p[1:] == p[:-1]) & _sizes_fit(size[:-1], size[1:], threshold)
            shared = p >= 0
            shared[1:] |= meets
            shared[:-1] |= meets
            shared[0] |= held_shared
            # the last row waits for its next neighbour
            held, held_shared = tuple(x[-1:] for x in (t, p, n, s)), bool(shared[-1])
            yield rows((t, p, n, s), np.flatnonzero(shared[:-1]))
        if held is not None and held_shared:
            yield rows(held, np.array([0]))

    return _sorted_lists(postings).mapInArrow(run, LIST_SCHEMA)


def _linkable(shared: DataFrame, threshold: float) -> DataFrame:
    """The rows of the sets with enough shared shingles among their first: the k of the smallest
    set that fits, since two sets are sure to share the lesser k of the two."""
    n = F.expr("shiftright(pn, 32)")
    least = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))
    live = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("k"), F.max(n).alias("n")).filter(
        F.col("k") >= F.greatest(F.lit(1), F.ceil(least * F.lit(EXTRA_SHARE) - F.lit(1e-9)))).select("sig")
    return shared.join(live, "sig").select("token", "salt", "pn", "sig")


def _chains(postings: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) between neighbours by size in each list, and the runs of salted lists:
    (a, null, token, least size, largest size). Streams sorted partitions; holds one row."""
    names = ["a", "b", "token", "least", "largest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_run = None  # (token, sig, least size) of the open run of a salted list
        first, last = True, None
        for t, p, n, s in _in_runs(batches):
            size, prev = n >> 32, n & 0xFFFFFFFE
            same = (t[1:] == t[:-1]) & (p[1:] == p[:-1]) & _sizes_fit(size[:-1], size[1:], threshold)
            # two rows with the same shingle before this one meet in that shingle's list
            k = np.flatnonzero(same & ((prev[1:] != prev[:-1]) | (prev[1:] == 0)))
            none = pa.nulls(len(k), pa.int64())
            yield pa.RecordBatch.from_arrays([_long(s[k]), _long(s[k + 1]), none, none, none], names)
            done = []
            if open_run is not None or (p >= 0).any():
                begins = np.flatnonzero(np.concatenate([[first], ~same]))
                for i in begins.tolist():
                    if open_run is not None:
                        done.append((*open_run, int(size[i - 1])))
                    open_run = (int(t[i]), int(s[i]), int(size[i])) if p[i] >= 0 else None
            first, last = False, int(size[-1])
            if done:
                cols = [pa.array(x, pa.int64()) for x in zip(*done)]
                yield pa.RecordBatch.from_arrays([cols[1], pa.nulls(len(done), pa.int64()), cols[0], cols[2], cols[3]], names)
        if open_run is not None:
            t, s, least = open_run
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (s, None, t, least, last)], names)

    return _sorted_lists(postings.filter("pn & 1 = 1")).mapInArrow(run, "a long, b long, token long, least long, largest long")


def candidate_edges(docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common_shingles(docs, shingle, docs.count()))
    shared = written(_shared(_postings(docs, shingle, threshold, common), threshold), "simjoin-shared")
    shared = written(_shared(_linkable(shared, threshold), threshold), "simjoin-shared")
    found = written(_chains(_linkable(shared, threshold), threshold), "simjoin-chains")
    # runs of one salted list in order of their least size; overlapping or fitting ones are chained
    w = Window.partitionBy("token").orderBy("least", "largest", "a")
    upto = F.max("largest").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = (found.filter(F.col("token").isNotNull()).distinct()
            .withColumn("p", F.lag("a").over(w)).withColumn("upto", upto)
            .filter(F.col("p").isNotNull() & (F.col("upto") >= F.ceil(F.col("least") * F.lit(threshold) - F.lit(1e-9))))
            .select("a", F.col("p").alias("b")))
    return found.filter(F.col("b").isNotNull()).select("a", "b").unionByName(runs)


# ------------------------------------------------------------------ signature tree

class SignatureTree:
    """Leaves of ``leaf`` sets under nodes of ``fan`` children; each node has the OR of its token
    bitmaps, its least and largest set size, and its slack: the most tokens of one set that share
    a bit with another of its tokens."""

    def __init__(self, sets: list[np.ndarray], bits: int, leaf: int = 16, fan: int = 8):
        self.sets = sets
        self.n = np.array([len(x) for x in sets], np.int64)
        words = bits // 64
        self.maps = np.zeros((len(sets), words), np.uint64)
        for i, x in enumerate(sets):
            at = (x % np.uint64(bits)).astype(np.int64)
            dense = np.zeros(bits, np.uint8)
            dense[at] = 1
            self.maps[i] = np.packbits(dense, bitorder="little").view(np.uint64)
        self.set_bits = np.bitwise_count(self.maps).sum(1, dtype=np.int64)
        lo = np.arange(0, len(sets), leaf)
        self.levels = [{"lo": lo, "hi": np.minimum(lo + leaf, len(sets)),
                        "or": np.bitwise_or.reduceat(self.maps, lo, axis=0),
                        "least": np.minimum.reduceat(self.n, lo), "largest": np.maximum.reduceat(self.n, lo),
                        "slack": np.maximum.reduceat(self.n - self.set_bits, lo)}]
        while len(self.levels[-1]["lo"]) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below["lo"]), fan)
            self.levels.append({"lo": at, "hi": np.minimum(at + fan, len(below["lo"])),
                                "or": np.bitwise_or.reduceat(below["or"], at, axis=0),
                                "least": np.minimum.reduceat(below["least"], at),
                                "largest": np.maximum.reduceat(below["largest"], at),
                                "slack": np.maximum.reduceat(below["slack"], at)})


def _need(n_a, n_b, threshold: float):
    """Least overlap of two sets that are linked."""
    return np.ceil(threshold / (1 + threshold) * (n_a + n_b) - 1e-9)


def _node_pairs(a: SignatureTree, b: SignatureTree, same: bool, threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs of leaf nodes that may hold linked sets."""
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        x, y = a.levels[la], b.levels[lb]
        if (x["largest"][i] < threshold * y["least"][j] - 1e-9) or (y["largest"][j] < threshold * x["least"][i] - 1e-9):
            continue
        shared = int(np.bitwise_count(x["or"][i] & y["or"][j]).sum())
        if shared + min(x["slack"][i], y["slack"][j]) < _need(x["least"][i], y["least"][j], threshold):
            continue
        if la == 0 and lb == 0:
            yield i, j
        elif same and la == lb and i == j:
            kids = range(int(x["lo"][i]), int(x["hi"][i]))
            stack += [(la - 1, p, la - 1, q) for p in kids for q in kids if p <= q]
        elif la >= lb:
            stack += [(la - 1, p, lb, j) for p in range(int(x["lo"][i]), int(x["hi"][i]))]
        else:
            stack += [(la, i, lb - 1, q) for q in range(int(y["lo"][j]), int(y["hi"][j]))]


def jaccard_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Component labels of the sets ``left + right`` under the links found between the two sides
    (or within ``left`` if ``right`` is None): a label is the index of one member."""
    sides = left if right is None else left + right
    largest = max((len(x) for x in sides), default=1)
    bits = min(1 << 16, max(256, 1 << (2 * largest - 1).bit_length()))
    a = SignatureTree(left, bits)
    b = a if right is None else SignatureTree(right, bits)
    shift = 0 if right is None else len(left)
    label = np.arange(len(sides))
    for i, j in _node_pairs(a, b, right is None, threshold):
        pa_, pb = np.arange(a.levels[0]["lo"][i], a.levels[0]["hi"][i]), np.arange(b.levels[0]["lo"][j], b.levels[0]["hi"][j])
        open_ = label[pa_][:, None] != label[pb + shift][None, :]
        if not open_.any():
            continue
        na, nb = a.n[pa_][:, None], b.n[pb][None, :]
        shared = np.bitwise_count(a.maps[pa_][:, None, :] & b.maps[pb][None, :, :]).sum(2, dtype=np.int64)
        most = shared + np.minimum(na - a.set_bits[pa_][:, None], nb - b.set_bits[pb][None, :])
        open_ &= most >= _need(na, nb, threshold)
        for p, q in np.argwhere(open_):
            x, y = int(pa_[p]), int(pb[q])
            if label[x] == label[y + shift]:
                continue
            u, v = a.sets[x], b.sets[y]
            if len(u) > len(v):
                u, v = v, u
            at = np.searchsorted(v, u)
            both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
            if both >= threshold * (len(u) + len(v) - both) - 1e-9:
                old, new = sorted((label[x], label[y + shift]), reverse=True)
                label[label == old] = new
    return label


# ------------------------------------------------------------------ the join

def _live_filter(live: DataFrame) -> np.ndarray:
    """A fixed-size bitmap of the sets that are in a block (a set that is not may pass, too)."""
    words = live.select((F.pmod(F.col("sig"), F.lit(BITMAP_WORDS * 64))).alias("k")).groupBy(
        F.expr("shiftright(k, 6)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(k & 63 as int))")).alias("m")).toArrow()
    out = np.zeros(BITMAP_WORDS, np.uint64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return out


def _live_sets(docs: DataFrame, shingle: int, bitmap) -> DataFrame:
    from oeeflow.llm.shingles import set_hash, shingle_sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, seen = bitmap.value, set()
        for batch in slices(batches):
            sig, members = [], []
            for x in shingle_sets(batch.column(0), shingle):
                if not len(x):
                    continue
                key = set_hash(x)
                k = key % (BITMAP_WORDS * 64)
                if key not in seen and (int(have[k >> 6]) >> (k & 63)) & 1:
                    seen.add(key)
                    sig.append(key)
                    members.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(members, pa.binary())], ["sig", "members"])

    return docs.select("text").mapInArrow(run, "sig long, members binary")


def _task_links(threshold: float):
    def run(key, table):
        rows = sorted({(s, side): m for s, side, m in zip(
            table.column("sig").to_pylist(), table.column("side").to_pylist(), table.column("members").to_pylist())}.items())
        sides: list[list] = [[], []]
        for (sig, side), members in rows:
            sides[side].append((sig, np.frombuffer(members, np.uint64)))
        for one in sides:  # like sizes and like smallest hashes side by side
            one.sort(key=lambda r: (int(math.log(len(r[1])) / -math.log(threshold)) if threshold < 1 else len(r[1]),
                                    int(r[1][0]), len(r[1]), r[0]))
        sigs = np.array([s for one in sides for s, _ in one], np.int64)
        left = [m for _, m in sides[0]]
        label = jaccard_links(left, [m for _, m in sides[1]] if sides[1] else None, threshold)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(sigs[linked], pa.int64()), "b": pa.array(sigs[label[linked]], pa.int64())})
    return run


def text_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, th, n_shingles, sig) of every row: th is a hash of the text, sig is null for an empty set."""
    from oeeflow.llm.shingles import set_hash, shingle_sets
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column(1), shingle))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([set_hash(x) if len(x) else None for x in sets], pa.int64())], ["id", "th", "n_shingles", "sig"])

    return docs.select("id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, f"id {id_type}, th long, n_shingles long, sig long")


def _grouped_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(sets: id, th, n_shingles, sig of every row, written; groups: sig, component, first_id)."""
    spark = docs.sparkSession
    on_workers(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = written(text_sets(docs, shingle), "simjoin-sets")
    blocks = written(components(candidate_edges(docs, shingle, threshold)).withColumnsRenamed(
        {"node": "sig", "component": "block"}), "simjoin-blocks")

    # chunks: a block's sets by size, cut where their weight passes CHUNK_WEIGHT
    live = sets.filter("sig is not null").select("sig", "n_shingles").distinct().join(blocks, "sig")
    by_size = live.groupBy("block", "n_shingles").agg(F.sum(F.col("n_shingles") + 200).alias("w"))
    before = F.coalesce(F.sum("w").over(Window.partitionBy("block").orderBy("n_shingles")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_size = by_size.select("block", "n_shingles", F.floor(before / CHUNK_WEIGHT).alias("c"),
                             F.ceil(F.col("w") / CHUNK_WEIGHT).alias("parts"))
    placed = written(live.join(by_size, ["block", "n_shingles"]).select(
        "sig", "block", "n_shingles", "c", F.pmod(F.xxhash64("sig"), F.col("parts")).alias("p")), "simjoin-chunks")
    chunks = placed.groupBy("block", "c", "p").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("largest"))
    x, y = chunks.alias("x"), chunks.alias("y")
    fits = ((F.col("x.largest") >= F.col("y.least") * threshold - 1e-9) & (F.col("y.largest") >= F.col("x.least") * threshold - 1e-9))
    ordered = F.struct("x.c", "x.p") <= F.struct("y.c", "y.p")
    pairs = x.join(y, (F.col("x.block") == F.col("y.block")) & fits & ordered).select(
        F.col("x.block").alias("block"), F.col("x.c").alias("c"), F.col("x.p").alias("p"), F.col("y.c").alias("c2"), F.col("y.p").alias("p2"))
    own = pairs.select("block", "c", "p", F.struct("c", "p", "c2", "p2").alias("pair"), F.lit(0).alias("side"))
    other = pairs.filter("c <> c2 or p <> p2").select(
        "block", F.col("c2").alias("c"), F.col("p2").alias("p"), F.struct("c", "p", "c2", "p2").alias("pair"), F.lit(1).alias("side"))
    seats = placed.join(own.unionByName(other), ["block", "c", "p"]).select("sig", "block", "pair", "side")

    bitmap = spark.sparkContext.broadcast(_live_filter(blocks.select("sig")))
    members = _live_sets(docs, shingle, bitmap)
    links = (members.join(seats, "sig").groupBy("block", "pair")
             .applyInArrow(_task_links(threshold), "a long, b long"))
    linked = components(written(links, "simjoin-links"))

    # the smallest id of each set, then of each component
    ids = sets.filter("sig is not null").groupBy("sig").agg(F.min("id").alias("first_id"))
    named = ids.join(linked.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "component", F.coalesce("component", "sig"))
    return sets, named


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id that links
    reach (its own included)."""
    sets, named = _grouped_sets(docs, id_col, text_col, shingle, threshold)
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_sig = named.join(least, "component").select("sig", "component_id")
    return sets.join(of_sig, "sig", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
             threshold: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the smallest id, null ids
    last, then the smallest text hash. A document is an id with a text: rows that repeat both are one
    document, rows that share an id alone are judged apart. Texts without words stay."""
    sets, named = _grouped_sets(docs, id_col, text_col, shingle, threshold)
    of = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    rows = written(sets.join(named.select("sig", "component"), "sig", "left").select("id", "th", "component", of.alias("doc")), "simjoin-found")
    first = rows.filter("component is not null").groupBy("component").agg(F.min("doc").alias("first"))
    gone = rows.join(first, "component").filter(~F.col("doc").eqNullSafe(F.col("first")))
    gone = gone.select(F.col("id").alias("_id"), F.col("th").alias("_th")).distinct()
    twice = rows.groupBy(F.col("id").alias("_id"), F.col("th").alias("_th")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    hashed = docs.withColumn("_text_hash", F.xxhash64(text_col))

    def same(other):
        return hashed[id_col].eqNullSafe(other["_id"]) & (hashed["_text_hash"] == other["_th"])
    either = gone.unionByName(twice)
    once = hashed.join(either, same(either), "left_anti")
    repeated = hashed.join(twice, same(twice), "left_semi").join(gone, same(gone), "left_anti").dropDuplicates([id_col, "_text_hash"])
    return once.unionByName(repeated).select(*docs.columns)
