"""Approximate nearest neighbours by a forest of random-projection trees.

Copies are one vector: each distinct vector keeps its ``k + 1`` smallest ids, which is all that a
list of ``k`` neighbours can name, so a group of copies of any size costs one candidate. Trees are
fitted on a sample of distinct vectors (``SAMPLE_PER_LEAF`` a leaf, at most 2 ** ``MAX_DEPTH`` leaves a
tree and ``MAX_WEIGHTS`` numbers in all); every distinct vector is indexed in one leaf of each tree.
A node splits at the median of a random direction.

A query walks all trees through one priority queue. A node's priority is the squared distances, in
spreads of their splits, by which the query misses its side of the splits above it. The queue is
followed until the leaves taken hold ``effort`` rows. ``effort`` is measured, not guessed: for
``TUNING`` query vectors the exact neighbours are found by reading all rows, and effort is the
least with which the walk reaches ``target`` of them. On vectors without any structure that is most
of the table; on clustered ones a small part.

A (tree, leaf) pair's rows and queries meet in one task, each side cut into parts of bounded size.
The first ``SEEDS`` leaves of each query give a score that the others must reach, so later leaves return few
rows. Candidates are scored exactly: component by component, in double precision.

Null, empty, zero and not wholly finite vectors take no part, nor do rows without id. Vectors
shorter than the longest count as followed by zeros. Equal scores go to the smaller id; a row that
repeats another counts once, and rows of the query's own id are not its neighbours. With fewer than
``k`` other rows all are returned; an empty table gives no row. Extra columns are not read. Distinct
vectors are told apart by 64-bit hashes when results are joined.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.llm.common import on_workers, slices, written
from oeeflow.llm.vectors import binary_rows, finite, matrix, padded, width

TREES = 3
LEAF_ROWS = 1024
MAX_DEPTH = 12
SAMPLE_PER_LEAF = 16
MAX_WEIGHTS = 1 << 24
TUNING = 64
SEEDS = 4
PART_ROWS, PART_QUERIES = 8192, 2048


@dataclass
class Forest:
    """Perfect binary trees: node i has children 2 i + 1 and 2 i + 2; ``sizes`` counts leaf rows."""
    directions: np.ndarray       # tree, node, dimension
    cuts: np.ndarray             # tree, node
    spreads: np.ndarray          # tree, node
    depth: int
    sizes: np.ndarray | None = None

    @property
    def nodes(self) -> int:
        return (1 << self.depth) - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        out = np.zeros((len(x), len(self.cuts)), np.int64)
        for t in range(len(self.cuts)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("nd,nd->n", x, self.directions[t, at]) > self.cuts[t, at]
                at = 2 * at + 1 + right
            out[:, t] = at - self.nodes
        return out

    def margins(self, x: np.ndarray) -> np.ndarray:
        """By how many spreads each row lies right of each node's cut: row, tree, node."""
        flat = self.directions.reshape(-1, self.directions.shape[-1])
        return ((x @ flat.T).reshape(len(x), *self.cuts.shape) - self.cuts) / self.spreads

    def walk(self, margins: np.ndarray, effort: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one priority queue over all trees, until they hold ``effort`` rows."""
        queue, out, held = [(0.0, t, 0) for t in range(len(self.cuts))], [], 0
        while queue and (held < effort or not out):
            penalty, t, node = heapq.heappop(queue)
            if node >= self.nodes:
                out.append((t, node - self.nodes))
                held += self.sizes[t, node - self.nodes]
            else:
                m = float(margins[t, node])
                for child, wrong in ((2 * node + 1, m > 0), (2 * node + 2, m <= 0)):
                    heapq.heappush(queue, (penalty + (m * m if wrong else 0.0), t, child))
        return out


def fit_forest(sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 5) -> Forest:
    """Trees of ``depth`` levels whose cuts are medians of the sample's rows in each node."""
    rng, dims, nodes = np.random.default_rng(seed), sample.shape[1], (1 << depth) - 1
    directions = rng.standard_normal((trees, nodes, dims))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    forest = Forest(directions, np.zeros((trees, nodes)), np.ones((trees, nodes)), depth)
    for t in range(trees):
        members = {0: np.arange(len(sample))}
        for node in range(nodes):
            rows = members.pop(node)
            p = np.einsum("nd,d->n", sample[rows], directions[t, node])
            if len(rows):
                forest.cuts[t, node], spread = np.median(p), p.std()
                forest.spreads[t, node] = spread if spread > 0 else 1.0
            right = p > forest.cuts[t, node]
            members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return forest


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, component after component."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def _best(q: np.ndarray, x: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, exact score) of every query's best ``k`` rows, and of more where scores are equal to the last."""
    s = q @ x.T
    slack = 1e-9 * (1 + np.abs(s).max(initial=0))
    floor = np.full(len(q), -np.inf) if least is None else least - slack
    if s.shape[1] > k:
        floor = np.maximum(floor, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - slack)
    i, j = np.nonzero(s >= floor[:, None])
    return i, j, exact_scores(q[i], x[j])


def distinct_vectors(df: DataFrame, id_col: str, vec_col: str, keep: int) -> tuple[DataFrame, DataFrame, int]:
    """(written rows, written distinct vectors with their first ``keep`` ids, dimensions)."""
    use = df.filter(finite(F.col(vec_col)) & F.col(id_col).isNotNull() & F.exists(vec_col, lambda x: x != 0))
    use = use.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    dims = width(use, "v")
    single = use.schema["v"].dataType.elementType.simpleString() == "float"
    dtype = np.float32 if single else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = padded(b.column(1), dims, dtype) + dtype(0)  # one zero for both signs
            yield pa.RecordBatch.from_arrays([b.column(0), binary_rows(x)], ["id", "vec"])
    rows = written(use.mapInArrow(pack, "id long, vec binary").withColumn("rid", F.xxhash64("vec")), "ann-rows")
    first = Window.partitionBy("rid", "vec").orderBy("id")
    few = rows.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= keep)
    return rows, written(few.groupBy("rid", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "ann-distinct"), dims, dtype


def sampled_forest(reps: DataFrame, n: int, dims: int, dtype) -> Forest:
    depth = 0
    while depth < MAX_DEPTH and (n >> depth) > LEAF_ROWS and (TREES << (depth + 1)) * dims <= MAX_WEIGHTS:
        depth += 1
    share = max(1, n // (SAMPLE_PER_LEAF << depth))
    got = reps.filter(F.pmod(F.xxhash64("rid", F.lit(3)), F.lit(share)) == 0).select("vec").toArrow()
    sample = matrix(got.column(0), dtype).astype(np.float64) if got.num_rows else np.zeros((0, dims))
    return fit_forest(sample, depth)


def index_rows(reps: DataFrame, forest, dtype) -> DataFrame:
    """Every distinct vector once a tree: (tree, leaf, rid, first, vec), written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for b in slices(batches, 4096):
            leaf = f.leaves(matrix(b.column(1), dtype).astype(np.float64))
            for t in range(leaf.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), t, np.int32)), pa.array(leaf[:, t].astype(np.int32)),
                                                  b.column(0), b.column(2), b.column(1)], ["tree", "leaf", "rid", "first", "vec"])
    return written(reps.select("rid", "vec", F.col("ids")[0].alias("first")).mapInArrow(
        run, "tree int, leaf int, rid long, first long, vec binary"), "ann-index")


def measured_effort(reps: DataFrame, queries: DataFrame, forest, sizes: np.ndarray, k: int, target: float, dtype) -> float:
    """The rows a walk must take to reach ``target`` of the exact ``k`` neighbours of a few queries."""
    got = queries.orderBy(F.xxhash64("rid", F.lit(9))).limit(TUNING).select("rid", "vec").toArrow()
    if not got.num_rows:
        return 0.0
    own, q = got.column(0).to_numpy(), matrix(got.column(1), dtype).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for b in slices(batches, 4096):
            x, rid = matrix(b.column(1), dtype).astype(np.float64), b.column(0).to_numpy()
            i, j, s = _best(q, x, k + 1)
            other = rid[j] != own[i]
            i, j, s = i[other], j[other], s[other]
            leaf = f.leaves(x[j])
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(rid[j]), pa.array(s), pa.array(list(leaf.astype(np.int64)), pa.list_(pa.int64()))],
                                             ["q", "rid", "s", "leaf"])
    near = reps.select("rid", "vec").mapInArrow(run, "q long, rid long, s double, leaf array<long>")
    best = Window.partitionBy("q").orderBy(F.col("s").desc(), "rid")
    near = near.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= k).select("q", "leaf").collect()
    f = forest.value
    f.sizes = sizes
    margins, needed, reached = f.margins(q), [], {}
    for i in range(len(q)):
        held = 0
        for t, leaf in f.walk(margins[i], np.inf):
            held += sizes[t, leaf]
            reached[i, t, leaf] = held
    needed = sorted(min(reached[r["q"], t, leaf] for t, leaf in enumerate(r["leaf"])) for r in near)
    return float(needed[min(len(needed) - 1, int(target * len(needed)))]) if needed else 0.0


def _walks(queries: DataFrame, forest, sizes: np.ndarray, effort: float, dtype) -> DataFrame:
    """(rid, tree, leaf, turn): the leaves that each query's walk takes, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        f.sizes = sizes
        for b in slices(batches, 256):
            margins = f.margins(matrix(b.column(1), dtype).astype(np.float64))
            for i, rid in enumerate(b.column(0).to_pylist()):
                at = np.array(f.walk(margins[i], effort), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), rid)), pa.array(at[:, 0]), pa.array(at[:, 1]),
                                                  pa.array(np.arange(len(at), dtype=np.int32))], ["rid", "tree", "leaf", "turn"])
    return queries.select("rid", "vec").mapInArrow(run, "rid long, tree int, leaf int, turn int")


def _search(index: DataFrame, asked: DataFrame, k: int, dtype) -> DataFrame:
    """(rid, candidate, first, score) of leaves and the queries (rid, vec, least) that ask for them."""
    spark = index.sparkSession
    held = index.groupBy("tree", "leaf").count().collect()                    # at most trees x 2 ** MAX_DEPTH rows
    wants = {(r["tree"], r["leaf"]): r["count"] for r in asked.groupBy("tree", "leaf").count().collect()}
    parts = [(r["tree"], r["leaf"], -(-r["count"] // PART_ROWS), -(-wants[r["tree"], r["leaf"]] // PART_QUERIES))
             for r in held if (r["tree"], r["leaf"]) in wants]
    cut = F.broadcast(spark.createDataFrame(parts, "tree int, leaf int, parts int, qparts int"))

    def spread(df, own, other):
        mine = F.pmod(F.xxhash64("rid", F.lit(1)), F.col(own)).cast("int").alias(f"in_{own}")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"in_{other}")
        return df.join(cut, ["tree", "leaf"]).select(*[c for c in df.columns if c != "turn"], mine, every)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x, q = matrix(left.column("vec"), dtype).astype(np.float64), matrix(right.column("vec"), dtype).astype(np.float64)
        rid, first, asking, least = left.column("rid").to_numpy(), left.column("first").to_numpy(), right.column("rid").to_numpy(), right.column("least").to_numpy()
        found = []
        if len(x) and len(q):
            for a in range(0, len(q), 256):
                i, j, s = _best(q[a:a + 256], x, k, least[a:a + 256])
                found.append((asking[a + i], rid[j], first[j], s))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("rid", "candidate", "first", "score"), cols)))
    key = ["tree", "leaf", "in_parts", "in_qparts"]
    return (spread(index, "parts", "qparts").groupBy(*key).cogroup(spread(asked, "qparts", "parts").groupBy(*key))
            .applyInArrow(run, "rid long, candidate long, first long, score double"))


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = 20,
            target: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product that the forest finds for
    each row whose id is divisible by ``every``."""
    spark = df.sparkSession
    on_workers(spark)
    rows, reps, dims, dtype = distinct_vectors(df, id_col, vec_col, k + 1)
    n = reps.count()
    asking = rows.filter(F.col("id") % every == 0)
    queries = written(asking.select("rid", "vec").distinct(), "ann-queries")
    shape = sampled_forest(reps, n, dims, dtype)
    forest = spark.sparkContext.broadcast(shape)                              # bounded by MAX_WEIGHTS
    index = index_rows(reps, forest, dtype)
    sizes = np.zeros((TREES, 1 << shape.depth), np.int64)
    for r in index.groupBy("tree", "leaf").count().collect():                 # as many as leaves
        sizes[r["tree"], r["leaf"]] = r["count"]
    effort = measured_effort(reps, queries, forest, sizes, k, target, dtype)
    walks = written(_walks(queries, forest, sizes, effort, dtype), "ann-walks")

    best = Window.partitionBy("rid").orderBy(F.col("score").desc(), "first", "candidate")
    seeds = walks.filter(F.col("turn") < SEEDS).join(queries, "rid").withColumn("least", F.lit(float("-inf")))
    early = written(_search(index, seeds, k + 1, dtype), "ann-seeds")
    floor = (early.select("rid", "candidate", "score").distinct()
             .withColumn("k", F.row_number().over(Window.partitionBy("rid").orderBy(F.col("score").desc())))
             .filter(F.col("k") == k + 1).select("rid", F.col("score").alias("least")))
    later = (walks.filter(F.col("turn") >= SEEDS).join(queries, "rid").join(floor, "rid", "left")
             .withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
    found = early.unionByName(_search(index, later, k + 1, dtype))
    # a candidate comes at most once a tree
    some = found.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= TREES * (k + 1)).drop("k").distinct()
    some = some.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= k + 1).select("rid", "candidate", "score")
    named = some.join(reps.select(F.col("rid").alias("candidate"), "ids"), "candidate").select("rid", "score", F.explode("ids").alias("id"))
    named = named.withColumn("k", F.row_number().over(Window.partitionBy("rid").orderBy(F.col("score").desc(), "id"))).filter(F.col("k") <= k + 1)
    lists = named.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("k", "id", "score"))).alias("found"))
    out = asking.select("id", "rid").distinct().join(lists, "rid").select(
        F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k).alias("found"))
    return out.select("query_id", F.posexplode("found").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
