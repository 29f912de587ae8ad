"""The prefix trie of rebuilt conversations, with subtree totals by centroid decomposition.

``rebuild`` gives every conversation the first turns of its group's first one. A trie node is a
distinct sequence of first turns; its name is (depth, smallest member). Prefixes are known by two
running sums of 64-bit hashes that include the place of each turn, so a conversation of any length
is summed in pieces of ``PIECE_TURNS`` turns and never gathered.

Totals over subtrees (childless nodes, saved tokens) come from a centroid decomposition of the
forest of parent edges. Each node weighs the turns that lie on it; the weight of a subtree is then a
plain sum over its members, known before any rollup. A component heavier than ``PIECE`` is split by
one round of joins: its centroid is the lightest node that holds half of its weight; what the
centroid's subtree sums to is added along the path from the centroid to the component's top, whose
weights it leaves; each child's subtree becomes a component, and so does what is left above. Weights halve, so a
chain of n turns takes about log n rounds. Components of at most ``PIECE`` are split the same way
inside tasks, many of them to a task.

The digest of the conversations that end at a node needs their ids in order: they are joined to
text by id ranges of ``END_IDS`` and hashed piece after piece, so that a node at which very many end
streams through its task.

Null role or text is empty, null turns come first, and turns of the same number follow by role and
text; a repeated row is a turn of its own. Rows without conv_id belong to no conversation and take
no part. Texts of any length are reduced to hashes and a word count before any shuffle but that of the turns' order. An
empty table has no nodes. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.llm.common import on_workers, word_count, written
from oeeflow.operators.windows import global_position

GROUP = 20             # conversations that share their first turns
PIECE = 65_536         # weight up to which a component is split inside a task
PIECE_TURNS = 4096
END_IDS = 16_384

VALUES = ["leaves", "saved"]
NODE = ["depth", "node"]


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv, length; their turns: conv, depth, h1, h2, words, length), both written."""
    t = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    placed = global_position(t, [("turn", True, False), ("role", True, False), ("text", True, False)], "pos", ["conv"])
    t1, t2 = F.xxhash64("role", "text"), F.xxhash64("text", F.lit("second"), "role")
    t = written(placed.select("conv", (F.col("pos") + 1).alias("pos"), t1.alias("t1"), t2.alias("t2"), word_count(F.col("text")).alias("words")),
                "trie-turns")
    sizes = t.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.withColumns({"h": F.crc32(F.col("conv").cast("string")) % 4, "base": F.col("conv") - F.col("conv") % GROUP})
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = written(convs.withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                    .select("conv", "base", "h", "head", "length"), "trie-convs")
    first = (t.filter("pos <= 3").withColumnRenamed("conv", "base").join(convs, "base").filter("pos <= head")
             .select("conv", F.col("pos").alias("depth"), "t1", "t2", "words", "length"))
    own = (t.join(convs, "conv").filter("pos > h")
           .select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("depth"), "t1", "t2", "words", "length"))
    rows = first.unionByName(own).withColumns({
        "p1": F.xxhash64("depth", "t1", "t2").cast("decimal(20,0)"), "p2": F.xxhash64("t2", "depth", "t1").cast("decimal(20,0)"),
        "piece": F.expr(f"(depth - 1) div {PIECE_TURNS}")})
    rows = written(rows.drop("t1", "t2"), "trie-rows")
    run = Window.partitionBy("conv", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # pieces of conversations that have more than one: few rows
    sums = (rows.filter(F.col("length") > PIECE_TURNS).groupBy("conv", "piece").agg(F.sum("p1").alias("s1"), F.sum("p2").alias("s2"))
            .select("conv", "piece", F.sum("s1").over(before).alias("o1"), F.sum("s2").over(before).alias("o2")))
    rows = rows.withColumns({c: F.sum(c).over(run) for c in ("p1", "p2")}).join(sums, ["conv", "piece"], "left")

    def key(p, o):
        return (F.col(p) + F.coalesce(F.col(o), F.lit(0).cast("decimal(30,0)"))).cast("decimal(38,0)").alias(p)
    return convs.select("conv", "length"), rows.select("conv", "depth", key("p1", "o1"), key("p2", "o2"), "words", "length")


def trie(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: depth, node, parent, n_convs, n_children, weight, leaves, saved; paths: conv, depth, node,
    parent), written. ``weight`` is that of the node's whole subtree."""
    named = rows.groupBy("depth", "p1", "p2").agg(
        F.min("conv").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    named = written(named, "trie-names")
    on = written(rows.select("conv", "depth", "p1", "p2").join(named.select("depth", "p1", "p2", "node"), ["depth", "p1", "p2"])
                 .select("conv", "depth", "node"), "trie-on")
    root = convs.agg(F.min("conv").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")).filter("n_convs > 0")
    above = on.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    top = F.broadcast(root.select(F.col("node").alias("root")))                # one row
    paths = on.join(above, ["conv", "depth"], "left").crossJoin(top).select(
        "conv", "depth", "node", F.coalesce("parent", "root").alias("parent"))
    paths = written(paths, "trie-paths")
    nodes = named.join(paths.filter("conv = node").select("depth", "node", "parent"), NODE).select(
        *NODE, "parent", "n_convs", "weight", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    nodes = nodes.unionByName(root.select(F.lit(0).cast("long").alias("depth"), "node", F.lit(None).cast("long").alias("parent"),
                                          "n_convs", "weight", F.lit(0).cast("long").alias("saved")))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    return written(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "trie-nodes"), paths


def _split_heavy(live: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over components that are all heavier than ``PIECE``: (their centroids with final sums,
    all other nodes with new components, weights and sums)."""
    comp = ["top_depth", "top"]
    total = live.groupBy(*comp).agg(F.max("weight").alias("total"))
    at = F.struct("weight", "depth", "node")
    cents = (live.join(total, comp).filter("2 * weight >= total").groupBy(*comp).agg(F.min(at).alias("c"))
             .select(*comp, F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"), F.col("c.weight").alias("c_weight")))
    cents = written(cents, "trie-centroids")
    # below the centroid: the node's path leads through one of the centroid's children
    steps = paths.select(F.col("conv").alias("node"), F.col("depth").alias("step"), F.col("node").alias("child"), F.col("parent").alias("child_of"))
    placed = live.join(cents, comp).withColumn("step", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1))
    placed = placed.join(steps, ["node", "step"], "left")
    placed = placed.withColumns({"is_c": (F.col("depth") == F.col("c_depth")) & (F.col("node") == F.col("c_node")),
                                 "below": F.coalesce(F.col("child_of") == F.col("c_node"), F.lit(False))})
    placed = written(placed.drop("child_of"), "trie-placed")
    sums = placed.filter("is_c or below").groupBy(*comp).agg(*[F.sum(v).alias(f"t_{v}") for v in VALUES])
    known = written(cents.join(sums, comp), "trie-sums")
    # from the centroid to its component's top: the path of the conversation that names the centroid
    ways = known.select(F.col("c_node").alias("conv"), "c_depth", "top_depth", "c_weight", *[f"t_{v}" for v in VALUES])
    up = paths.select("conv", "depth", "node").join(ways, "conv").filter("depth between top_depth and c_depth")
    root = ways.filter("top_depth = 0").join(paths.filter("depth = 1").select("conv", F.col("parent").alias("node")), "conv").withColumn("depth", F.lit(0).cast("long"))
    itself = known.filter("c_depth = 0").select(*[c for c in ("c_depth", "top_depth", "c_weight") + tuple(f"t_{v}" for v in VALUES)],
                                                 F.col("c_node").alias("conv"), F.col("c_node").alias("node"), F.col("c_depth").alias("depth"))
    up = up.unionByName(root.filter("c_depth > 0").select(up.columns)).unionByName(itself.select(up.columns))
    up = up.select(*NODE, F.col("c_weight").alias("less"), *[f"t_{v}" for v in VALUES])
    moved = placed.join(up, NODE, "left").withColumns({
        **{f"sum_{v}": F.col(f"sum_{v}") + F.coalesce(f"t_{v}", F.lit(0)) for v in VALUES},
        "weight": F.col("weight") - F.when(~F.col("is_c"), F.coalesce("less", F.lit(0))).otherwise(0),
        "top_depth": F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")),
        "top": F.when(F.col("below"), F.col("child")).otherwise(F.col("top"))})
    moved = written(moved.select(*live.columns, "is_c"), "trie-round")
    return moved.filter("is_c").drop("is_c"), moved.filter("NOT is_c").drop("is_c")


def split_in_memory(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of a small forest (``parent`` -1 at tops; ``weight`` of whole subtrees) by the same decomposition."""
    parent, weight = parent.tolist(), weight.tolist()
    children: list[list[int]] = [[] for _ in parent]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    out = np.zeros_like(values)
    todo = [i for i, p in enumerate(parent) if p < 0]
    while todo:
        top = c = todo.pop()
        half = weight[top] / 2
        while (heavy := next((x for x in children[c] if weight[x] >= half), None)) is not None:
            c = heavy
        below = [c]
        for x in below:
            below.extend(children[x])
        total = values[below].sum(axis=0) if len(below) > 1 else values[c]
        out[c] += total
        x = c
        while x != top:                                                     # the centroid-to-top path
            x = parent[x]
            out[x] += total
            weight[x] -= weight[c]
        todo.extend(children[c])
        if c != top:
            children[parent[c]].remove(c)
            todo.append(top)
        children[c] = []
    return out


def _split_light(light: DataFrame) -> DataFrame:
    """(depth, node, leaves, saved) of nodes in components of at most ``PIECE``: whole subtree sums."""
    n = light.count()
    buckets = max(1, -(-n // (PIECE // 4)))

    def run(t: pa.Table) -> pa.Table:
        depth, node, up = (t.column(c).to_numpy() for c in ("depth", "node", "parent"))
        place = {k: i for i, k in enumerate(zip(depth.tolist(), node.tolist()))}
        is_top = (depth == t.column("top_depth").to_numpy()) & (node == t.column("top").to_numpy())
        parent = np.array([-1 if at_top else place[k] for at_top, k in zip(is_top, zip((depth - 1).tolist(), up.tolist()))])
        sums = split_in_memory(parent, t.column("weight").to_numpy(), np.stack([t.column(v).to_numpy() for v in VALUES], axis=1))
        return pa.table({"depth": depth, "node": node, **{v: sums[:, k] + t.column(f"sum_{v}").to_numpy() for k, v in enumerate(VALUES)}})
    light = light.withColumns({"bucket": F.pmod(F.xxhash64("top_depth", "top"), F.lit(buckets)), "parent": F.coalesce("parent", F.lit(0).cast("long"))})
    return light.groupBy("bucket").applyInArrow(run, "depth long, node long, leaves long, saved long")


def subtree_sums(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(depth, node, leaves, saved): sums over the subtree of every node, itself included."""
    zero = F.lit(0).cast("long")
    first = F.broadcast(nodes.filter("depth = 0").select("depth", F.col("node").alias("top")))          # one row
    live = nodes.select(*NODE, "parent", "weight", *VALUES, *[zero.alias(f"sum_{v}") for v in VALUES]).crossJoin(
        first.select(F.col("depth").alias("top_depth"), "top"))
    comp, light, done = ["top_depth", "top"], None, None
    while True:
        heavy = live.groupBy(*comp).agg(F.max("weight").alias("w")).filter(F.col("w") > PIECE).select(*comp)
        heavy = written(heavy, "trie-heavy")
        small = live.join(heavy, comp, "left_anti")
        light = small if light is None else light.unionByName(small)
        if heavy.isEmpty():
            break
        cents, live = _split_heavy(live.join(heavy, comp, "left_semi"), paths)
        cents = cents.select(*NODE, *[F.col(f"sum_{v}").alias(v) for v in VALUES])
        done = cents if done is None else done.unionByName(cents)
    rest = _split_light(written(light, "trie-light"))
    return rest if done is None else rest.unionByName(done)


def end_digests(convs: DataFrame, paths: DataFrame, root: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of the nodes at which a conversation ends."""
    last = paths.join(convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]).select("conv", *NODE)
    none = convs.filter("length = 0").crossJoin(F.broadcast(root.select(*NODE))).select("conv", *NODE)  # one row
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")))
    pieces = (last.unionByName(none).groupBy(*NODE, F.floor(F.col("conv") / END_IDS).alias("piece")).agg(ids.alias("ids"))
              .repartition(*NODE).sortWithinPartitions(*NODE, "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, out = None, None, []
        for b in batches:
            for key, ids in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2).to_pylist()):
                if key != own:
                    if own is not None:
                        out.append((*own, digest.hexdigest()))
                    own, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield rows(out)
            out = []
        if own is not None:
            yield rows([(*own, digest.hexdigest())])

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                          ["depth", "node", "ends_sha256"])
    return pieces.select(*NODE, "ids").mapInArrow(run, "depth long, node long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    on_workers(turns.sparkSession)
    convs, rows = rebuild(turns)
    nodes, paths = trie(convs, written(rows, "trie-prefixes"))
    sums = subtree_sums(nodes, paths).select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = end_digests(convs, paths, nodes.filter("depth = 0"))
    out = nodes.select(*NODE, "parent", "n_convs", "n_children").join(sums, NODE).join(ends, NODE, "left")
    return out.select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
