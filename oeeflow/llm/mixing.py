"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order (by the MD5 of seed and id), repeated
up to ``max_epochs`` times. A document's virtual finish time in pass k is
``(k * source_size + cumulative source tokens) / target``; the mix is all passes sorted by finish
time, cut where the total budget is used up. Nothing sorts a whole source or the whole mix in one
task: a source's running sum is made of sums per hash bucket, the cut is found from sums per
virtual-time bin, and only the bin that holds the cut is ordered row by row.

Defined results: a null source is a source of its own, ranked last; null ids and repeated rows are
documents like any other (equal rows are interchangeable); documents of size 0 are never taken
and a source of size 0 has target 0; an empty table gives an empty result. The tables of sources
(one row each) and of time bins are ordered in one task; both are small beside the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.llm.common import written

BUCKET_BITS = 12   # a source's running sum is put together from 2**12 hash buckets
BINS = 4096        # virtual-time bins in each unit of virtual time


def _source_key(source: Column) -> Column:
    """A never-null key; null differs from every string and sorts last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(per_source: DataFrame, max_epochs: int = 3, budget: int | None = None,
                   weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``per_source`` (skey, source_size) with ``weight`` and ``target``. Sources by code point
    take ``weights`` in turn and share ``budget`` (default: the sum of all sizes) by weight; a
    target stops at ``max_epochs * source_size`` and the excess goes to the others by weight."""
    ranked = per_source.withColumn("_r", F.row_number().over(Window.orderBy("skey")))
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, ((F.col("_r") - 1) % len(weights) + 1).cast("int")))
    total = F.lit(budget) if budget is not None else F.sum("source_size").over(Window.partitionBy())
    cap = F.col("source_size") * max_epochs
    fill = Window.orderBy("_full_at", "skey")
    level = (ranked.withColumn("_budget", total.cast("long")).withColumn("_cap", cap.cast("long"))
             .withColumn("_full_at", F.col("_cap") / F.col("weight"))
             .withColumn("_before", F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("_level", (F.col("_budget") - F.col("_before")) / F.col("_open")))
    # the water level: that of the first source, by fullness, which stays below its cap
    first = F.min(F.when(F.col("_full_at") > F.col("_level"), F.struct("_full_at", "skey", "_level"))).over(Window.partitionBy())
    target = F.coalesce(F.least(F.col("_cap").cast("double"), first["_level"] * F.col("weight")), F.col("_cap").cast("double"))
    return level.select("skey", "source_size", "weight", target.alias("target"))


def _bin(finish: Column) -> Column:
    """Monotone bin of a finish time: even bins up to 4, logarithmic beyond (few in number)."""
    return F.when(finish < 4, F.floor(finish * BINS)).otherwise(
        F.floor((F.log2(F.greatest(finish, F.lit(4.0))) + 2) * BINS)).cast("long")


def mix_to_weights(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
                   max_epochs: int = 3, budget: int | None = None, weights: tuple[int, ...] = (1, 2, 3),
                   seed: str = "mix") -> DataFrame:
    """One row per document: id, size, source_size, target, ``passes`` (how often the mix takes
    it, 0 to ``max_epochs``), ``taken`` (size times passes) and ``virtual_finish`` (of pass 0)."""
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))), 1, 15), 16, 10).cast("long")
    rows = written(docs.select(
        F.col(id_col).alias("id"), _source_key(F.col(source_col).cast("string")).alias("skey"),
        F.coalesce(F.col(size_col).cast("long"), F.lit(0)).cast("long").alias("size"), key.alias("u"))
        .withColumn("bucket", F.expr(f"shiftright(u, {60 - BUCKET_BITS})")), "mix-sizes")

    buckets = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("in_bucket"))
    by_bucket = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = written(buckets.select("skey", "bucket", "in_bucket",
                                     F.coalesce(F.sum("in_bucket").over(by_bucket), F.lit(0)).alias("before")), "mix-buckets")
    targets = source_targets(buckets.groupBy("skey").agg(F.sum("in_bucket").alias("source_size")),
                             max_epochs, budget, weights)
    buckets = buckets.drop("in_bucket").join(targets, "skey")
    order = Window.partitionBy("skey", "bucket").orderBy("u", "id", "size")
    queued = rows.join(buckets, ["skey", "bucket"]).withColumn(
        "cum", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    queued = written(queued.select("id", "skey", "size", "source_size", "target", "cum"), "mix-queues")

    # double arithmetic: whole numbers stay exact up to 2**53 words a source
    def finish(k):
        return (F.col("source_size").cast("double") * k + F.col("cum")) / F.when(F.col("target") > 0, F.col("target"))

    passes = (queued.filter("size > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
              .withColumn("finish", finish(F.col("k"))).withColumn("bin", _bin(F.col("finish"))))
    total = (F.lit(budget) if budget is not None else F.sum("words").over(Window.partitionBy()) / max_epochs)
    bins = (passes.groupBy("bin").agg(F.sum("size").alias("words"))
            .withColumn("upto", F.sum("words").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("total", total.cast("long")))
    # the bin in which the budget runs out, and what is left of the budget when it begins
    cut_bin = bins.agg(F.min(F.when(F.col("upto") > F.col("total"), F.struct(
        F.col("bin"), (F.col("total") - F.col("upto") + F.col("words")).alias("room")))).alias("cut"))
    at_cut = (passes.crossJoin(F.broadcast(cut_bin)).filter(F.col("bin") == F.col("cut.bin"))
              .withColumn("used", F.sum("size").over(Window.partitionBy("bin").orderBy("finish", "skey", "id", "k", "size")
                                                      .rowsBetween(Window.unboundedPreceding, 0)))
              .filter(F.col("used") <= F.col("cut.room")))
    last = at_cut.agg(F.max(F.struct("finish", "skey", "id", "k", "size")).alias("last"))
    cut = F.broadcast(cut_bin.crossJoin(last))
    taken = F.lit(0)
    for k in range(max_epochs):
        here = F.struct(finish(k).alias("finish"), F.col("skey"), F.col("id"), F.lit(k).alias("k"), F.col("size"))
        b = _bin(finish(k))
        taken = taken + F.when(F.col("cut").isNull() | (b < F.col("cut.bin"))
                               | ((b == F.col("cut.bin")) & F.coalesce(here <= F.col("last"), F.lit(False))), 1).otherwise(0)
    out = queued.crossJoin(cut).withColumn("passes", F.when(F.col("size") > 0, taken).otherwise(0).cast("int"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * F.col("passes")).cast("long").alias("taken"), "passes",
                      finish(0).alias("virtual_finish"))


def apply_mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each document as often as the mix takes it (its columns unchanged). Documents
    of size 0 are in no mix. Rows that share an id are taken equally often."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    passes = (mix_to_weights(sized, "id", "source", "size", **options).groupBy(F.col("id").alias("_mix_id"))
              .agg(F.max("passes").alias("_mix_passes")).filter("_mix_passes > 0"))
    return (docs.join(passes, docs[id_col].eqNullSafe(F.col("_mix_id")))
            .withColumn("_mix_pass", F.explode(F.sequence(F.lit(1), F.col("_mix_passes")))).select(*docs.columns))
