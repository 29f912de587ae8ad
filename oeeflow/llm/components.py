"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oeeflow.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node.

    Every round joins the edges with one minimum per node (partially aggregated, so a node with a
    large share of the edges costs one row per task) and is written to the shared folder. Stops
    when a round changes nothing.
    """
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct()
    e, before = written(e, "components"), None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if before is not None and state == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
        before = state
        both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).withColumnsRenamed({"hi": "u", "lo": "v"})
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        e = written(small.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                    .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
