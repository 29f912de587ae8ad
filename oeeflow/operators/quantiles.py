"""Exact quantiles (linear interpolation) as distributed order statistics.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer, which does
not scale to a hot group. Here a ``percentile_approx`` bracket [lo, hi] is taken around each
target rank (its rank error is at most n/accuracy, the bracket is three times wider). One
aggregate counts the rows of each distinct value inside the bracket and, as one row each, those
below and above it with the nearest value on that side; running counts over these few rows give
the two order statistics. Tied values are one row however many they are. The value is
interpolated as ``v0 + (v1 - v0) * (h - floor(h))`` with ``h = p * (n - 1)``; a rank that the rows
do not cover is an error, never a NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.operators.windows import _join_on

DEFAULT_ACCURACY = 100000


def _name(p: float) -> str:
    s = f"{p:.6f}".rstrip("0").rstrip(".").replace("0.", "").replace(".", "_")
    return f"q{s}" if s else "q0"


def quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
              names: list[str] | None = None, approx: bool = False,
              accuracy: int = DEFAULT_ACCURACY, few_groups: bool = False) -> DataFrame:
    """One row per group (or one row) with a column per probability. ``few_groups``: the number of groups
    does not grow with the data, so that no row is shuffled to find its group's bracket.

    NULL values are skipped; groups without values are absent. ``approx=True`` returns
    ``percentile_approx`` directly (one pass, bounded memory, rank error n/accuracy).
    """
    by = list(by or [])
    names = names or [_name(p) for p in probs]
    v = df.select(*by, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    if approx:
        apx = F.percentile_approx("_x", F.array(*[F.lit(float(p)) for p in probs]), accuracy)
        return (v.groupBy(*by).agg(apx.alias("_a"))
                .select(*by, *[F.col("_a")[i].alias(n) for i, n in enumerate(names)]))

    eps = 3.0 / accuracy
    pcts = [x for p in probs for x in (max(0.0, p - eps), min(1.0, p + eps))]
    stats = v.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", F.array(*[F.lit(x) for x in pcts]), accuracy).alias("_a"))
    per_p = [F.struct(F.lit(i).alias("_pi"), F.lit(float(p)).alias("_p"), F.col("_a")[2 * i].alias("_lo"),
                      F.col("_a")[2 * i + 1].alias("_hi")) for i, p in enumerate(probs)]
    bounds = (stats.select(*by, "_n", F.explode(F.array(*per_p)).alias("_b"))
              .select(*by, "_n", "_b.*")
              .withColumn("_h", F.col("_p") * (F.col("_n") - 1))
              .withColumn("_r0", F.floor("_h").cast("bigint"))
              .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1)))
    j = _join_on(v, F.broadcast(bounds) if not by or few_groups else bounds, by)  # without groups a row per probability
    return _picked(j, by, names)


def medians(df: DataFrame, values: list[str], by: list[str], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """The median of each of ``values`` per group (NULL without values), as :func:`quantiles` gives it. A row meets its group's
    brackets once, before its values are put below each other: what is shuffled does not grow by their number."""
    eps = 3.0 / accuracy
    v = df.select(*by, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(values)])
    around = F.array(F.lit(0.5 - eps), F.lit(0.5 + eps))
    stats = v.groupBy(*by).agg(*[a for i in range(len(values)) for a in (
        F.count(f"_x{i}").alias(f"_n{i}"), F.percentile_approx(f"_x{i}", around, accuracy).alias(f"_a{i}"))])
    each = [F.struct(F.lit(i).alias("_pi"), F.col(f"_x{i}").alias("_x"), F.col(f"_n{i}").alias("_n"), F.col(f"_a{i}")[0].alias("_lo"),
                     F.col(f"_a{i}")[1].alias("_hi")) for i in range(len(values))]
    j = _join_on(v, stats, by).select(*by, F.inline(F.array(*each))).filter(F.col("_x").isNotNull())
    j = (j.withColumn("_h", F.lit(0.5) * (F.col("_n") - 1)).withColumn("_r0", F.floor("_h").cast("bigint"))
         .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1)))
    return _picked(j, by, values)


def _picked(j: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The quantiles from the values beside their brackets and ranks (``_pi`` numbers the quantile of ``names``)."""
    side = F.when(F.col("_x") < F.col("_lo"), -1).when(F.col("_x") > F.col("_hi"), 1).otherwise(0)
    counts = (j.withColumn("_side", side).withColumn("_v", F.when(F.col("_side") == 0, F.col("_x")))
              .groupBy(*by, "_pi", "_h", "_r0", "_r1", "_side", "_v")
              .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_least"), F.max("_x").alias("_most")))
    # at most 6 n / accuracy distinct values a group and probability, and two rows for the rest
    w = Window.partitionBy(*by, "_pi").orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))

    def _at(r):  # the row that holds 0-based rank r; of the rows below only the last is known, of those above the first
        known = (F.when(F.col("_side") == -1, F.col(r) == F.col("_end") - 1).when(F.col("_side") == 1, F.col(r) == F.col("_start"))
                 .otherwise((F.col(r) >= F.col("_start")) & (F.col(r) < F.col("_end"))))
        return F.max(F.when(known, F.when(F.col("_side") == -1, F.col("_most")).otherwise(F.col("_least"))))
    g = ranked.groupBy(*by, "_pi", "_h", "_r0", "_r1").agg(_at("_r0").alias("_v0"), _at("_r1").alias("_v1"))
    v0, v1 = F.col("_v0"), F.col("_v1")
    q = (F.when(v0.isNull() | v1.isNull(), F.raise_error(F.lit("quantiles: a rank lies outside its bracket")).cast("double"))
         .when(F.col("_h") == F.col("_r0"), v0).otherwise(v0 + (v1 - v0) * (F.col("_h") - F.col("_r0"))))
    picked = g.select(*by, "_pi", q.alias("_q"))
    return (picked.groupBy(*by)
            .agg(*[F.max(F.when(F.col("_pi") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]))


def median(df: DataFrame, value: str, by: list[str] | None = None, name: str = "median",
           approx: bool = False) -> DataFrame:
    return quantiles(df, value, [0.5], by=by, names=[name], approx=approx)
