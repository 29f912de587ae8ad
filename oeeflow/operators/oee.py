"""OEE = availability × performance × quality (I1-I5) and lost hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oeeflow.functions.scalars import clip, clip_lower
from oeeflow.schema import OEE_ACCEPTABLE, OEE_CLASSES, OEE_OPTIMAL


def availability_expr() -> Column:
    """(setup + work − stops)⁺ / (setup + work); NULL when the planned time ≤ 0."""
    planned = F.col("setup_hours") + F.col("work_hours")
    stops = F.coalesce(F.col("stop_hours"), F.lit(0.0))
    operating = clip_lower(planned - stops, 0.0)
    return clip(F.when(planned > 0, operating / planned), 0.0, 1.0)


def performance_expr(df: DataFrame) -> Column:
    """1 / index (index 0 → NULL), else theoretical / actual hours; clipped to [0, 1]."""
    if "inefficiency" in df.columns:
        perf = F.lit(1.0) / F.nullif(F.col("inefficiency"), F.lit(0.0))
    else:
        perf = F.col("theoretical_hours") / F.nullif(F.col("work_hours"), F.lit(0.0))
    return clip(perf, 0.0, 1.0)


def quality_expr() -> Column:
    """(pieces − scraps − reworked)⁺ / pieces; NULL scraps count as 0."""
    pieces = F.col("pieces_counted")
    scraps = (F.coalesce(F.col("scrap_material"), F.lit(0)) + F.coalesce(F.col("scrap_machining"), F.lit(0))
              + F.coalesce(F.col("pieces_reworked"), F.lit(0)))
    good = clip_lower(pieces - scraps, 0.0)
    return clip(F.when(pieces > 0, good / pieces), 0.0, 1.0)


def oee_class_expr(c: str | Column = "oee", acceptable: float = OEE_ACCEPTABLE,
                   optimal: float = OEE_OPTIMAL, closed: str = "right") -> Column:
    """OEE class. ``closed='right'``: ≤0.65 Critico, ≤0.85 Accettabile (binning of I4);
    ``closed='left'``: <0.65, <0.85 (the KPI edges)."""
    x = F.col(c) if isinstance(c, str) else c
    lo, hi = (x <= acceptable, x <= optimal) if closed == "right" else (x < acceptable, x < optimal)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(lo, F.lit(OEE_CLASSES[0])).when(hi, F.lit(OEE_CLASSES[1])).otherwise(F.lit(OEE_CLASSES[2])))


def oee_class_rank(c: str | Column = "oee_class") -> Column:
    """Order of the classes: Critico 0 < Accettabile 1 < Ottimo 2."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.when(x == OEE_CLASSES[0], 0).when(x == OEE_CLASSES[1], 1)
            .when(x == OEE_CLASSES[2], 2))


def oee_availability(df: DataFrame) -> DataFrame:
    return df.withColumn("availability", availability_expr())


def oee_performance(df: DataFrame) -> DataFrame:
    return df.withColumn("performance", performance_expr(df))


def oee_quality(df: DataFrame) -> DataFrame:
    return df.withColumn("quality", quality_expr())


def compute_oee(df: DataFrame) -> DataFrame:
    """I4: the three components, their product and the (right-closed) class.

    Built in staged projections over named columns: each clip then reads an attribute, not
    a copy of a nested expression, which keeps the generated code small."""
    planned = F.col("setup_hours") + F.col("work_hours")
    scraps = (F.coalesce(F.col("scrap_material"), F.lit(0)) + F.coalesce(F.col("scrap_machining"), F.lit(0))
              + F.coalesce(F.col("pieces_reworked"), F.lit(0)))
    if "inefficiency" in df.columns:
        perf = F.lit(1.0) / F.nullif(F.col("inefficiency"), F.lit(0.0))
    else:
        perf = F.col("theoretical_hours") / F.nullif(F.col("work_hours"), F.lit(0.0))
    s1 = df.withColumns({"_planned": planned, "_good": F.col("pieces_counted") - scraps, "_perf": perf})
    s2 = s1.withColumns({
        "_op": clip_lower(F.col("_planned") - F.coalesce(F.col("stop_hours"), F.lit(0.0)), 0.0),
        "_good_c": clip_lower(F.col("_good"), 0.0)})
    s3 = s2.withColumns({
        "_a": F.when(F.col("_planned") > 0, F.col("_op") / F.col("_planned")),
        "_q": F.when(F.col("pieces_counted") > 0, F.col("_good_c") / F.col("pieces_counted"))})
    s4 = s3.withColumns({"availability": clip("_a", 0.0, 1.0), "performance": clip("_perf", 0.0, 1.0),
                         "quality": clip("_q", 0.0, 1.0)})
    s5 = s4.withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))
    out = s5.withColumn("oee_class", oee_class_expr("oee"))
    return out.drop("_planned", "_good", "_perf", "_op", "_good_c", "_a", "_q")


def oee_defined_expr(df: DataFrame) -> Column:
    """True exactly where :func:`compute_oee` gives a non-NULL OEE: planned time > 0, a
    non-zero performance ratio, pieces > 0. Filtering on the inputs keeps the predicate
    small (and pushable to a scan) instead of the whole OEE expression."""
    planned = (F.col("setup_hours") + F.col("work_hours")) > 0
    if "inefficiency" in df.columns:
        perf = F.col("inefficiency").isNotNull() & (F.col("inefficiency") != 0)
    else:
        perf = (F.col("theoretical_hours").isNotNull() & F.col("work_hours").isNotNull()
                & (F.col("work_hours") != 0))
    return planned & perf & (F.col("pieces_counted") > 0)


def oee_alerts(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Orders whose OEE or a component is below its limit, with the list of reasons."""
    th = thresholds or {"oee": OEE_ACCEPTABLE, "availability": OEE_ACCEPTABLE,
                        "performance": OEE_ACCEPTABLE, "quality": OEE_ACCEPTABLE}
    names = [F.when(F.col(c) < t, F.lit(c)) for c, t in th.items()]
    reasons = F.array_except(F.array(*names), F.array(F.lit(None).cast("string")))
    # a filter on a generated column stays above it: below, it would carry a copy of the OEE for each clip
    out = df.select("*", F.inline(F.array(F.struct(reasons.alias("alert_reasons")))))
    return out.filter(F.size("alert_reasons") > 0)


def lost_hours_expr(actual: str = "work_hours", theoretical: str = "cycle_hours") -> Column:
    """max(actual − theoretical, 0), NULL when either is NULL.

    The reference subtracts the per-piece cycle hours (``cycle_hours``, the default);
    ``theoretical='theoretical_hours'`` gives the whole-order comparison.
    """
    return clip_lower(F.col(actual) - F.col(theoretical), 0.0)


def lost_hours(df: DataFrame, actual: str = "work_hours", theoretical: str = "cycle_hours") -> DataFrame:
    return df.withColumn("lost_hours", lost_hours_expr(actual, theoretical))
