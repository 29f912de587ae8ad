"""Time, ratio, lag and rolling features.

Look-back features run per machine in the total order ``ORDER_COLS`` through
:func:`chunked_window`, so a machine with a very long history is cut into time chunks
instead of landing in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.operators.windows import DEFAULT_ROWS_PER_CHUNK, _join_on, chunked_window
from oeeflow.schema import ORDER_COLS, PARTITION_COLS


def add_time_features(df: DataFrame, ts: str = "end_ts") -> DataFrame:
    """H1: weekday (0 = Monday), month, ISO week, calendar year."""
    c = F.col(ts)
    return df.withColumns({"weekday": F.weekday(c), "month": F.month(c),
                           "iso_week": F.weekofyear(c), "year": F.year(c)})


def add_ratio_features(df: DataFrame) -> DataFrame:
    """Scrap ratio over counted pieces; ERP setup / ERP machine time; 0 divisors → NULL."""
    return df.withColumns({
        "scrap_ratio": (F.col("scrap_material") + F.col("scrap_machining"))
        / F.nullif(F.col("pieces_counted"), F.lit(0)),
        "erp_setup_machine_ratio": F.col("erp_setup_hours") / F.nullif(F.col("erp_machine_hours"), F.lit(0.0)),
    })


def add_rolling_and_lags(df: DataFrame, base: str, window: int = 10, lags: tuple[int, ...] = (1, 2, 3),
                         partition_by: list[str] | None = None, order_by: list[str] | None = None,
                         rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """E1 + E2: mean and sample std of the previous ``window`` values (at least one),
    and ``lag_k`` of ``base``; one window spec, so one shuffle and one sort."""
    part = list(partition_by or PARTITION_COLS)
    order = list(order_by or ORDER_COLS)
    cols = {
        f"rolling_mean_{window}": lambda w: F.avg(base).over(w.rowsBetween(-window, -1)),
        f"rolling_std_{window}": lambda w: F.stddev_samp(base).over(w.rowsBetween(-window, -1)),
    }
    for k in lags:
        cols[f"lag_{k}"] = (lambda kk: (lambda w: F.lag(base, kk).over(w)))(k)
    return chunked_window(df, part, order, cols, lookback=max(window, *lags), rows_per_chunk=rows_per_chunk)


def add_oee_rolling_and_lags(df: DataFrame, partition_by: list[str] | None = None,
                             order_by: list[str] | None = None,
                             rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """E3 + E4: per machine, mean of the previous 3 OEE values and OEE lags 1-3.

    Without an ``oee`` or ``machine`` column the four columns exist as typed NULLs.
    """
    names = ["rolling_oee_3", "lag_1_oee", "lag_2_oee", "lag_3_oee"]
    if "oee" not in df.columns or "machine" not in df.columns:
        return df.withColumns({n: F.lit(None).cast("double") for n in names})
    cols = {"rolling_oee_3": lambda w: F.avg("oee").over(w.rowsBetween(-3, -1))}
    for k in (1, 2, 3):
        cols[f"lag_{k}_oee"] = (lambda kk: (lambda w: F.lag("oee", kk).over(w)))(k)
    return chunked_window(df, list(partition_by or PARTITION_COLS), list(order_by or ORDER_COLS), cols,
                          lookback=3, rows_per_chunk=rows_per_chunk)


def smooth_times(df: DataFrame, cols: tuple[str, ...] = ("work_hours", "theoretical_hours", "erp_machine_hours"),
                 max_window: int = 15, min_window: int = 5, partition_by: list[str] | None = None,
                 order_by: list[str] | None = None,
                 rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """E5: trailing mean including the current row over w = max(min, min(max, n)) rows,
    n = rows of the group. With n < max_window the window spans the whole group."""
    part = list(partition_by or PARTITION_COLS)
    order = list(order_by or ORDER_COLS)
    n = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_grp_n"))
    d = _join_on(df, n, part)
    w_full = max_window - 1
    exprs = {}
    for c in cols:
        exprs[f"{c}_smooth"] = (lambda cc: (lambda w: F.when(
            F.col("_grp_n") >= max_window, F.avg(cc).over(w.rowsBetween(-w_full, 0)))
            .otherwise(F.avg(cc).over(w.rowsBetween(Window.unboundedPreceding, 0)))))(c)
    out = chunked_window(d, part, order, exprs, lookback=w_full, rows_per_chunk=rows_per_chunk)
    return out.drop("_grp_n")


def cycle_stats_by_article_phase(ref: DataFrame, keys: tuple[str, ...] = ("article", "phase"),
                                 value: str = "cycle_hours") -> DataFrame:
    """Mean and sample std of cycle hours per (article, phase); NULL keys dropped."""
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return (ref.filter(cond).groupBy(*keys)
            .agg(F.avg(value).alias("cycle_mean_art"), F.stddev_samp(value).alias("cycle_std_art")))


def cycle_history(ref: DataFrame, keys: tuple[str, ...] = ("article", "phase"), value: str = "cycle_hours") -> DataFrame:
    """The statistics of D11 in a form that can be saved and added to: per (article, phase) the rows with a
    value, their mean and their sum of squared deviations."""
    known = ref.filter(F.col(value).isNotNull() & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return known.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                    (F.var_pop(value) * F.count(value)).alias("squares"))


def merge_cycle_history(*parts: DataFrame, keys: tuple[str, ...] = ("article", "phase")) -> DataFrame:
    """One history of several: what :func:`cycle_history` gives for all their rows together."""
    every = reduce(DataFrame.unionByName, parts)
    whole = every.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)
    return (every.join(whole, list(keys)).groupBy(*keys, "_n", "_mean").agg(F.sum(apart).alias("squares"))
            .withColumnsRenamed({"_n": "n", "_mean": "mean"}))


def join_cycle_stats(df: DataFrame, history: DataFrame | None = None,
                     keys: tuple[str, ...] = ("article", "phase")) -> DataFrame:
    """Left join of the (article, phase) cycle statistics; a missing std becomes 0. ``history`` is a
    table of rows, or a saved :func:`cycle_history`: its groups come first, and a group that it does not
    know takes the statistics of ``df`` itself."""
    if history is not None and {"n", "mean", "squares"} <= set(history.columns):
        std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
        stats = history.select(*keys, F.col("mean").alias("cycle_mean_art"), F.coalesce(std, F.lit(0.0)).alias("cycle_std_art"))
        if "cycle_hours" in df.columns:
            own = cycle_stats_by_article_phase(df, keys).join(stats.select(*keys), list(keys), "left_anti")
            stats = stats.unionByName(own.select(*stats.columns))
        return df.join(stats, list(keys), "left").withColumn("cycle_std_art", F.coalesce("cycle_std_art", F.lit(0.0)))
    ref = history if history is not None else df
    if "cycle_hours" not in ref.columns:
        return df.withColumns({"cycle_mean_art": F.lit(None).cast("double"),
                               "cycle_std_art": F.lit(None).cast("double")})
    stats = cycle_stats_by_article_phase(ref, keys)
    out = df.join(stats, list(keys), "left")
    return out.withColumn("cycle_std_art", F.coalesce(F.col("cycle_std_art"), F.lit(0.0)))


def add_oee_features(df: DataFrame, history: DataFrame | None = None,
                     rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK, with_lags: bool = True) -> DataFrame:
    """OEE model features (shares of setup, stops and scrap, ERP ratio, cycle stats,
    OEE lags and rolling mean). ``with_lags=False`` skips the look-back window (the
    forecast rows replace those columns anyway)."""
    out = add_time_features(df) if "end_ts" in df.columns else df
    total = F.col("setup_hours") + F.col("work_hours")
    scraps = (F.coalesce(F.col("scrap_material"), F.lit(0)) + F.coalesce(F.col("scrap_machining"), F.lit(0))
              + F.coalesce(F.col("pieces_reworked"), F.lit(0)))
    out = out.withColumns({
        "pct_setup": F.when(total > 0, F.col("setup_hours") / total),
        "pct_stops": F.when(total > 0, F.coalesce(F.col("stop_hours"), F.lit(0.0)) / total).otherwise(F.lit(0.0)),
        "erp_setup_machine_ratio": F.col("erp_setup_hours") / F.nullif(F.col("erp_machine_hours"), F.lit(0.0)),
        "pct_scrap": F.when(F.col("pieces_counted") > 0, scraps / F.col("pieces_counted")),
    })
    out = join_cycle_stats(out, history)
    if not with_lags:
        return out
    return add_oee_rolling_and_lags(out, rows_per_chunk=rows_per_chunk)


def _drop_missing_lags(df: DataFrame, lags: tuple[int, ...]) -> DataFrame:
    return df.na.drop(how="any", subset=[f"lag_{k}" for k in lags])


def features_inefficiency(df: DataFrame, window: int = 10, lags: tuple[int, ...] = (1, 2, 3),
                          rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """I8: time → rolling/lag of the index → ratios → rows lacking a lag dropped."""
    out = add_time_features(df)
    out = add_rolling_and_lags(out, "inefficiency", window, lags, rows_per_chunk=rows_per_chunk)
    return _drop_missing_lags(add_ratio_features(out), lags)


features_classification = features_inefficiency


def features_hours(df: DataFrame, window: int = 10, lags: tuple[int, ...] = (1, 2, 3),
                   rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """I8: as :func:`features_inefficiency` with the actual hours as look-back base."""
    out = add_time_features(df)
    out = add_rolling_and_lags(out, "work_hours", window, lags, rows_per_chunk=rows_per_chunk)
    return _drop_missing_lags(add_ratio_features(out), lags)
