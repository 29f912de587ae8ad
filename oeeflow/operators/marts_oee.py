"""OEE report marts (D12-D16, D28-D29, E8, F1-F2). Input: rows after :func:`compute_oee`."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.functions.scalars import month_label, week_label
from oeeflow.operators.interact import filter_period
from oeeflow.operators.oee import compute_oee, oee_defined_expr
from oeeflow.operators.quantiles import medians
from oeeflow.operators.windows import _join_on
from oeeflow.schema import OEE_ACCEPTABLE, OEE_CLASSES, OEE_OPTIMAL, ORDER_COLS

COMPONENTS = ["oee", "availability", "performance", "quality"]


def prepare_oee(df: DataFrame) -> DataFrame:
    """OEE rows with a known OEE, plus ``month`` (``yyyy-MM``) and ``week`` (``Mon/Sun``) labels."""
    if "oee" in df.columns:
        o = df.filter(F.col("oee").isNotNull())
    else:
        o = compute_oee(df.filter(oee_defined_expr(df)))
    if "end_ts" in o.columns:
        o = o.withColumns({"month": month_label("end_ts"), "week": week_label("end_ts")})
    return o


def oee_monthly_trend(o: DataFrame, digits: int = 4) -> DataFrame:
    """Monthly means of OEE and its components."""
    return (o.filter(F.col("month").isNotNull()).groupBy("month")
            .agg(*[F.round(F.avg(c), digits).alias(c) for c in COMPONENTS]))


def oee_class_distribution(o: DataFrame) -> DataFrame:
    """Counts per class, ``display_order`` Ottimo 0, Accettabile 1, Critico 2; absent classes omitted."""
    order = (F.when(F.col("oee_class") == OEE_CLASSES[2], 0).when(F.col("oee_class") == OEE_CLASSES[1], 1)
             .when(F.col("oee_class") == OEE_CLASSES[0], 2))
    return (o.filter(F.col("oee_class").isNotNull()).groupBy("oee_class")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("display_order", order))


def oee_by_article(o: DataFrame, n: int = 15, digits: int = 4) -> DataFrame:
    """The ``n`` articles with the lowest mean OEE (top-k report)."""
    g = o.filter(F.col("article").isNotNull()).groupBy("article").agg(F.avg("oee").alias("_m"))
    return (g.filter(F.col("_m").isNotNull()).orderBy(F.asc("_m"), F.asc("article")).limit(n)
            .select("article", F.round("_m", digits).alias("oee")))


def oee_kpis(o: DataFrame) -> DataFrame:
    """Mean OEE/A/P/Q in %, orders below 0.65, orders at/above 0.85, total."""
    return o.agg(
        *[F.round(F.avg(c) * 100, 1).alias(f"{c}_pct") for c in COMPONENTS],
        F.count_if(F.col("oee") < OEE_ACCEPTABLE).alias("n_critical"),
        F.count_if(F.col("oee") >= OEE_OPTIMAL).alias("n_world_class"),
        F.count(F.lit(1)).alias("n_total"))


def oee_kpis_by_period(o: DataFrame, period: str = "all") -> DataFrame:
    """The KPI cards of a period: means of the 4-decimal values (NULLs skipped) in %,
    and class counts with the left-closed edges (< 0.65, < 0.85)."""
    p = filter_period(o, period)
    r = {c: F.round(F.col(c), 4) for c in COMPONENTS}
    return p.agg(
        *[F.round(F.avg(r[c]) * 100, 1).alias(f"{c}_pct") for c in COMPONENTS],
        F.count_if(r["oee"] >= OEE_OPTIMAL).alias("n_optimal"),
        F.count_if((r["oee"] >= OEE_ACCEPTABLE) & (r["oee"] < OEE_OPTIMAL)).alias("n_acceptable"),
        F.count_if(r["oee"] < OEE_ACCEPTABLE).alias("n_critical"),
        F.count(F.lit(1)).alias("n_orders"))


_TABLE_COLS = ["wo", "phase", "article", "end_ts", "oee", "oee_class", "availability", "performance", "quality"]


def _rounded(o: DataFrame, digits: int) -> list[Column]:
    out = []
    for c in _TABLE_COLS:
        if c not in o.columns:
            continue
        out.append(F.round(F.col(c), digits).alias(c) if c in COMPONENTS else F.col(c))
    return out


def worst_orders(o: DataFrame, n: int = 10, digits: int = 4) -> DataFrame:
    """F1: the ``n`` orders with the lowest OEE below 0.65 (top-k report)."""
    keys = [c for c in ORDER_COLS if c in o.columns]
    return (o.filter(F.col("oee") < OEE_ACCEPTABLE).orderBy(F.asc("oee"), *keys).limit(n)
            .select(*_rounded(o, digits)))


def oee_order_table(o: DataFrame, digits: int = 4) -> DataFrame:
    """every order with a valid OEE, date as ``yyyy-MM-dd`` (sorting is left to the sink)."""
    cols = []
    for c in _TABLE_COLS:
        if c not in o.columns:
            continue
        if c in COMPONENTS:
            cols.append(F.round(F.col(c), digits).alias(c))
        elif c == "end_ts":
            cols.append(F.date_format("end_ts", "yyyy-MM-dd").alias(c))
        else:
            cols.append(F.col(c))
    return o.select(*cols)


def last_n_per_group(df: DataFrame, keys: list[str], value: str, n: int = 3,
                     order_by: list[str] | None = None) -> DataFrame:
    """Per group, the last ``n`` non-NULL values in time order as ``{value}_last1..n``
    (1 = most recent). The limit on the row number is applied before the shuffle, too (Spark's window
    group limit), so a task sends ``n`` rows of a group however many it reads."""
    order = [c for c in (order_by or ORDER_COLS) if c in df.columns]
    # NULL values sort last and their groups go at the end: a filter would carry a copy of ``value``'s expression down
    latest = Window.partitionBy(*keys).orderBy(F.col(value).isNull(), *[F.col(c).desc() for c in order])
    d = df.select(*dict.fromkeys([*keys, *order, value]))
    d = d.withColumn("_r", F.row_number().over(latest)).filter(F.col("_r") <= n)
    out = d.groupBy(*keys).agg(*[F.max(F.when(F.col("_r") == i, F.col(value))).alias(f"{value}_last{i}") for i in range(1, n + 1)])
    return out.filter(F.col(f"{value}_last1").isNotNull())


# engine names of the OEE model features (fixed list, as the reference's feature list)
OEE_FEATURES = ["phase", "work_center_planned", "article_group", "qty_erp", "setup_hours",
                "erp_machine_hours", "erp_setup_hours", "cycle_hours", "erp_setup_machine_ratio",
                "pct_setup", "pct_stops", "pct_scrap", "cycle_mean_art", "cycle_std_art", "weekday",
                "month", "iso_week", "rolling_oee_3", "lag_1_oee", "lag_2_oee", "lag_3_oee"]
# columns known before an order runs; the others of OEE_FEATURES are measured while it runs
KNOWN_BEFORE = ["phase", "work_center_planned", "article_group", "qty_erp", "erp_machine_hours", "erp_setup_hours", "cycle_hours",
                "erp_setup_machine_ratio", "cycle_mean_art", "cycle_std_art", "weekday", "month", "iso_week",
                "rolling_oee_3", "lag_1_oee", "lag_2_oee", "lag_3_oee"]
FEATURE_SETS = {"as_is": OEE_FEATURES, "plan_only": KNOWN_BEFORE}
_CALENDAR = ["weekday", "month", "iso_week"]
_LAGS = ["rolling_oee_3", "lag_1_oee", "lag_2_oee", "lag_3_oee"]


def forecast_columns(fe: DataFrame, more: tuple[str, ...] = ()) -> list[str]:
    """The columns of ``fe`` that :func:`oee_forecast_features` reads, and ``more``: a written table holds no others."""
    return [c for c in fe.columns if c in {*OEE_FEATURES, *ORDER_COLS, "article", "phase", "oee", *more}]


def oee_forecast_features(fe: DataFrame, today: _dt.date, keys: tuple[str, ...] = ("article", "phase"),
                          feature_cols: list[str] | None = None) -> DataFrame:
    """One feature row per (article, phase) for next month's forecast: median of the
    numeric features, most frequent value (smallest on ties) of the categorical ones,
    calendar of the first day of next month, lags = last three OEE values, rolling = their mean."""
    keys = list(keys)
    feats = [c for c in (feature_cols or OEE_FEATURES) if c in fe.columns]
    d = fe.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()) if len(keys) > 1 else \
        fe.filter(F.col(keys[0]).isNotNull())
    num = [c for c in feats if c not in keys and c not in _CALENDAR and c not in _LAGS
           and dict(d.dtypes)[c] not in ("string",)]
    cat = [c for c in feats if c not in keys and dict(d.dtypes)[c] == "string"]
    base = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                *[F.mode(c, True).alias(c) for c in cat])
    med = medians(d, num, keys)
    out = _join_on(base, med, keys, "left")
    nxt = (today.replace(day=1) + _dt.timedelta(days=32)).replace(day=1)
    cal = {"month": nxt.month, "weekday": nxt.weekday(), "iso_week": nxt.isocalendar()[1]}
    out = out.withColumns({c: F.lit(v) for c, v in cal.items() if c in feats})
    if "oee" in fe.columns:
        last = last_n_per_group(d, keys, "oee", 3)
        out = _join_on(out, last, keys, "left")
        l1, l2, l3 = F.col("oee_last1"), F.col("oee_last2"), F.col("oee_last3")
        cnt = l1.isNotNull().cast("int") + l2.isNotNull().cast("int") + l3.isNotNull().cast("int")
        tot = F.coalesce(l1, F.lit(0.0)) + F.coalesce(l2, F.lit(0.0)) + F.coalesce(l3, F.lit(0.0))
        out = out.withColumns({"lag_1_oee": l1, "lag_2_oee": l2, "lag_3_oee": l3,
                               "rolling_oee_3": F.when(cnt > 0, tot / cnt)}).drop("oee_last1", "oee_last2", "oee_last3")
    return out


def oee_forecast(o: DataFrame, predictions: DataFrame | None = None,
                 keys: tuple[str, ...] = ("article", "phase")) -> DataFrame:
    """Forecast OEE per (article, phase) in %, risk class (≥85 / ≥65) and component means.

    ``predictions``: (keys..., ``oee_pred``) from a model over :func:`oee_forecast_features`;
    the score is clipped to [0, 1]. Groups without a score fall back to their mean OEE.
    """
    keys = list(keys)
    d = o.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("oee").alias("_mean"),
                             *[F.avg(c).alias(f"_{c}") for c in ["availability", "performance", "quality"]])
    if predictions is not None:
        p = predictions.select(*keys, F.least(F.greatest(F.col("oee_pred"), F.lit(0.0)), F.lit(1.0)).alias("_pred"))
        g = _join_on(g, p, keys, "left")
        use = F.col("_pred").isNotNull()
        pred = F.coalesce(F.col("_pred"), F.col("_mean"))
    else:
        use = F.lit(False)
        pred = F.col("_mean")
    pct = F.round(pred * 100, 1)
    return g.select(
        *keys, pct.alias("oee_pct"), "n",
        F.when(pct >= 85, "fc-green").when(pct >= 65, "fc-warn").otherwise("fc-danger").alias("risk_class"),
        use.alias("use_model"),
        *[F.round(F.coalesce(F.col(f"_{c}"), F.lit(0.0)) * 100, 1).alias(f"{c}_pct")
          for c in ["availability", "performance", "quality"]])
