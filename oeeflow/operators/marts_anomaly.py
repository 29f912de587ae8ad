"""Anomaly report marts (D17-D27, F3) over the prepared, scored order table
(:func:`prepare_anomaly` + a score: model output or :func:`lag_score`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.functions.scalars import month_label, month_label_short
from oeeflow.operators.clean import fill_article
from oeeflow.operators.encode import filter_known_articles, group_rare_articles
from oeeflow.operators.features import features_classification
from oeeflow.operators.interact import PERIOD_MONTHS
from oeeflow.operators.labels import label_for_report
from oeeflow.operators.oee import lost_hours_expr
from oeeflow.operators.windows import DEFAULT_ROWS_PER_CHUNK, _join_on
from oeeflow.schema import DEFAULT_ANOMALY_CUT, DEFAULT_ATTENTION_CUT, ORDER_COLS, OTHER_ARTICLE, STATE_LABELS
from oeeflow.session import materialize

#: The columns of the features that the marts, metrics and folds over scored rows read.
MART_COLS = [*ORDER_COLS, "article", "article_group", "machine", "work_center_planned", "work_hours", "cycle_hours", "inefficiency",
             "lag_1", "lag_2"]


def prepare_anomaly(df: DataFrame, top: DataFrame | list[str] | None, attention_cut: float | None = None,
                    anomaly_cut: float | None = None, rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK,
                    keep: list[str] | None = None) -> DataFrame:
    """Article fill and grouping → classification features → report labels. ``keep``: only these columns of the
    features go on. Where the cuts come from the data, the features are written once, as both the cuts and the
    labels read them."""
    d = group_rare_articles(fill_article(df), top if top is not None else [])
    d = features_classification(d, rows_per_chunk=rows_per_chunk)
    if keep is not None:
        d = d.select(*[c for c in keep if c in d.columns])
    if attention_cut is None or anomaly_cut is None:
        d = materialize(d, "anomaly-features")
    return label_for_report(d, attention_cut=attention_cut, anomaly_cut=anomaly_cut)


def lag_score(df: DataFrame) -> DataFrame:
    """A deterministic stand-in score: previous index / 4 in [0, 1], 2 decimals
    (``prob_anomaly``), and the report cuts applied to the previous index (``pred3``, ``pred``)."""
    p = F.round(F.least(F.greatest(F.col("lag_1") / 4, F.lit(0.0)), F.lit(1.0)), 2)
    out = df.withColumn("prob_anomaly", p)
    if "anomaly_cut" in df.columns:
        ano, att = F.col("anomaly_cut"), F.col("attention_cut")
    else:
        ano, att = F.lit(DEFAULT_ANOMALY_CUT), F.lit(DEFAULT_ATTENTION_CUT)
    pred3 = F.when(F.col("lag_1") >= ano, 2).when(F.col("lag_1") >= att, 1).otherwise(0)
    return out.withColumns({"pred3": pred3, "pred": (pred3 == 2).cast("int")})


def _rate(anom, total) -> F.Column:
    return F.round(anom / total * 100, 1)


def anomaly_kpis(s: DataFrame, theoretical: str = "cycle_hours") -> DataFrame:
    """Period label, totals, anomaly rate (%), lost hours."""
    return s.agg(
        F.concat(F.date_format(F.min("end_ts"), "MMM yyyy"), F.lit(" – "),
                 F.date_format(F.max("end_ts"), "MMM yyyy")).alias("period"),
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("is_anomaly") == 1).alias("n_anomalies"),
        F.count_if(F.col("is_anomaly") == 0).alias("n_normal"),
        F.round(F.count_if(F.col("is_anomaly") == 1) / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100, 1).alias("rate_pct"),
        F.round(F.coalesce(F.sum(lost_hours_expr("work_hours", theoretical)), F.lit(0.0)), 1).alias("lost_hours"))


def _monthly(s: DataFrame) -> DataFrame:
    return s.filter(F.col("end_ts").isNotNull()).withColumn("month", month_label("end_ts"))


def anomaly_month_delta(s: DataFrame) -> DataFrame:
    """Anomalies of the last month present minus those of the month before it."""
    m = _monthly(s).groupBy("month").agg(F.count_if(F.col("is_anomaly") == 1).alias("n"))
    w = Window.orderBy(F.desc("month"))  # one row per month
    r = m.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
    last = r.filter(F.col("_r") == 1).select(F.col("month").alias("last_month"), F.col("n").alias("_nu"))
    prev = r.filter(F.col("_r") == 2).select(F.col("month").alias("prev_month"), F.col("n").alias("_np"))
    j = last.crossJoin(prev)
    d = F.col("_nu") - F.col("_np")
    return j.select("last_month", "prev_month", d.alias("delta"),
                    F.concat(F.when(d >= 0, "+").otherwise(""), d.cast("string"), F.lit(" vs "),
                             F.col("prev_month")).alias("label"))


def anomaly_kpis_by_period(s: DataFrame, period: str, theoretical: str = "cycle_hours") -> DataFrame:
    """KPIs of the period and of the equally long period before it, in one pass. Over the
    whole period (``all``) there is nothing before: those columns are NULL."""
    if period == "all":
        r, t = F.round(F.col("work_hours"), 3), F.round(F.col(theoretical), 3)
        lost = F.when(r.isNotNull() & t.isNotNull(), F.greatest(r - t, F.lit(0.0)))
        agg = s.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("is_anomaly") == 1).alias("n_anomalies"),
                    F.round(F.coalesce(F.sum(lost), F.lit(0.0)), 1).alias("lost_hours"))
        rate = F.when(F.col("n_total") > 0, F.round(F.col("n_anomalies") / F.col("n_total") * 100, 1)).otherwise(0.0)
        none = {"prev_total": "bigint", "prev_anomalies": "bigint", "prev_rate_pct": "double", "prev_lost_hours": "double",
                "delta_anomalies": "bigint", "delta_rate_pct": "double", "delta_lost_hours": "double"}
        return agg.select("n_total", "n_anomalies", (F.col("n_total") - F.col("n_anomalies")).alias("n_normal"),
                          rate.alias("rate_pct"), "lost_hours", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    k = PERIOD_MONTHS[period]
    mx = s.agg(F.max(F.to_date("end_ts")).alias("_maxd"))
    d = F.to_date("end_ts")
    j = s.crossJoin(F.broadcast(mx))  # one row
    cur = d >= F.add_months(F.col("_maxd"), -k)
    prev = (d >= F.add_months(F.col("_maxd"), -2 * k)) & (d < F.add_months(F.col("_maxd"), -k))
    r, t = F.round(F.col("work_hours"), 3), F.round(F.col(theoretical), 3)
    lost = F.when(r.isNotNull() & t.isNotNull(), F.greatest(r - t, F.lit(0.0)))
    agg = j.agg(
        F.count_if(cur).alias("n_total"), F.count_if(cur & (F.col("is_anomaly") == 1)).alias("n_anomalies"),
        F.coalesce(F.sum(F.when(cur, lost)), F.lit(0.0)).alias("_lost"),
        F.count_if(prev).alias("prev_total"), F.count_if(prev & (F.col("is_anomaly") == 1)).alias("prev_anomalies"),
        F.coalesce(F.sum(F.when(prev, lost)), F.lit(0.0)).alias("_plost"))
    rate = F.when(F.col("n_total") > 0, F.round(F.col("n_anomalies") / F.col("n_total") * 100, 1)).otherwise(0.0)
    prate = F.when(F.col("prev_total") > 0, F.round(F.col("prev_anomalies") / F.col("prev_total") * 100, 1)).otherwise(0.0)
    return agg.select(
        "n_total", "n_anomalies", (F.col("n_total") - F.col("n_anomalies")).alias("n_normal"),
        rate.alias("rate_pct"), F.round("_lost", 1).alias("lost_hours"),
        "prev_total", "prev_anomalies", prate.alias("prev_rate_pct"), F.round("_plost", 1).alias("prev_lost_hours"),
        (F.col("n_anomalies") - F.col("prev_anomalies")).alias("delta_anomalies"),
        F.round(rate - prate, 1).alias("delta_rate_pct"),
        F.round(F.round("_lost", 1) - F.round("_plost", 1), 1).alias("delta_lost_hours"))


def mean_inefficiency_gauge(s: DataFrame, theoretical: str = "cycle_hours", vmin: float = 1.0,
                            vmax: float = 2.0) -> DataFrame:
    """Mean actual/theoretical over rows with theoretical > 0 (1.0 when none) and the
    needle angle in [-90, 90]."""
    r, t = F.round(F.col("work_hours"), 3), F.round(F.col(theoretical), 3)
    ok = r.isNotNull() & t.isNotNull() & (t > 0)
    g = s.agg(F.avg(F.when(ok, r / t)).alias("_m"))
    v = F.coalesce(F.col("_m"), F.lit(1.0))
    frac = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - vmin) / max(vmax - vmin, 0.001)))
    return g.select(F.round(v, 6).alias("mean_index"), (F.lit(-90.0) + frac * 180).cast("int").alias("needle_deg"))


def _rate_table(s: DataFrame, by: str, min_total: int) -> DataFrame:
    g = s.groupBy(by).agg(F.count("is_anomaly").alias("total"), F.sum("is_anomaly").alias("anomalies"))
    return g.filter(F.col("total") >= min_total).withColumn("rate_pct", _rate(F.col("anomalies"), F.col("total")))


def anomaly_by_article(s: DataFrame, n: int = 20, min_total: int = 3) -> DataFrame:
    """Anomaly rate per grouped article (without ``ALTRO``), n ≥ 3, top ``n`` (top-k report)."""
    g = _rate_table(s.filter(F.col("article_group") != OTHER_ARTICLE), "article_group", min_total)
    return g.orderBy(F.desc("rate_pct"), F.asc("article_group")).limit(n)


def anomaly_by_phase(s: DataFrame, n: int = 6, min_total: int = 3) -> DataFrame:
    """Anomaly rate per phase, n ≥ 3, top ``n`` (top-k report)."""
    return _rate_table(s, "phase", min_total).orderBy(F.desc("rate_pct"), F.asc("phase")).limit(n)


def latest_months(s: DataFrame, k: int = 6) -> DataFrame:
    """The last ``k`` distinct months present (one row per month, then a tiny window)."""
    m = _monthly(s).select("month").distinct()
    return m.withColumn("_r", F.row_number().over(Window.orderBy(F.desc("month")))).filter(F.col("_r") <= k).drop("_r")


def anomaly_by_phase_month(s: DataFrame, months: int = 6, n: int = 6) -> DataFrame:
    """For each of the last ``months`` months, the ``n`` phases with the highest rate."""
    m = _monthly(s)
    keep = latest_months(s, months)
    g = (m.join(F.broadcast(keep), "month", "left_semi")  # at most `months` rows
         .groupBy("month", "phase").agg(F.count("is_anomaly").alias("total"), F.sum("is_anomaly").alias("anomalies"))
         .filter(F.col("total") >= 1).withColumn("rate_pct", _rate(F.col("anomalies"), F.col("total"))))
    w = Window.partitionBy("month").orderBy(F.desc("rate_pct"), F.asc("phase"))  # (month, phase) rows only
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def lost_hours_by_month(s: DataFrame, months: int = 6, theoretical: str = "cycle_hours") -> DataFrame:
    """Σ max(actual − theoretical, 0) per month for the last ``months`` months, label ``MM-yy``."""
    m = _monthly(s).withColumn("_op", F.coalesce(lost_hours_expr("work_hours", theoretical), F.lit(0.0)))
    g = m.groupBy("month").agg(F.sum("_op").alias("_sum"))
    g = g.join(F.broadcast(latest_months(s, months)), "month", "left_semi")
    return g.select("month", month_label_short("month").alias("label"), F.round("_sum", 1).alias("lost_hours"))


def day_calendar(s: DataFrame) -> DataFrame:
    """D25 + C6: every day of every month present, state anomaly > attention > normal > empty."""
    m = _monthly(s).withColumn("day", F.dayofmonth("end_ts"))
    worst = m.groupBy("month", "day").agg(F.max("label3").alias("_w"))
    months = m.select("month").distinct()
    first = F.to_date(F.concat(F.col("month"), F.lit("-01")))
    spine = months.select("month", F.explode(F.sequence(F.lit(1), F.dayofmonth(F.last_day(first)))).alias("day"))
    j = spine.join(worst, ["month", "day"], "left")
    state = (F.when(F.col("_w") == 2, "anomaly").when(F.col("_w") == 1, "attention")
             .when(F.col("_w") == 0, "normal").otherwise("empty"))
    return j.select("month", "day", state.alias("state"))


def _state(c: str) -> F.Column:
    return (F.when(F.col(c) == 2, STATE_LABELS[2]).when(F.col(c) == 1, STATE_LABELS[1])
            .otherwise(STATE_LABELS[0]))


def orders_by_day_flat(s: DataFrame, theoretical: str = "cycle_hours") -> DataFrame:
    """D26 (flat): one row per order with its day, state and hours (2 decimals)."""
    return s.filter(F.col("end_ts").isNotNull()).select(
        F.date_format("end_ts", "yyyy-MM-dd").alias("day"), F.col("wo").cast("string").alias("wo"),
        F.coalesce(F.col("article"), F.col("article_group")).alias("article"), "phase",
        _state("label3").alias("state"), F.round("work_hours", 2).alias("real_hours"),
        F.round(theoretical, 2).alias("theoretical_hours"))


def anomaly_risk_forecast(s: DataFrame, known: DataFrame | list[str] | None = None,
                          min_pct: int = 14) -> DataFrame:
    """Mean anomaly probability per (article group, phase) in whole percent (half to even),
    kept above ``min_pct``; risk high ≥ 60, medium ≥ 35, else low."""
    sub = filter_known_articles(s, known) if known else s.filter(F.col("article_group") != OTHER_ARTICLE)
    g = sub.groupBy("article_group", "phase").agg(F.avg("prob_anomaly").alias("_m"),
                                                  F.count("prob_anomaly").alias("n"))
    pct = F.bround(F.col("_m") * 100, 0).cast("bigint")
    g = g.withColumn("prob_pct", pct).filter(F.col("prob_pct") > min_pct)
    return g.select("article_group", "phase", "prob_pct", "n",
                    F.when(F.col("prob_pct") >= 60, "risk-high").when(F.col("prob_pct") >= 35, "risk-medium")
                    .otherwise("risk-low").alias("risk_class"))


def anomaly_order_table(s: DataFrame, n: int | None = None, attention_cut: float = DEFAULT_ATTENTION_CUT,
                        anomaly_cut: float = DEFAULT_ANOMALY_CUT, theoretical: str = "cycle_hours") -> DataFrame:
    """orders newest first (the first ``n`` when given), state from the index, probability in %."""
    x = F.col("inefficiency")
    state = F.when(x.isNotNull() & (x >= anomaly_cut), STATE_LABELS[2]).when(
        x.isNotNull() & (x >= attention_cut), STATE_LABELS[1]).otherwise(STATE_LABELS[0])
    cols = [F.col("wo"), "article", "article_group", "phase", "work_center_planned",
            F.date_format("end_ts", "dd/MM/yyyy").alias("end_date"), F.date_format("end_ts", "yyyy-MM-dd").alias("day"),
            F.round("work_hours", 2).alias("work_hours"), F.round(theoretical, 2).alias("theoretical_hours"),
            F.round("inefficiency", 3).alias("inefficiency"), state.alias("state"), "is_anomaly"]
    if "prob_anomaly" in s.columns:
        cols.append(F.round(F.col("prob_anomaly") * 100, 2).alias("prob_pct"))
    out = s.select(*cols, "end_ts", "l_partkey", "l_suppkey")
    if n is not None:
        out = out.orderBy(F.desc("end_ts"), F.desc("wo"), F.desc("phase"), F.desc("l_partkey"), F.desc("l_suppkey")).limit(n)
    return out.drop("end_ts") if n is not None else out.drop("end_ts")
