"""Registered queries: one Spark plan per operator of the inventory, each reading the test
tables (work orders derived from ``lineitem ⋈ part``), plus the DuckDB SQL that must give
the same rows. ``__spark_entry__`` exposes both dictionaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oeeflow.operators import clean, features, oee
from oeeflow.operators.quantiles import quantiles
from oeeflow.plans.oracle_sql import with_raw, with_wo
from oeeflow.schema import ORDER_COLS
from oeeflow.session import materialize, shared_dir
from oeeflow.sources.fixture import raw_export_view, work_orders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def ts_text(c: str = "end_ts") -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


KEY = ["wo", "phase", "l_partkey", "l_suppkey"]
KEY_SQL = "wo, phase, l_partkey, l_suppkey, strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_ts"


def _key_cols():
    return [*KEY, ts_text()]


def r6(c: str, name: str | None = None) -> F.Column:
    return F.round(F.col(c), 6).alias(name or c)


# ---------------------------------------------------------------- sources / cleaning

@register("read_work_orders", with_wo(f"""
SELECT {KEY_SQL}, article, machine, pieces_counted, work_hours, stop_hours, scrap_material, inefficiency
FROM work_orders"""))
def q_read_work_orders(spark, sf):
    wo = work_orders(spark, sf)
    return wo.select(*_key_cols(), "article", "machine", "pieces_counted", "work_hours", "stop_hours",
                     "scrap_material", "inefficiency")


@register("parse_raw_export", with_raw("""
SELECT wo, phase, l_partkey, l_suppkey,
       strftime(strptime(end_date_raw || ' ' || end_time_raw, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS end_ts,
       TRY_CAST(replace(setup_hours, ',', '.') AS DOUBLE) AS setup_hours,
       TRY_CAST(replace(work_hours, ',', '.') AS DOUBLE) AS work_hours,
       TRY_CAST(replace(stop_hours, ',', '.') AS DOUBLE) AS stop_hours,
       TRY_CAST(replace(cycle_minutes, ',', '.') AS DOUBLE) / 60 AS cycle_hours,
       TRY_CAST(replace(erp_machine_hours, ',', '.') AS DOUBLE) AS erp_machine_hours,
       TRY_CAST(replace(erp_setup_hours, ',', '.') AS DOUBLE) AS erp_setup_hours,
       TRY_CAST(pieces_counted AS BIGINT) AS pieces_counted,
       TRY_CAST(scrap_material AS BIGINT) AS scrap_material
FROM raw_export"""))
def q_parse_raw_export(spark, sf):
    raw = raw_export_view(spark, sf)
    df = clean.parse_end_ts(raw)
    df = clean.parse_decimal_comma(df)
    df = clean.parse_integers(df)
    df = clean.minutes_to_hours(df)
    return df.select(F.col("wo").cast("string").alias("wo"), "phase", F.col("l_partkey").cast("string").alias("l_partkey"),
                     F.col("l_suppkey").cast("string").alias("l_suppkey"), ts_text(),
                     "setup_hours", "work_hours", "stop_hours", "cycle_hours", "erp_machine_hours",
                     "erp_setup_hours", "pieces_counted", "scrap_material")


_CLEAN_CTE = """
_p AS (
  SELECT CAST(wo AS BIGINT) AS wo, phase, article, machine, work_center_planned, cic_code,
         strptime(end_date_raw || ' ' || end_time_raw, '%d/%m/%Y %H:%M:%S') AS end_ts,
         TRY_CAST(replace(setup_hours, ',', '.') AS DOUBLE) AS setup_hours,
         TRY_CAST(replace(work_hours, ',', '.') AS DOUBLE) AS work_hours,
         TRY_CAST(replace(stop_hours, ',', '.') AS DOUBLE) AS stop_hours,
         TRY_CAST(replace(cycle_minutes, ',', '.') AS DOUBLE) / 60 AS cycle_hours,
         TRY_CAST(replace(erp_machine_hours, ',', '.') AS DOUBLE) AS erp_machine_hours,
         TRY_CAST(replace(erp_setup_hours, ',', '.') AS DOUBLE) AS erp_setup_hours,
         TRY_CAST(pieces_counted AS BIGINT) AS pieces_counted, TRY_CAST(qty_erp AS BIGINT) AS qty_erp,
         TRY_CAST(pieces_to_advance AS BIGINT) AS pieces_to_advance,
         TRY_CAST(scrap_material AS BIGINT) AS scrap_material,
         TRY_CAST(scrap_machining AS BIGINT) AS scrap_machining,
         TRY_CAST(pieces_reworked AS BIGINT) AS pieces_reworked,
         TRY_CAST(l_partkey AS BIGINT) AS l_partkey, TRY_CAST(l_suppkey AS BIGINT) AS l_suppkey
  FROM raw_export
),
_f AS (
  SELECT *, cycle_hours * pieces_counted AS theoretical_hours,
         work_hours / nullif(cycle_hours * pieces_counted, 0) AS inefficiency
  FROM _p
  WHERE pieces_counted > 0 AND work_hours > 0
    AND COLUMNS(*) IS NOT NULL
),
_f2 AS (SELECT * FROM _f WHERE theoretical_hours > 0),
_q AS (SELECT quantile_cont(inefficiency, 0.25) AS q1, quantile_cont(inefficiency, 0.75) AS q3 FROM _f2),
clean AS (
  SELECT _f2.* FROM _f2, _q
  WHERE inefficiency < q3 + 1.5 * (q3 - q1) AND inefficiency > q1 - 1.5 * (q3 - q1)
)"""


@register("clean_raw_export", with_raw(f"""
SELECT {KEY_SQL}, machine, pieces_counted, work_hours, cycle_hours, theoretical_hours, inefficiency
FROM clean""", _CLEAN_CTE))
def q_clean_raw_export(spark, sf):
    # the IQR bounds read the parsed table twice more: it is written once, as a cleaning
    # job would land it, instead of parsing the text three times
    parsed = materialize(clean.clean_raw_export(raw_export_view(spark, sf), iqr=False))
    c = clean.iqr_filter(parsed)
    return c.select(*_key_cols(), "machine", "pieces_counted", "work_hours", "cycle_hours",
                    "theoretical_hours", "inefficiency")


@register("iqr_filter", with_wo("""
SELECT count(*) AS n, round(avg(inefficiency), 6) AS mean_index, round(stddev_samp(inefficiency), 6) AS std_index,
       round(max(inefficiency), 6) AS max_index
FROM work_orders, (SELECT quantile_cont(inefficiency, 0.25) AS q1, quantile_cont(inefficiency, 0.75) AS q3
                   FROM work_orders) q
WHERE inefficiency < q3 + 1.5 * (q3 - q1) AND inefficiency > q1 - 1.5 * (q3 - q1)"""))
def q_iqr_filter(spark, sf):
    f = clean.iqr_filter(work_orders(spark, sf))
    return f.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("inefficiency"), 6).alias("mean_index"),
                 F.round(F.stddev_samp("inefficiency"), 6).alias("std_index"),
                 F.round(F.max("inefficiency"), 6).alias("max_index"))


@register("iqr_filter_by_machine", with_wo("""
SELECT w.machine, count(*) AS n, round(avg(inefficiency), 6) AS mean_index
FROM work_orders w JOIN (SELECT machine, quantile_cont(inefficiency, 0.25) AS q1, quantile_cont(inefficiency, 0.75) AS q3
                   FROM work_orders GROUP BY machine) q ON w.machine = q.machine
WHERE inefficiency < q3 + 1.5 * (q3 - q1) AND inefficiency > q1 - 1.5 * (q3 - q1)
GROUP BY w.machine"""))
def q_iqr_filter_by_machine(spark, sf):
    f = clean.iqr_filter(work_orders(spark, sf), by=["machine"])
    return f.groupBy("machine").agg(F.count(F.lit(1)).alias("n"),
                                    F.round(F.avg("inefficiency"), 6).alias("mean_index"))


@register("quantiles", with_wo("""
SELECT round(quantile_cont(inefficiency, 0.25), 9) AS q25, round(quantile_cont(inefficiency, 0.5), 9) AS q50,
       round(quantile_cont(inefficiency, 0.6), 9) AS q60, round(quantile_cont(inefficiency, 0.75), 9) AS q75,
       round(quantile_cont(inefficiency, 0.85), 9) AS q85
FROM work_orders"""))
def q_quantiles(spark, sf):
    q = quantiles(work_orders(spark, sf), "inefficiency", [0.25, 0.5, 0.6, 0.75, 0.85],
                  names=["q25", "q50", "q60", "q75", "q85"])
    return q.select(*[F.round(c, 9).alias(c) for c in q.columns])


@register("filter_positive_drop_nulls", with_wo("""
SELECT machine, count(*) AS n FROM work_orders
WHERE pieces_counted > 0 AND work_hours > 0 AND stop_hours IS NOT NULL AND scrap_material IS NOT NULL
GROUP BY machine"""))
def q_filter_positive_drop_nulls(spark, sf):
    df = clean.drop_nulls(clean.filter_positive(work_orders(spark, sf)))
    return df.groupBy("machine").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- OEE

@register("compute_oee", with_wo(f"""
SELECT {KEY_SQL}, availability, performance, quality,
       availability * performance * quality AS oee,
       CASE WHEN availability * performance * quality IS NULL THEN NULL
            WHEN availability * performance * quality <= 0.65 THEN 'Critico'
            WHEN availability * performance * quality <= 0.85 THEN 'Accettabile' ELSE 'Ottimo' END AS oee_class
FROM (
  SELECT *,
    CASE WHEN setup_hours + work_hours > 0 THEN
      least(greatest(greatest(setup_hours + work_hours - coalesce(stop_hours, 0.0), 0.0) / (setup_hours + work_hours), 0.0), 1.0)
    END AS availability,
    least(greatest(1.0 / nullif(inefficiency, 0.0), 0.0), 1.0) AS performance,
    CASE WHEN pieces_counted > 0 THEN
      least(greatest(greatest(pieces_counted - (coalesce(scrap_material, 0) + coalesce(scrap_machining, 0) + coalesce(pieces_reworked, 0)), 0.0) / pieces_counted, 0.0), 1.0)
    END AS quality
  FROM work_orders) t"""))
def q_compute_oee(spark, sf):
    o = oee.compute_oee(work_orders(spark, sf))
    return o.select(*_key_cols(), "availability", "performance", "quality", "oee", "oee_class")


OEE_CTE = """
oee_rows AS (
  SELECT *, availability * performance * quality AS oee,
         CASE WHEN availability * performance * quality IS NULL THEN NULL
              WHEN availability * performance * quality <= 0.65 THEN 'Critico'
              WHEN availability * performance * quality <= 0.85 THEN 'Accettabile' ELSE 'Ottimo' END AS oee_class
  FROM (
    SELECT *,
      CASE WHEN setup_hours + work_hours > 0 THEN
        least(greatest(greatest(setup_hours + work_hours - coalesce(stop_hours, 0.0), 0.0) / (setup_hours + work_hours), 0.0), 1.0)
      END AS availability,
      least(greatest(1.0 / nullif(inefficiency, 0.0), 0.0), 1.0) AS performance,
      CASE WHEN pieces_counted > 0 THEN
        least(greatest(greatest(pieces_counted - (coalesce(scrap_material, 0) + coalesce(scrap_machining, 0) + coalesce(pieces_reworked, 0)), 0.0) / pieces_counted, 0.0), 1.0)
      END AS quality
    FROM work_orders) t
)"""


def oee_rows(spark, sf) -> DataFrame:
    return oee.compute_oee(work_orders(spark, sf))


@register("oee_alerts", with_wo(f"""
SELECT {KEY_SQL}, array_to_string(list_filter([
         CASE WHEN oee < 0.65 THEN 'oee' END, CASE WHEN availability < 0.65 THEN 'availability' END,
         CASE WHEN performance < 0.65 THEN 'performance' END, CASE WHEN quality < 0.65 THEN 'quality' END],
         lambda x: x IS NOT NULL), ',') AS reasons
FROM oee_rows
WHERE oee < 0.65 OR availability < 0.65 OR performance < 0.65 OR quality < 0.65""", OEE_CTE))
def q_oee_alerts(spark, sf):
    a = oee.oee_alerts(oee_rows(spark, sf))
    return a.select(*_key_cols(), F.array_join("alert_reasons", ",").alias("reasons"))


@register("lost_hours", with_wo(f"""
SELECT {KEY_SQL}, greatest(work_hours - cycle_hours, 0.0) AS lost_hours,
       greatest(work_hours - theoretical_hours, 0.0) AS lost_hours_order
FROM work_orders"""))
def q_lost_hours(spark, sf):
    df = work_orders(spark, sf)
    return df.select(*_key_cols(), oee.lost_hours_expr().alias("lost_hours"),
                     oee.lost_hours_expr(theoretical="theoretical_hours").alias("lost_hours_order"))


# ---------------------------------------------------------------- features

_ORDER_SQL = "ORDER BY end_ts, wo, phase, l_partkey, l_suppkey"


@register("add_time_features", with_wo(f"""
SELECT {KEY_SQL}, CAST(isodow(end_ts) - 1 AS BIGINT) AS weekday, CAST(month(end_ts) AS BIGINT) AS month,
       CAST(weekofyear(end_ts) AS BIGINT) AS iso_week, CAST(year(end_ts) AS BIGINT) AS year
FROM work_orders"""))
def q_add_time_features(spark, sf):
    df = features.add_time_features(work_orders(spark, sf))
    return df.select(*_key_cols(), *[F.col(c).cast("bigint").alias(c) for c in ["weekday", "month", "iso_week", "year"]])


@register("add_ratio_features", with_wo(f"""
SELECT {KEY_SQL}, (scrap_material + scrap_machining) / nullif(pieces_counted, 0) AS scrap_ratio,
       erp_setup_hours / nullif(erp_machine_hours, 0.0) AS erp_setup_machine_ratio
FROM work_orders"""))
def q_add_ratio_features(spark, sf):
    df = features.add_ratio_features(work_orders(spark, sf))
    return df.select(*_key_cols(), "scrap_ratio", "erp_setup_machine_ratio")


def _lag_sql(base: str, drop: bool) -> str:
    w = f"PARTITION BY machine {_ORDER_SQL}"
    where = "WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL" if drop else ""
    return with_wo(f"""
SELECT {KEY_SQL}, machine, round(rolling_mean_10, 9) AS rolling_mean_10, round(rolling_std_10, 6) AS rolling_std_10,
       lag_1, lag_2, lag_3
FROM (
  SELECT *, avg({base}) OVER ({w} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_mean_10,
         stddev_samp({base}) OVER ({w} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_std_10,
         lag({base}, 1) OVER ({w}) AS lag_1, lag({base}, 2) OVER ({w}) AS lag_2, lag({base}, 3) OVER ({w}) AS lag_3
  FROM work_orders) t {where}""")


def _lag_out(df):
    return df.select(*_key_cols(), "machine", F.round("rolling_mean_10", 9).alias("rolling_mean_10"),
                     F.round("rolling_std_10", 6).alias("rolling_std_10"), "lag_1", "lag_2", "lag_3")


@register("add_rolling_and_lags", _lag_sql("inefficiency", False))
def q_add_rolling_and_lags(spark, sf):
    return _lag_out(features.add_rolling_and_lags(work_orders(spark, sf), "inefficiency"))


@register("features_inefficiency", _lag_sql("inefficiency", True))
def q_features_inefficiency(spark, sf):
    return _lag_out(features.features_inefficiency(work_orders(spark, sf)))


@register("features_hours", _lag_sql("work_hours", True))
def q_features_hours(spark, sf):
    return _lag_out(features.features_hours(work_orders(spark, sf)))


@register("smooth_times", with_wo(f"""
SELECT {KEY_SQL}, machine,
  round(CASE WHEN n >= 15 THEN avg(work_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)
        ELSE avg(work_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 9) AS work_hours_smooth,
  round(CASE WHEN n >= 15 THEN avg(theoretical_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)
        ELSE avg(theoretical_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 9) AS theoretical_hours_smooth,
  round(CASE WHEN n >= 15 THEN avg(erp_machine_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)
        ELSE avg(erp_machine_hours) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 9) AS erp_machine_hours_smooth
FROM (SELECT *, count(*) OVER (PARTITION BY machine) AS n FROM work_orders) t"""))
def q_smooth_times(spark, sf):
    s = features.smooth_times(work_orders(spark, sf))
    return s.select(*_key_cols(), "machine", *[F.round(f"{c}_smooth", 9).alias(f"{c}_smooth")
                                                for c in ["work_hours", "theoretical_hours", "erp_machine_hours"]])


@register("add_oee_features", with_wo(f"""
SELECT {KEY_SQL}, pct_setup, pct_stops, erp_setup_machine_ratio, pct_scrap,
       round(cycle_mean_art, 9) AS cycle_mean_art, round(coalesce(cycle_std_art, 0.0), 6) AS cycle_std_art,
       round(avg(oee) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 9) AS rolling_oee_3,
       lag(oee, 1) OVER (PARTITION BY machine {_ORDER_SQL}) AS lag_1_oee,
       lag(oee, 2) OVER (PARTITION BY machine {_ORDER_SQL}) AS lag_2_oee,
       lag(oee, 3) OVER (PARTITION BY machine {_ORDER_SQL}) AS lag_3_oee
FROM (
  SELECT o.*,
    CASE WHEN setup_hours + work_hours > 0 THEN setup_hours / (setup_hours + work_hours) END AS pct_setup,
    CASE WHEN setup_hours + work_hours > 0 THEN coalesce(stop_hours, 0.0) / (setup_hours + work_hours) ELSE 0.0 END AS pct_stops,
    erp_setup_hours / nullif(erp_machine_hours, 0.0) AS erp_setup_machine_ratio,
    CASE WHEN pieces_counted > 0 THEN (coalesce(scrap_material, 0) + coalesce(scrap_machining, 0) + coalesce(pieces_reworked, 0)) / pieces_counted END AS pct_scrap,
    s.cycle_mean_art, s.cycle_std_art
  FROM oee_rows o LEFT JOIN (
    SELECT article, phase, avg(cycle_hours) AS cycle_mean_art, stddev_samp(cycle_hours) AS cycle_std_art
    FROM work_orders WHERE article IS NOT NULL AND phase IS NOT NULL GROUP BY article, phase) s
  ON o.article = s.article AND o.phase = s.phase) t""", OEE_CTE))
def q_add_oee_features(spark, sf):
    f = features.add_oee_features(oee_rows(spark, sf))
    return f.select(*_key_cols(), "pct_setup", "pct_stops", "erp_setup_machine_ratio", "pct_scrap",
                    F.round("cycle_mean_art", 9).alias("cycle_mean_art"),
                    F.round("cycle_std_art", 6).alias("cycle_std_art"),
                    F.round("rolling_oee_3", 9).alias("rolling_oee_3"), "lag_1_oee", "lag_2_oee", "lag_3_oee")


# ---------------------------------------------------------------- labels, splits, folds

from oeeflow.operators import encode, folds, interact, labels, marts_anomaly, marts_oee  # noqa: E402

_W = f"PARTITION BY machine {_ORDER_SQL}"
FEAT_CTE = f"""
feat AS (
  SELECT * FROM (
    SELECT *, lag(inefficiency, 1) OVER ({_W}) AS lag_1, lag(inefficiency, 2) OVER ({_W}) AS lag_2,
           lag(inefficiency, 3) OVER ({_W}) AS lag_3
    FROM work_orders) t
  WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL
)"""


LABEL_COLS = [*ORDER_COLS, "inefficiency"]


def feat_rows(spark, sf):
    return features.features_classification(work_orders(spark, sf))


def label_rows(spark, sf):
    # labels, splits and folds read the feature table several times: what they use of it is written once
    return materialize(feat_rows(spark, sf).select(*LABEL_COLS))


@register("label_mean_std", with_wo("""
SELECT label, count(*) AS n, round(min(m), 9) AS attention_cut, round(min(m + s), 9) AS anomaly_cut FROM (
  SELECT f.*, CASE WHEN inefficiency <= m THEN 0 WHEN inefficiency <= m + s THEN 1 ELSE 2 END AS label, m, s
  FROM feat f, (SELECT avg(inefficiency) AS m, stddev_samp(inefficiency) AS s FROM feat) st) t
GROUP BY label""", FEAT_CTE))
def q_label_mean_std(spark, sf):
    d = labels.label_mean_std(label_rows(spark, sf))
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("attention_cut"), 9).alias("attention_cut"),
                                  F.round(F.min("anomaly_cut"), 9).alias("anomaly_cut"))


_SPLIT_CTE = f"""
pos AS (SELECT *, row_number() OVER (ORDER BY end_ts, wo, phase, l_partkey, l_suppkey) - 1 AS _pos,
               count(*) OVER () AS _n FROM feat),
split AS (SELECT *, _pos < floor(CAST(_n AS DOUBLE) * 0.8) AS is_train FROM pos)"""


@register("label_train_quantiles", with_wo("""
SELECT label, CAST(is_train AS INTEGER) AS is_train, count(*) AS n, round(min(p60), 9) AS attention_cut,
       round(min(p85), 9) AS anomaly_cut
FROM (SELECT s.*, CASE WHEN inefficiency <= p60 THEN 0 WHEN inefficiency <= p85 THEN 1 ELSE 2 END AS label, p60, p85
      FROM split s, (SELECT quantile_cont(inefficiency, 0.6) AS p60, quantile_cont(inefficiency, 0.85) AS p85
                     FROM split WHERE is_train) q) t
GROUP BY label, is_train""", FEAT_CTE, _SPLIT_CTE))
def q_label_train_quantiles(spark, sf):
    d = labels.label_train_quantiles(label_rows(spark, sf))
    return d.groupBy("label", F.col("is_train").cast("int").alias("is_train")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min("attention_cut"), 9).alias("attention_cut"),
        F.round(F.min("anomaly_cut"), 9).alias("anomaly_cut"))


@register("label_p85_binary", with_wo("""
SELECT CASE WHEN inefficiency > p85 THEN 1 ELSE 0 END AS label, count(*) AS n, round(min(p85), 9) AS anomaly_cut
FROM feat, (SELECT quantile_cont(inefficiency, 0.85) AS p85 FROM feat) q GROUP BY 1""", FEAT_CTE))
def q_label_p85_binary(spark, sf):
    d = labels.label_p85_binary(label_rows(spark, sf))
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("anomaly_cut"), 9).alias("anomaly_cut"))


@register("temporal_split", with_wo("""
SELECT CAST(is_train AS INTEGER) AS is_train, count(*) AS n, min(_pos) AS first_pos, max(_pos) AS last_pos,
       strftime(min(end_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(end_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM split GROUP BY is_train""", FEAT_CTE, _SPLIT_CTE))
def q_temporal_split(spark, sf):
    d = folds.temporal_split(label_rows(spark, sf))
    return d.groupBy(F.col("is_train").cast("int").alias("is_train")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"),
        F.date_format(F.min("end_ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max("end_ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


@register("time_series_folds", with_wo("""
SELECT test_fold, train_from_fold, count(*) AS n, min(_pos) AS first_pos, max(_pos) AS last_pos FROM (
  SELECT *, CASE WHEN _pos >= _first AND _k < 5 THEN _k END AS test_fold,
            CASE WHEN _pos < _first THEN 0 WHEN _k + 1 < 5 THEN _k + 1 END AS train_from_fold
  FROM (SELECT *, _n - 5 * _size AS _first, CAST(floor((_pos - (_n - 5 * _size)) / _size) AS BIGINT) AS _k
        FROM (SELECT *, _n // 6 AS _size FROM pos) a) b) c
GROUP BY test_fold, train_from_fold""", FEAT_CTE, _SPLIT_CTE))
def q_time_series_folds(spark, sf):
    d = folds.time_series_folds(label_rows(spark, sf))
    return d.groupBy("test_fold", "train_from_fold").agg(
        F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"))


_LBL_CTE = """
lbl AS (SELECT *, CASE WHEN inefficiency > (SELECT quantile_cont(inefficiency, 0.85) FROM feat) THEN 1 ELSE 0 END AS label
        FROM feat),
lc AS (SELECT label, count(*) AS nl FROM lbl GROUP BY label)"""


@register("make_folds_stratified", with_wo("""
SELECT label, CAST(f AS INTEGER) AS fold, nl // 5 + CASE WHEN f < nl % 5 THEN 1 ELSE 0 END AS n
FROM lc, range(5) r(f)""", FEAT_CTE, _LBL_CTE))
def q_make_folds_stratified(spark, sf):
    d = folds.make_folds(labels.label_p85_binary(label_rows(spark, sf)), "stratified", 5, label="label")
    return d.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_split", with_wo("""
SELECT label, 1 AS is_test, CAST(ceil(nl * 0.2) AS BIGINT) AS n FROM lc
UNION ALL SELECT label, 0, nl - CAST(ceil(nl * 0.2) AS BIGINT) FROM lc""", FEAT_CTE, _LBL_CTE))
def q_stratified_split(spark, sf):
    d = folds.stratified_split(labels.label_p85_binary(label_rows(spark, sf)), "label")
    return d.groupBy("label", F.col("is_test").cast("int").alias("is_test")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- article grouping

TOP_CTE = """
top20 AS (SELECT article, count(*) AS n FROM work_orders WHERE article IS NOT NULL
          GROUP BY article ORDER BY n DESC, article ASC LIMIT 20)"""


@register("top_articles", with_wo("SELECT article, n FROM top20", TOP_CTE))
def q_top_articles(spark, sf):
    return encode.top_articles(work_orders(spark, sf), 20)


@register("group_rare_articles", with_wo("""
SELECT CASE WHEN article IN (SELECT article FROM top20) THEN article ELSE 'ALTRO' END AS article_group, count(*) AS n
FROM work_orders GROUP BY 1""", TOP_CTE))
def q_group_rare_articles(spark, sf):
    wo = work_orders(spark, sf)
    g = encode.group_rare_articles(wo, encode.top_articles(wo, 20))
    return g.groupBy("article_group").agg(F.count(F.lit(1)).alias("n"))


@register("filter_known_articles", with_wo("""
SELECT machine, count(*) AS n FROM work_orders WHERE article IN (SELECT article FROM top20) GROUP BY machine""", TOP_CTE))
def q_filter_known_articles(spark, sf):
    wo = work_orders(spark, sf)
    return (encode.filter_known_articles(wo, encode.top_articles(wo, 20).select("article"), col="article")
            .groupBy("machine").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- table interactions

@register("table_filter", with_wo(f"""
SELECT {KEY_SQL}, oee FROM oee_rows
WHERE oee IS NOT NULL AND oee >= 0.7 AND article IS NOT NULL AND contains(lower(article), 'brand#1')
  AND abs(quality - 1.0) >= 0.001""", OEE_CTE))
def q_table_filter(spark, sf):
    o = oee_rows(spark, sf)
    f = interact.table_filter(o, {"oee": ">=0.7", "article": "Brand#1", "quality": "!=1"},
                              numeric_cols=["oee", "quality"], negate=True)
    return f.select(*_key_cols(), "oee")


@register("filter_period", with_wo(f"""
SELECT {KEY_SQL}, oee FROM oee_rows, (SELECT max(CAST(end_ts AS DATE)) AS mx FROM oee_rows) m
WHERE CAST(end_ts AS DATE) >= mx - INTERVAL 3 MONTH""", OEE_CTE))
def q_filter_period(spark, sf):
    return interact.filter_period(oee_rows(spark, sf), "3m").select(*_key_cols(), "oee")


@register("table_sort", with_wo(f"""
SELECT {KEY_SQL}, oee, row_number() OVER (ORDER BY oee DESC NULLS LAST, end_ts, wo, phase, l_partkey, l_suppkey) AS row_number
FROM oee_rows""", OEE_CTE))
def q_table_sort(spark, sf):
    s = interact.table_sort(oee_rows(spark, sf), "oee", ascending=False, tie_breakers=ORDER_TIES)
    return s.select(*_key_cols(), "oee", "row_number")


ORDER_TIES = ["end_ts", "wo", "phase", "l_partkey", "l_suppkey"]


# ---------------------------------------------------------------- OEE marts

OEE_VALID_CTE = """
ov AS (SELECT *, strftime(end_ts, '%Y-%m') AS month FROM oee_rows WHERE oee IS NOT NULL)"""


def oee_valid(spark, sf):
    return marts_oee.prepare_oee(work_orders(spark, sf))


@register("oee_monthly_trend", with_wo("""
SELECT month, round(avg(oee), 4) AS oee, round(avg(availability), 4) AS availability,
       round(avg(performance), 4) AS performance, round(avg(quality), 4) AS quality
FROM ov WHERE month IS NOT NULL GROUP BY month""", OEE_CTE, OEE_VALID_CTE))
def q_oee_monthly_trend(spark, sf):
    return marts_oee.oee_monthly_trend(oee_valid(spark, sf))


@register("oee_class_distribution", with_wo("""
SELECT oee_class, count(*) AS n,
       CASE oee_class WHEN 'Ottimo' THEN 0 WHEN 'Accettabile' THEN 1 WHEN 'Critico' THEN 2 END AS display_order
FROM ov WHERE oee_class IS NOT NULL GROUP BY oee_class""", OEE_CTE, OEE_VALID_CTE))
def q_oee_class_distribution(spark, sf):
    return marts_oee.oee_class_distribution(oee_valid(spark, sf))


@register("oee_by_article", with_wo("""
SELECT article, round(m, 4) AS oee FROM (
  SELECT article, avg(oee) AS m FROM ov WHERE article IS NOT NULL GROUP BY article) t
WHERE m IS NOT NULL ORDER BY m, article LIMIT 15""", OEE_CTE, OEE_VALID_CTE))
def q_oee_by_article(spark, sf):
    return marts_oee.oee_by_article(oee_valid(spark, sf))


@register("oee_kpis", with_wo("""
SELECT round(avg(oee) * 100, 1) AS oee_pct, round(avg(availability) * 100, 1) AS availability_pct,
       round(avg(performance) * 100, 1) AS performance_pct, round(avg(quality) * 100, 1) AS quality_pct,
       count(*) FILTER (WHERE oee < 0.65) AS n_critical, count(*) FILTER (WHERE oee >= 0.85) AS n_world_class,
       count(*) AS n_total
FROM ov""", OEE_CTE, OEE_VALID_CTE))
def q_oee_kpis(spark, sf):
    return marts_oee.oee_kpis(oee_valid(spark, sf))


@register("oee_kpis_by_period", with_wo("""
SELECT round(avg(round(oee, 4)) * 100, 1) AS oee_pct, round(avg(round(availability, 4)) * 100, 1) AS availability_pct,
       round(avg(round(performance, 4)) * 100, 1) AS performance_pct, round(avg(round(quality, 4)) * 100, 1) AS quality_pct,
       count(*) FILTER (WHERE round(oee, 4) >= 0.85) AS n_optimal,
       count(*) FILTER (WHERE round(oee, 4) >= 0.65 AND round(oee, 4) < 0.85) AS n_acceptable,
       count(*) FILTER (WHERE round(oee, 4) < 0.65) AS n_critical, count(*) AS n_orders
FROM ov, (SELECT max(CAST(end_ts AS DATE)) AS mx FROM ov) m
WHERE CAST(end_ts AS DATE) >= mx - INTERVAL 12 MONTH""", OEE_CTE, OEE_VALID_CTE))
def q_oee_kpis_by_period(spark, sf):
    return marts_oee.oee_kpis_by_period(oee_valid(spark, sf), "1y")


_OEE_TABLE_SQL = """wo, phase, article, {ts} AS end_ts, round(oee, 4) AS oee, oee_class, round(availability, 4) AS availability,
       round(performance, 4) AS performance, round(quality, 4) AS quality"""


@register("worst_orders", with_wo(f"""
SELECT {_OEE_TABLE_SQL.format(ts="end_ts")} FROM (
  SELECT * FROM ov WHERE oee < 0.65 ORDER BY oee, end_ts, wo, phase, l_partkey, l_suppkey LIMIT 10) t""",
                                  OEE_CTE, OEE_VALID_CTE))
def q_worst_orders(spark, sf):
    w = marts_oee.worst_orders(oee_valid(spark, sf))
    return w.withColumn("end_ts", F.col("end_ts"))


@register("oee_order_table", with_wo(f"""
SELECT {_OEE_TABLE_SQL.format(ts="strftime(end_ts, '%Y-%m-%d')")} FROM ov""", OEE_CTE, OEE_VALID_CTE))
def q_oee_order_table(spark, sf):
    return marts_oee.oee_order_table(oee_valid(spark, sf))


@register("last_n_per_group", with_wo("""
SELECT article, phase, max(CASE WHEN r = 1 THEN oee END) AS oee_last1, max(CASE WHEN r = 2 THEN oee END) AS oee_last2,
       max(CASE WHEN r = 3 THEN oee END) AS oee_last3
FROM (SELECT article, phase, oee, row_number() OVER (PARTITION BY article, phase
        ORDER BY end_ts DESC, wo DESC, phase DESC, l_partkey DESC, l_suppkey DESC) AS r
      FROM ov WHERE article IS NOT NULL AND phase IS NOT NULL) t
GROUP BY article, phase""", OEE_CTE, OEE_VALID_CTE))
def q_last_n_per_group(spark, sf):
    return marts_oee.last_n_per_group(oee_valid(spark, sf), ["article", "phase"], "oee", 3)


@register("oee_forecast_fallback", with_wo("""
SELECT article, phase, round(avg(oee) * 100, 1) AS oee_pct, count(*) AS n,
       CASE WHEN round(avg(oee) * 100, 1) >= 85 THEN 'fc-green' WHEN round(avg(oee) * 100, 1) >= 65 THEN 'fc-warn'
            ELSE 'fc-danger' END AS risk_class, false AS use_model,
       round(coalesce(avg(availability), 0.0) * 100, 1) AS availability_pct,
       round(coalesce(avg(performance), 0.0) * 100, 1) AS performance_pct,
       round(coalesce(avg(quality), 0.0) * 100, 1) AS quality_pct
FROM ov WHERE article IS NOT NULL AND phase IS NOT NULL GROUP BY article, phase""", OEE_CTE, OEE_VALID_CTE))
def q_oee_forecast_fallback(spark, sf):
    return marts_oee.oee_forecast(oee_valid(spark, sf))


# ---------------------------------------------------------------- anomaly marts

SCORED_CTE = """
cuts AS (SELECT quantile_cont(inefficiency, 0.6) AS p60, quantile_cont(inefficiency, 0.85) AS p85 FROM feat),
scored AS (
  SELECT f.*, CASE WHEN article IN (SELECT article FROM top20) THEN article ELSE 'ALTRO' END AS article_group,
         CASE WHEN inefficiency > p85 THEN 1 ELSE 0 END AS is_anomaly,
         CASE WHEN inefficiency >= p85 THEN 2 WHEN inefficiency >= p60 THEN 1 ELSE 0 END AS label3,
         round(least(greatest(lag_1 / 4, 0.0), 1.0), 2) AS prob_anomaly,
         CASE WHEN lag_1 >= p85 THEN 2 WHEN lag_1 >= p60 THEN 1 ELSE 0 END AS pred3,
         strftime(end_ts, '%Y-%m') AS month,
         CASE WHEN work_hours IS NULL OR cycle_hours IS NULL THEN NULL ELSE greatest(work_hours - cycle_hours, 0.0) END AS lost
  FROM feat f, cuts
)"""


def _a_sql(body: str) -> str:
    return with_wo(body, FEAT_CTE, TOP_CTE, SCORED_CTE)


def scored_rows(spark, sf):
    # the scored table feeds every anomaly mart: the features that they use and the cuts are written once
    wo = work_orders(spark, sf)
    s = marts_anomaly.prepare_anomaly(wo, encode.top_articles(wo, 20), keep=marts_anomaly.MART_COLS)
    return marts_anomaly.lag_score(s)


@register("anomaly_kpis", _a_sql("""
SELECT strftime(min(end_ts), '%b %Y') || ' – ' || strftime(max(end_ts), '%b %Y') AS period, count(*) AS n_total,
       count(*) FILTER (WHERE is_anomaly = 1) AS n_anomalies, count(*) FILTER (WHERE is_anomaly = 0) AS n_normal,
       round(count(*) FILTER (WHERE is_anomaly = 1) / greatest(count(*), 1) * 100, 1) AS rate_pct,
       round(coalesce(sum(lost), 0.0), 1) AS lost_hours
FROM scored"""))
def q_anomaly_kpis(spark, sf):
    return marts_anomaly.anomaly_kpis(scored_rows(spark, sf))


@register("anomaly_month_delta", _a_sql("""
WITH m AS (SELECT month, count(*) FILTER (WHERE is_anomaly = 1) AS n FROM scored WHERE end_ts IS NOT NULL GROUP BY month),
r AS (SELECT *, row_number() OVER (ORDER BY month DESC) AS rk FROM m)
SELECT a.month AS last_month, b.month AS prev_month, a.n - b.n AS delta,
       CASE WHEN a.n - b.n >= 0 THEN '+' ELSE '' END || CAST(a.n - b.n AS VARCHAR) || ' vs ' || b.month AS label
FROM r a, r b WHERE a.rk = 1 AND b.rk = 2"""))
def q_anomaly_month_delta(spark, sf):
    return marts_anomaly.anomaly_month_delta(scored_rows(spark, sf))


@register("anomaly_kpis_by_period", _a_sql("""
WITH j AS (
  SELECT s.*, CAST(end_ts AS DATE) AS d, mx,
         CASE WHEN round(work_hours, 3) IS NULL OR round(cycle_hours, 3) IS NULL THEN NULL
              ELSE greatest(round(work_hours, 3) - round(cycle_hours, 3), 0.0) END AS lost3
  FROM scored s, (SELECT max(CAST(end_ts AS DATE)) AS mx FROM scored) m),
a AS (
  SELECT count(*) FILTER (WHERE d >= mx - INTERVAL 3 MONTH) AS n_total,
         count(*) FILTER (WHERE d >= mx - INTERVAL 3 MONTH AND is_anomaly = 1) AS n_anomalies,
         coalesce(sum(lost3) FILTER (WHERE d >= mx - INTERVAL 3 MONTH), 0.0) AS _lost,
         count(*) FILTER (WHERE d >= mx - INTERVAL 6 MONTH AND d < mx - INTERVAL 3 MONTH) AS prev_total,
         count(*) FILTER (WHERE d >= mx - INTERVAL 6 MONTH AND d < mx - INTERVAL 3 MONTH AND is_anomaly = 1) AS prev_anomalies,
         coalesce(sum(lost3) FILTER (WHERE d >= mx - INTERVAL 6 MONTH AND d < mx - INTERVAL 3 MONTH), 0.0) AS _plost
  FROM j),
b AS (SELECT *, CASE WHEN n_total > 0 THEN round(n_anomalies / n_total * 100, 1) ELSE 0.0 END AS rate_pct,
             CASE WHEN prev_total > 0 THEN round(prev_anomalies / prev_total * 100, 1) ELSE 0.0 END AS prev_rate_pct FROM a)
SELECT n_total, n_anomalies, n_total - n_anomalies AS n_normal, rate_pct, round(_lost, 1) AS lost_hours,
       prev_total, prev_anomalies, prev_rate_pct, round(_plost, 1) AS prev_lost_hours,
       n_anomalies - prev_anomalies AS delta_anomalies, round(rate_pct - prev_rate_pct, 1) AS delta_rate_pct,
       round(round(_lost, 1) - round(_plost, 1), 1) AS delta_lost_hours
FROM b"""))
def q_anomaly_kpis_by_period(spark, sf):
    return marts_anomaly.anomaly_kpis_by_period(scored_rows(spark, sf), "3m")


@register("mean_inefficiency_gauge", _a_sql("""
SELECT round(coalesce(m, 1.0), 6) AS mean_index,
       CAST(trunc(-90.0 + greatest(0.0, least(1.0, (coalesce(m, 1.0) - 1.0) / 1.0)) * 180) AS INTEGER) AS needle_deg
FROM (SELECT avg(CASE WHEN round(cycle_hours, 3) > 0 THEN round(work_hours, 3) / round(cycle_hours, 3) END) AS m
      FROM scored) t"""))
def q_mean_inefficiency_gauge(spark, sf):
    return marts_anomaly.mean_inefficiency_gauge(scored_rows(spark, sf))


@register("anomaly_by_article", _a_sql("""
SELECT article_group, count(is_anomaly) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
       round(sum(is_anomaly) / count(is_anomaly) * 100, 1) AS rate_pct
FROM scored WHERE article_group <> 'ALTRO' GROUP BY article_group HAVING count(is_anomaly) >= 3
ORDER BY rate_pct DESC, article_group LIMIT 20"""))
def q_anomaly_by_article(spark, sf):
    return marts_anomaly.anomaly_by_article(scored_rows(spark, sf))


@register("anomaly_by_phase", _a_sql("""
SELECT phase, count(is_anomaly) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
       round(sum(is_anomaly) / count(is_anomaly) * 100, 1) AS rate_pct
FROM scored GROUP BY phase HAVING count(is_anomaly) >= 3 ORDER BY rate_pct DESC, phase LIMIT 6"""))
def q_anomaly_by_phase(spark, sf):
    return marts_anomaly.anomaly_by_phase(scored_rows(spark, sf))


@register("anomaly_by_phase_month", _a_sql("""
WITH lm AS (SELECT DISTINCT month FROM scored WHERE end_ts IS NOT NULL ORDER BY month DESC LIMIT 6),
g AS (SELECT month, phase, count(is_anomaly) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
             round(sum(is_anomaly) / count(is_anomaly) * 100, 1) AS rate_pct
      FROM scored WHERE month IN (SELECT month FROM lm) GROUP BY month, phase HAVING count(is_anomaly) >= 1)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY rate_pct DESC, phase) AS rank FROM g) t
WHERE rank <= 6"""))
def q_anomaly_by_phase_month(spark, sf):
    return marts_anomaly.anomaly_by_phase_month(scored_rows(spark, sf))


@register("lost_hours_by_month", _a_sql("""
WITH lm AS (SELECT DISTINCT month FROM scored WHERE end_ts IS NOT NULL ORDER BY month DESC LIMIT 6)
SELECT month, substr(month, 6, 2) || '-' || substr(month, 3, 2) AS label, round(sum(coalesce(lost, 0.0)), 1) AS lost_hours
FROM scored WHERE month IN (SELECT month FROM lm) GROUP BY month"""))
def q_lost_hours_by_month(spark, sf):
    return marts_anomaly.lost_hours_by_month(scored_rows(spark, sf))


@register("day_calendar", _a_sql("""
WITH w AS (SELECT month, day(end_ts) AS day, max(label3) AS mw FROM scored WHERE end_ts IS NOT NULL GROUP BY month, day(end_ts)),
sp AS (SELECT month, CAST(d AS INTEGER) AS day FROM (SELECT DISTINCT month FROM scored WHERE end_ts IS NOT NULL) m,
       generate_series(1, day(last_day(CAST(month || '-01' AS DATE)))) g(d))
SELECT sp.month, sp.day, CASE WHEN mw = 2 THEN 'anomaly' WHEN mw = 1 THEN 'attention' WHEN mw = 0 THEN 'normal'
                              ELSE 'empty' END AS state
FROM sp LEFT JOIN w ON sp.month = w.month AND sp.day = w.day"""))
def q_day_calendar(spark, sf):
    return marts_anomaly.day_calendar(scored_rows(spark, sf))


@register("orders_by_day", _a_sql("""
SELECT strftime(end_ts, '%Y-%m-%d') AS day, CAST(wo AS VARCHAR) AS wo, coalesce(article, article_group) AS article, phase,
       CASE WHEN label3 = 2 THEN 'ANOMALIA' WHEN label3 = 1 THEN 'ATTENZIONE' ELSE 'NORMALE' END AS state,
       round(work_hours, 2) AS real_hours, round(cycle_hours, 2) AS theoretical_hours
FROM scored WHERE end_ts IS NOT NULL"""))
def q_orders_by_day(spark, sf):
    return marts_anomaly.orders_by_day_flat(scored_rows(spark, sf))


@register("anomaly_risk_forecast", _a_sql("""
SELECT article_group, phase, prob_pct, n,
       CASE WHEN prob_pct >= 60 THEN 'risk-high' WHEN prob_pct >= 35 THEN 'risk-medium' ELSE 'risk-low' END AS risk_class
FROM (SELECT article_group, phase, CAST(round_even(avg(prob_anomaly) * 100, 0) AS BIGINT) AS prob_pct,
             count(prob_anomaly) AS n
      FROM scored WHERE article_group <> 'ALTRO' GROUP BY article_group, phase) t
WHERE prob_pct > 14"""))
def q_anomaly_risk_forecast(spark, sf):
    return marts_anomaly.anomaly_risk_forecast(scored_rows(spark, sf))


@register("anomaly_order_table", _a_sql("""
SELECT wo, article, article_group, phase, work_center_planned, strftime(end_ts, '%d/%m/%Y') AS end_date,
       strftime(end_ts, '%Y-%m-%d') AS day, round(work_hours, 2) AS work_hours, round(cycle_hours, 2) AS theoretical_hours,
       round(inefficiency, 3) AS inefficiency,
       CASE WHEN inefficiency >= 1.422 THEN 'ANOMALIA' WHEN inefficiency >= 1.1511 THEN 'ATTENZIONE' ELSE 'NORMALE' END AS state,
       is_anomaly, round(prob_anomaly * 100, 2) AS prob_pct, l_partkey, l_suppkey
FROM scored"""))
def q_anomaly_order_table(spark, sf):
    return marts_anomaly.anomaly_order_table(scored_rows(spark, sf))


# ---------------------------------------------------------------- statistics

from oeeflow.operators import metrics, stats  # noqa: E402
from oeeflow.schema import CLEAN_SCHEMA  # noqa: E402

_WO_COLS = [f.name for f in CLEAN_SCHEMA.fields]


@register("profile_table", with_wo(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, count(*) AS n_rows FROM work_orders"
    for c in _WO_COLS)))
def q_profile_table(spark, sf):
    return stats.profile_table(work_orders(spark, sf)).select("column", "n_nulls", "n_rows")


@register("describe_column", with_wo("""
SELECT round(avg(inefficiency), 6) AS mean, round(stddev_samp(inefficiency), 6) AS std, count(inefficiency) AS n,
       round(avg(inefficiency) - stddev_samp(inefficiency), 6) AS mean_minus_std,
       round(avg(inefficiency) + stddev_samp(inefficiency), 6) AS mean_plus_std FROM work_orders"""))
def q_describe_column(spark, sf):
    d = stats.describe_column(work_orders(spark, sf))
    return d.select(*[F.round(c, 6).alias(c) if c != "n" else F.col(c) for c in d.columns])


@register("machine_stats", with_wo("""
SELECT machine, count(inefficiency) AS count, round(avg(inefficiency), 6) AS mean, round(stddev_samp(inefficiency), 6) AS std,
       round(avg(CASE WHEN inefficiency IS NOT NULL THEN CAST(inefficiency > 1.5 AS DOUBLE) END), 6) AS share_over_1_5,
       round(avg(CASE WHEN inefficiency IS NOT NULL THEN CAST(inefficiency > 1.8 AS DOUBLE) END), 6) AS share_over_1_8
FROM work_orders GROUP BY machine"""))
def q_machine_stats(spark, sf):
    d = stats.machine_stats(work_orders(spark, sf))
    return d.select("machine", "count", *[F.round(c, 6).alias(c) for c in d.columns if c not in ("machine", "count")])


@register("machine_median_rank", with_wo("""
SELECT machine, round(m, 9) AS median, row_number() OVER (ORDER BY m DESC, machine) AS rank
FROM (SELECT machine, quantile_cont(inefficiency, 0.5) AS m FROM work_orders GROUP BY machine) t"""))
def q_machine_median_rank(spark, sf):
    d = stats.machine_median_rank(work_orders(spark, sf))
    return d.select("machine", F.round("median", 9).alias("median"), "rank")


@register("observations_per_machine", with_wo("""
SELECT machine, count(*) AS n_obs, CAST(count(*) < 100 AS INTEGER) AS below_min FROM work_orders GROUP BY machine"""))
def q_observations_per_machine(spark, sf):
    return stats.observations_per_machine(work_orders(spark, sf))


@register("histogram", with_wo("""
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 50, 9) AS lower, round(lo + bin * (hi - lo) / 50, 9) AS upper, count(*) AS n
FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((inefficiency - lo) * 50 / (hi - lo)) AS INTEGER) + 1, 50) END AS bin, lo, hi
      FROM work_orders, (SELECT min(inefficiency) AS lo, max(inefficiency) AS hi FROM work_orders) m
      WHERE inefficiency IS NOT NULL) t
GROUP BY bin, lo, hi"""))
def q_histogram(spark, sf):
    h = stats.histogram(work_orders(spark, sf), bins=50)
    return h.select("bin", F.round("lower", 9).alias("lower"), F.round("upper", 9).alias("upper"), "n")


@register("boxplot_stats", with_wo("""
WITH q AS (SELECT machine, quantile_cont(inefficiency, 0.25) AS q1, quantile_cont(inefficiency, 0.5) AS md,
                  quantile_cont(inefficiency, 0.75) AS q3 FROM work_orders GROUP BY machine)
SELECT w.machine, round(q1, 9) AS q1, round(md, 9) AS median, round(q3, 9) AS q3,
       min(CASE WHEN inefficiency >= q1 - 1.5 * (q3 - q1) THEN inefficiency END) AS whisker_low,
       max(CASE WHEN inefficiency <= q3 + 1.5 * (q3 - q1) THEN inefficiency END) AS whisker_high,
       count(*) FILTER (WHERE inefficiency < q1 - 1.5 * (q3 - q1) OR inefficiency > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM work_orders w JOIN q ON w.machine = q.machine GROUP BY w.machine, q1, md, q3"""))
def q_boxplot_stats(spark, sf):
    b = stats.boxplot_stats(work_orders(spark, sf))
    return b.select("machine", *[F.round(c, 9).alias(c) for c in ["q1", "median", "q3"]],
                    "whisker_low", "whisker_high", "n_outliers")


@register("skewness", with_wo("""
SELECT machine, round(skewness(inefficiency), 6) AS skewness, count(inefficiency) AS n FROM work_orders GROUP BY machine"""))
def q_skewness(spark, sf):
    s = stats.skewness(work_orders(spark, sf), by=["machine"])
    return s.select("machine", F.round("skewness", 6).alias("skewness"), "n")


_CORR_COLS = ["pieces_counted", "qty_erp", "pieces_to_advance", "setup_hours", "erp_machine_hours", "erp_setup_hours",
              "cycle_hours", "scrap_machining", "weekday", "month", "iso_week", "rolling_mean_10", "rolling_std_10",
              "lag_1", "scrap_ratio", "erp_setup_machine_ratio"]


def _corr_sql() -> str:
    import itertools
    pairs = list(itertools.combinations(_CORR_COLS, 2))
    sel = ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, c{i} AS corr FROM agg" for i, (a, b) in enumerate(pairs))
    feat = f"""
fx AS (
  SELECT *, isodow(end_ts) - 1 AS weekday, month(end_ts) AS month, weekofyear(end_ts) AS iso_week,
         avg(inefficiency) OVER ({_W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_mean_10,
         stddev_samp(inefficiency) OVER ({_W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_std_10,
         lag(inefficiency, 1) OVER ({_W}) AS lag_1, lag(inefficiency, 2) OVER ({_W}) AS lag_2,
         lag(inefficiency, 3) OVER ({_W}) AS lag_3,
         (scrap_material + scrap_machining) / nullif(pieces_counted, 0) AS scrap_ratio,
         erp_setup_hours / nullif(erp_machine_hours, 0.0) AS erp_setup_machine_ratio
  FROM work_orders),
fxd AS (SELECT * FROM fx WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL),
agg AS (SELECT {sel} FROM fxd)"""
    return with_wo(f"SELECT col_a, col_b, round(corr, 6) AS corr FROM ({rows}) t WHERE abs(corr) > 0.7", feat)


@register("correlated_pairs", _corr_sql())
def q_correlated_pairs(spark, sf):
    c = stats.correlated_pairs(features.features_inefficiency(work_orders(spark, sf)), _CORR_COLS)
    return c.select("col_a", "col_b", F.round("corr", 6).alias("corr"))


@register("class_distribution", _a_sql("""
SELECT label3, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct FROM scored GROUP BY label3"""))
def q_class_distribution(spark, sf):
    d = stats.class_distribution(scored_rows(spark, sf), "label3")
    return d.select("label3", "n", F.round("pct", 6).alias("pct"))


# ---------------------------------------------------------------- metrics

def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("regression_metrics", with_wo("""
SELECT count(*) AS n, round(1 - sum((work_hours - theoretical_hours) ^ 2) / (var_pop(work_hours) * count(*)), 6) AS r2,
       round(avg(abs(work_hours - theoretical_hours)), 6) AS mae, round(avg((work_hours - theoretical_hours) ^ 2), 6) AS mse,
       round(sqrt(avg((work_hours - theoretical_hours) ^ 2)), 6) AS rmse
FROM work_orders WHERE work_hours IS NOT NULL AND theoretical_hours IS NOT NULL"""))
def q_regression_metrics(spark, sf):
    return _r6(metrics.regression_metrics(work_orders(spark, sf), "work_hours", "theoretical_hours"))


@register("mape", with_wo("""
SELECT round(avg(CASE WHEN work_hours <> 0 THEN abs((work_hours - erp_machine_hours) / work_hours) END) * 100, 6) AS mape
FROM work_orders"""))
def q_mape(spark, sf):
    return _r6(metrics.mape(work_orders(spark, sf), "work_hours", "erp_machine_hours"))


@register("within_tolerance", with_wo(f"""
SELECT round(avg(CAST(abs(oee - lag_1_oee) <= 0.05 AS DOUBLE)), 6) AS within_5,
       round(avg(CAST(abs(oee - lag_1_oee) <= 0.1 AS DOUBLE)), 6) AS within_10
FROM (SELECT oee, lag(oee, 1) OVER (PARTITION BY machine {_ORDER_SQL}) AS lag_1_oee FROM oee_rows) t
WHERE oee IS NOT NULL AND lag_1_oee IS NOT NULL""", OEE_CTE))
def q_within_tolerance(spark, sf):
    f = features.add_oee_rolling_and_lags(oee_rows(spark, sf))
    return _r6(metrics.within_tolerance(f, "oee", "lag_1_oee"))


@register("confusion_matrix", _a_sql("""
SELECT t.v AS "true", p.v AS pred, count(s.label3) AS n
FROM (VALUES (0), (1), (2)) t(v) CROSS JOIN (VALUES (0), (1), (2)) p(v)
LEFT JOIN scored s ON s.label3 = t.v AND s.pred3 = p.v GROUP BY t.v, p.v"""))
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored_rows(spark, sf), "label3", "pred3", [0, 1, 2])


@register("classification_report", _a_sql("""
WITH cm AS (SELECT label3 AS t, pred3 AS p, count(*) AS n FROM scored GROUP BY 1, 2),
cls AS (SELECT t AS c FROM cm UNION SELECT p FROM cm),
pc AS (SELECT c, coalesce((SELECT sum(n) FROM cm WHERE t = c AND p = c), 0) AS tp,
              coalesce((SELECT sum(n) FROM cm WHERE t = c), 0) AS support,
              coalesce((SELECT sum(n) FROM cm WHERE p = c), 0) AS predicted FROM cls),
m AS (SELECT c, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""))
def q_classification_report(spark, sf):
    return _r6(metrics.classification_report(scored_rows(spark, sf), "label3", "pred3"))


@register("roc_auc", _a_sql("""
WITH g AS (SELECT prob_anomaly AS s, count(*) FILTER (WHERE is_anomaly = 1) AS pos, count(*) FILTER (WHERE is_anomaly <> 1) AS neg
           FROM scored WHERE prob_anomaly IS NOT NULL GROUP BY prob_anomaly),
c AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g)
SELECT round(sum(pos * ((cum_neg - neg) + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c"""))
def q_roc_auc(spark, sf):
    return _r6(metrics.roc_auc(scored_rows(spark, sf), "is_anomaly", "prob_anomaly"))


@register("recall_of_class", _a_sql("""
SELECT round(coalesce(count(*) FILTER (WHERE label3 = 2 AND pred3 = 2) / nullif(count(*) FILTER (WHERE label3 = 2), 0), 0.0), 6) AS recall
FROM scored"""))
def q_recall_of_class(spark, sf):
    return _r6(metrics.recall_of_class(scored_rows(spark, sf), "label3", "pred3", 2))


_SCORED_SPLIT = """
spos AS (SELECT *, row_number() OVER (ORDER BY end_ts, wo, phase, l_partkey, l_suppkey) - 1 AS _pos, count(*) OVER () AS _n
         FROM scored),
ssplit AS (SELECT *, _pos < floor(CAST(_n AS DOUBLE) * 0.8) AS is_train FROM spos)"""


@register("overfit_check", with_wo("""
SELECT round(tr, 6) AS train_accuracy, round(te, 6) AS test_accuracy, round(tr - te, 6) AS gap,
       CASE WHEN tr - te > 0.05 THEN 'OVERFITTING' ELSE 'OK' END AS verdict
FROM (SELECT avg(CAST(label3 = pred3 AS DOUBLE)) FILTER (WHERE is_train) AS tr,
             avg(CAST(label3 = pred3 AS DOUBLE)) FILTER (WHERE NOT is_train) AS te FROM ssplit) t""",
                                   FEAT_CTE, TOP_CTE, SCORED_CTE, _SCORED_SPLIT))
def q_overfit_check(spark, sf):
    s = folds.temporal_split(scored_rows(spark, sf))
    o = metrics.overfit_check(s.filter("is_train"), s.filter("NOT is_train"), "label3", "pred3")
    return _r6(o)


@register("compare_models", with_wo("""
WITH e AS (
  SELECT 'theoretical' AS model, work_hours - theoretical_hours AS err, work_hours AS y FROM work_orders
  UNION ALL SELECT 'erp_machine', work_hours - erp_machine_hours, work_hours FROM work_orders
  UNION ALL SELECT 'erp_total', work_hours - (erp_machine_hours + erp_setup_hours), work_hours FROM work_orders),
m AS (SELECT model, sqrt(avg(err * err)) AS rmse, 1 - sum(err * err) / (var_pop(y) * count(*)) AS r2 FROM e GROUP BY model)
SELECT model, round(rmse, 6) AS rmse, round(r2, 6) AS r2, row_number() OVER (ORDER BY rmse, r2 DESC) AS rank FROM m"""))
def q_compare_models(spark, sf):
    wo = work_orders(spark, sf)
    parts = []
    for name, est in [("theoretical", F.col("theoretical_hours")), ("erp_machine", F.col("erp_machine_hours")),
                      ("erp_total", F.col("erp_machine_hours") + F.col("erp_setup_hours"))]:
        m = metrics.regression_metrics(wo.withColumn("_yhat", est), "work_hours", "_yhat")
        parts.append(m.select(F.lit(name).alias("model"), "rmse", "r2"))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    r = metrics.compare_models(u, [F.asc("rmse"), F.desc("r2")])
    return r.select("model", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"), "rank")


@register("tune_threshold", _a_sql("""
WITH tcuts AS (SELECT i, 0.05::DOUBLE + CAST(i AS DOUBLE) * 0.010000000000000002::DOUBLE AS cut FROM range(86) r(i)),
t AS (SELECT i, cut, count(*) FILTER (WHERE prob_anomaly >= cut AND is_anomaly = 1) AS tp,
             count(*) FILTER (WHERE prob_anomaly >= cut) AS flagged,
             (SELECT count(*) FILTER (WHERE is_anomaly = 1) FROM scored) AS positives
      FROM tcuts LEFT JOIN scored ON true GROUP BY i, cut),
m AS (SELECT *, CASE WHEN positives > 0 THEN tp / positives ELSE 0.0 END AS recall,
             CASE WHEN flagged > 0 THEN tp / flagged ELSE 0.0 END AS precision,
             CASE WHEN flagged + positives > 0 THEN 2 * tp / (flagged + positives) ELSE 0.0 END AS f1,
             positives - tp AS fn FROM t WHERE flagged > 0),
c AS (SELECT *, 0 AS pri FROM m WHERE precision >= 0.25 UNION ALL SELECT *, 1 FROM m)
SELECT round(cut, 6) AS cut, round(recall, 6) AS recall, round(precision, 6) AS precision, round(f1, 6) AS f1, fn,
       pri = 0 AS precision_floor_met
FROM c ORDER BY pri, recall DESC, f1 DESC, i LIMIT 1"""))
def q_tune_threshold(spark, sf):
    return _r6(metrics.tune_threshold(scored_rows(spark, sf), "is_anomaly", "prob_anomaly"))


@register("tune_two_thresholds", _a_sql("""
WITH r AS (SELECT label3 AS y, prob_anomaly AS p2, round(least(greatest(lag_2 / 4, 0.0), 1.0), 2) AS p1 FROM scored),
pairs AS (SELECT ia, it, 0.15::DOUBLE + CAST(ia AS DOUBLE) * 0.05000000000000002::DOUBLE AS ca, 0.2::DOUBLE + CAST(it AS DOUBLE) * 0.04999999999999999::DOUBLE AS ct
          FROM range(10) a(ia), range(11) b(it)),
pp AS (SELECT * FROM pairs WHERE ct >= ca),
pr AS (SELECT ia, it, ca, ct, y, CASE WHEN p2 >= ca THEN 2 WHEN p1 >= ct THEN 1 ELSE 0 END AS pred FROM pp, r),
s AS (SELECT ia, it, ca, ct,
        count(*) FILTER (WHERE y = 0 AND pred = 0) AS tp0, count(*) FILTER (WHERE y = 0) AS sup0, count(*) FILTER (WHERE pred = 0) AS prd0,
        count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp1, count(*) FILTER (WHERE y = 1) AS sup1, count(*) FILTER (WHERE pred = 1) AS prd1,
        count(*) FILTER (WHERE y = 2 AND pred = 2) AS tp2, count(*) FILTER (WHERE y = 2) AS sup2, count(*) FILTER (WHERE pred = 2) AS prd2,
        count(*) FILTER (WHERE y = 2 AND pred = 1) AS err_2_to_1
      FROM pr GROUP BY ia, it, ca, ct),
pc AS (SELECT *,
        CASE WHEN prd0 > 0 THEN tp0 / prd0 ELSE 0.0 END AS p0, CASE WHEN sup0 > 0 THEN tp0 / sup0 ELSE 0.0 END AS r0,
        CASE WHEN prd1 > 0 THEN tp1 / prd1 ELSE 0.0 END AS p1_, CASE WHEN sup1 > 0 THEN tp1 / sup1 ELSE 0.0 END AS r1,
        CASE WHEN prd2 > 0 THEN tp2 / prd2 ELSE 0.0 END AS p2_, CASE WHEN sup2 > 0 THEN tp2 / sup2 ELSE 0.0 END AS r2 FROM s),
f AS (SELECT *,
        CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
        CASE WHEN p1_ + r1 > 0 THEN 2 * p1_ * r1 / (p1_ + r1) ELSE 0.0 END AS f1,
        CASE WHEN p2_ + r2 > 0 THEN 2 * p2_ * r2 / (p2_ + r2) ELSE 0.0 END AS f2,
        CAST(sup0 + prd0 > 0 AS INTEGER) AS e0, CAST(sup1 + prd1 > 0 AS INTEGER) AS e1, CAST(sup2 + prd2 > 0 AS INTEGER) AS e2 FROM pc),
g AS (SELECT *, r2 AS recall_anomaly, (f0 * e0 + f1 * e1 + f2 * e2) / (e0 + e1 + e2) AS f1_macro FROM f)
SELECT round(ca, 6) AS cut_anomaly, round(ct, 6) AS cut_attention, round(recall_anomaly, 6) AS recall_anomaly,
       round(f1_macro, 6) AS f1_macro, err_2_to_1
FROM g ORDER BY recall_anomaly DESC, err_2_to_1, f1_macro DESC, ia, it LIMIT 1"""))
def q_tune_two_thresholds(spark, sf):
    s = scored_rows(spark, sf).withColumn("p1", F.round(F.least(F.greatest(F.col("lag_2") / 4, F.lit(0.0)), F.lit(1.0)), 2))
    return _r6(metrics.tune_two_thresholds(s, "label3", "prob_anomaly", "p1"))


_HOURS_CTE = f"""
hf AS (SELECT * FROM (
  SELECT *, avg(work_hours) OVER ({_W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_mean_10,
         lag(work_hours, 1) OVER ({_W}) AS lag_1, lag(work_hours, 2) OVER ({_W}) AS lag_2, lag(work_hours, 3) OVER ({_W}) AS lag_3
  FROM work_orders) t WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL)"""


def hours_rows(spark, sf):
    return features.features_hours(work_orders(spark, sf))


@register("compare_times", with_wo(f"""
SELECT {KEY_SQL}, round(abs(work_hours - erp_machine_hours), 9) AS err_erp, round(abs(work_hours - rolling_mean_10), 9) AS err_model,
       round(abs(work_hours - theoretical_hours), 9) AS err_theoretical,
       coalesce(abs(work_hours - rolling_mean_10) < abs(work_hours - erp_machine_hours), false) AS model_better_than_erp,
       abs(work_hours - theoretical_hours) IS NOT NULL
         AND coalesce(abs(work_hours - rolling_mean_10) < abs(work_hours - theoretical_hours), false) AS model_better_than_theoretical
FROM hf""", _HOURS_CTE))
def q_compare_times(spark, sf):
    c = metrics.compare_times(hours_rows(spark, sf), "work_hours", "erp_machine_hours", "rolling_mean_10", "theoretical_hours")
    return c.select(*_key_cols(), *[F.round(x, 9).alias(x) for x in ["err_erp", "err_model", "err_theoretical"]],
                    "model_better_than_erp", "model_better_than_theoretical")


@register("compare_times_summary", with_wo("""
WITH c AS (SELECT *, abs(work_hours - erp_machine_hours) AS e_erp, abs(work_hours - rolling_mean_10) AS e_ml,
                  abs(work_hours - theoretical_hours) AS e_th FROM hf)
SELECT count(*) AS n, count(*) FILTER (WHERE e_ml < e_erp) AS n_better_erp,
       round(count(*) FILTER (WHERE e_ml < e_erp) / count(*) * 100, 6) AS pct_better_erp,
       count(*) FILTER (WHERE e_th IS NOT NULL AND e_ml < e_th) AS n_better_theoretical,
       count(*) FILTER (WHERE e_th IS NOT NULL) AS n_theoretical_valid,
       round(count(*) FILTER (WHERE e_th IS NOT NULL AND e_ml < e_th) / nullif(count(*) FILTER (WHERE e_th IS NOT NULL), 0) * 100, 6) AS pct_better_theoretical,
       round(sqrt(avg(e_erp ^ 2)), 6) AS rmse_erp, round(sqrt(avg(e_ml ^ 2)), 6) AS rmse_model, round(sqrt(avg(e_th ^ 2)), 6) AS rmse_theoretical,
       round(avg(CASE WHEN work_hours <> 0 THEN abs((work_hours - erp_machine_hours) / work_hours) END) * 100, 6) AS mape_erp,
       round(avg(CASE WHEN work_hours <> 0 THEN abs((work_hours - rolling_mean_10) / work_hours) END) * 100, 6) AS mape_model,
       round(avg(CASE WHEN e_th IS NOT NULL AND work_hours <> 0 THEN abs((work_hours - theoretical_hours) / work_hours) END) * 100, 6) AS mape_theoretical
FROM c""", _HOURS_CTE))
def q_compare_times_summary(spark, sf):
    c = metrics.compare_times(hours_rows(spark, sf), "work_hours", "erp_machine_hours", "rolling_mean_10", "theoretical_hours")
    return _r6(metrics.compare_times_summary(c, "work_hours", "erp_machine_hours", "rolling_mean_10", "theoretical_hours"))


@register("prediction_summary", with_wo("""
SELECT round(avg(rolling_mean_10), 6) AS pred_mean, round(min(rolling_mean_10), 6) AS pred_min, round(max(rolling_mean_10), 6) AS pred_max,
       round(avg(inefficiency), 6) AS real_mean, round(min(inefficiency), 6) AS real_min, round(max(inefficiency), 6) AS real_max
FROM (SELECT *, avg(inefficiency) OVER ({w} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_mean_10,
             lag(inefficiency, 3) OVER ({w}) AS lag_3 FROM work_orders) t
WHERE rolling_mean_10 IS NOT NULL AND lag_3 IS NOT NULL""".replace("{w}", _W)))
def q_prediction_summary(spark, sf):
    return _r6(metrics.prediction_summary(feat_rows(spark, sf), "rolling_mean_10", "inefficiency"))


_STATE_SQL = """CASE WHEN {x} <= p60 THEN 'NORMALE' WHEN {x} <= p85 THEN 'ATTENZIONE' ELSE 'ANOMALIA' END"""


def _states(spark, sf):
    s = scored_rows(spark, sf)
    real = (F.when(F.col("inefficiency") <= F.col("attention_cut"), "NORMALE")
            .when(F.col("inefficiency") <= F.col("anomaly_cut"), "ATTENZIONE").otherwise("ANOMALIA"))
    pred = F.when(F.col("pred3") == 2, "ANOMALIA").when(F.col("pred3") == 1, "ATTENZIONE").otherwise("NORMALE")
    return s.withColumns({"real_class": real, "pred_class": pred})


_STATES_CTE = f"""
st AS (SELECT *, {_STATE_SQL.format(x='inefficiency')} AS real_class,
              CASE WHEN pred3 = 2 THEN 'ANOMALIA' WHEN pred3 = 1 THEN 'ATTENZIONE' ELSE 'NORMALE' END AS pred_class
       FROM scored, cuts)"""


@register("per_class_accuracy", with_wo("""
WITH l AS (SELECT * FROM (VALUES ('NORMALE'), ('ATTENZIONE'), ('ANOMALIA')) v(c)),
p AS (SELECT c AS class, count(*) FILTER (WHERE real_class = c) AS n_real, count(*) FILTER (WHERE pred_class = c) AS n_pred,
             count(*) FILTER (WHERE real_class = c AND pred_class = c) AS n_correct
      FROM l, st GROUP BY c),
u AS (SELECT * FROM p UNION ALL SELECT 'TOTALE', sum(n_real), sum(n_pred), sum(n_correct) FROM p)
SELECT class, CAST(n_real AS BIGINT) AS n_real, CAST(n_pred AS BIGINT) AS n_pred, CAST(n_correct AS BIGINT) AS n_correct,
       round(CASE WHEN n_real > 0 THEN n_correct / n_real * 100 ELSE 0.0 END, 6) AS accuracy_pct FROM u""",
                                        FEAT_CTE, TOP_CTE, SCORED_CTE, _STATES_CTE))
def q_per_class_accuracy(spark, sf):
    return _r6(metrics.per_class_accuracy(_states(spark, sf), "real_class", "pred_class", ["NORMALE", "ATTENZIONE", "ANOMALIA"]))


@register("prediction_distribution", with_wo("""
SELECT c AS label, count(*) FILTER (WHERE pred_class = c) AS n,
       round(count(*) FILTER (WHERE pred_class = c) / (SELECT count(*) FROM st) * 100, 6) AS pct
FROM (VALUES ('NORMALE'), ('ATTENZIONE'), ('ANOMALIA')) v(c), st GROUP BY c""", FEAT_CTE, TOP_CTE, SCORED_CTE, _STATES_CTE))
def q_prediction_distribution(spark, sf):
    return _r6(metrics.prediction_distribution(_states(spark, sf), "pred_class", ["NORMALE", "ATTENZIONE", "ANOMALIA"]))


@register("oee_prediction_buckets", with_wo(f"""
SELECT round(avg(x), 6) AS mean, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) AS n,
       count(*) FILTER (WHERE x < 0.65) AS n_critical, count(*) FILTER (WHERE x >= 0.65 AND x < 0.85) AS n_acceptable,
       count(*) FILTER (WHERE x >= 0.85) AS n_optimal
FROM (SELECT avg(oee) OVER (PARTITION BY machine {_ORDER_SQL} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS x FROM oee_rows) t
WHERE x IS NOT NULL""", OEE_CTE))
def q_oee_prediction_buckets(spark, sf):
    f = features.add_oee_rolling_and_lags(oee_rows(spark, sf))
    return _r6(metrics.oee_prediction_buckets(f, "rolling_oee_3"))


@register("time_error_summary", with_wo("""
SELECT count(*) AS n, count(*) FILTER (WHERE abs(work_hours - rolling_mean_10) < abs(work_hours - theoretical_hours)) AS n_model_better,
       round(mape_e, 6) AS mape_estimate, round(mape_m, 6) AS mape_model,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE abs(work_hours - rolling_mean_10) < abs(work_hours - theoretical_hours)) / count(*) * 100 ELSE 0.0 END, 6) AS pct_model_better,
       round(CASE WHEN mape_e <> 0 THEN (mape_e - mape_m) / mape_e * 100 ELSE 0.0 END, 6) AS mape_reduction_pct
FROM hf, (SELECT avg(CASE WHEN work_hours <> 0 THEN abs(work_hours - theoretical_hours) / work_hours END) * 100 AS mape_e,
                 avg(CASE WHEN work_hours <> 0 THEN abs(work_hours - rolling_mean_10) / work_hours END) * 100 AS mape_m
          FROM hf WHERE rolling_mean_10 IS NOT NULL) m
WHERE rolling_mean_10 IS NOT NULL GROUP BY mape_e, mape_m""", _HOURS_CTE))
def q_time_error_summary(spark, sf):
    return _r6(metrics.time_error_summary(hours_rows(spark, sf), "work_hours", "theoretical_hours", "rolling_mean_10"))


# ---------------------------------------------------------------- models (rows-only checks, except weights)

import datetime as _dt  # noqa: E402
import json as _json  # noqa: E402
import os as _os  # noqa: E402
import uuid as _uuid  # noqa: E402

from oeeflow.plans import ml, score  # noqa: E402

TODAY = _dt.date(2026, 12, 2)  # the report's "today" is a parameter


@register("class_weights", _a_sql("""
SELECT label3, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight
FROM scored GROUP BY label3"""))
def q_class_weights(spark, sf):
    w = ml.class_weights(scored_rows(spark, sf), "label3", "weight")
    return w.groupBy("label3").agg(F.count(F.lit(1)).alias("n"), F.round(F.first("weight"), 9).alias("weight"))


@register("positive_weight", _a_sql("""
SELECT round(count(*) FILTER (WHERE is_anomaly = 0) / greatest(count(*) FILTER (WHERE is_anomaly = 1), 1), 2) AS pos_weight
FROM scored"""))
def q_positive_weight(spark, sf):
    return ml.positive_weight(scored_rows(spark, sf), "is_anomaly")


@register("score_all")
def q_score_all(spark, sf):
    wo = materialize(work_orders(spark, sf))
    models = score.train_all(wo)
    return score.score_all(wo, models)


def _oee_train_rows(spark, sf, more=()):
    wo = work_orders(spark, sf)
    base = score.prepare_articles(wo, encode.top_articles(wo, 30))
    o = features.add_oee_features(oee.compute_oee(base)).filter(F.col("oee").isNotNull())
    return materialize(folds.time_series_folds(o.select(*score.oee_columns(o, more))))


@register("cross_validate")
def q_cross_validate(spark, sf):
    o = _oee_train_rows(spark, sf)
    return ml.cross_validate(o, score.oee_spec(o), "boosted", "regression", k=5,
                             params=score.SIZES["oee"], metrics=("rmse", "mae", "r2"))


@register("grid_search")
def q_grid_search(spark, sf):
    """J10 + J13: the 24 points on the first 80 % in time, the best one fitted again there and
    scored on the last 20 %."""
    o = materialize(folds.temporal_split(_oee_train_rows(spark, sf).drop("_pos", "test_fold", "train_from_fold")))
    tr, te = folds.time_series_folds(o.filter("is_train").drop("_pos")), o.filter("NOT is_train")
    best, table, bundle = ml.grid_search(materialize(tr), score.oee_spec(o), "forest", "regression", ml.FOREST_GRID,
                                         metric="r2", k=5)
    held = metrics.regression_metrics(ml.predict(bundle, te), "oee", "prediction").select("r2")
    chosen = F.col("params") == _json.dumps(best, sort_keys=True)
    return table.crossJoin(F.broadcast(held)).select("params", "score", chosen.alias("chosen"),
                                                     F.when(chosen, F.col("r2")).alias("holdout_r2"))


@register("anomaly_scores")
def q_anomaly_scores(spark, sf):
    s = materialize(feat_rows(spark, sf))
    lab = materialize(labels.label_train_quantiles(s))
    tr = lab.filter("is_train")
    b = ml.fit(tr, score.spec_for(tr, "label", score.LEAKAGE), "boosted", "multiclass", weighted=True,
               params={"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "subsamplingRate": 1.0,
                       "featureSubsetStrategy": "all"})
    out = score.anomaly_scores(b, lab)
    return out.select(*_key_cols(), "label", "pred3", "pred", F.round("prob_anomaly", 6).alias("prob_anomaly"))


@register("oee_forecast_model")
def q_oee_forecast_model(spark, sf):
    o = _oee_train_rows(spark, sf, ("availability", "performance", "quality"))
    b = ml.fit(o, score.oee_spec(o), "boosted", "regression", params=score.SIZES["oee"])
    return score.oee_forecast_with_model(o, b, TODAY)


@register("save_load_model", with_wo("""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM oee_rows WHERE oee IS NOT NULL""", OEE_CTE))
def q_save_load_model(spark, sf):
    """A4: predictions of a fitted model and of the same model saved and loaded, row by row."""
    o = _oee_train_rows(spark, sf, ("cycle_hours",))
    b = ml.fit(o, score.oee_spec(o), "tree", "regression", params={"maxDepth": 5})
    path = shared_dir(spark, f"model-{_uuid.uuid4().hex}")
    ml.save_model(b, path, history=features.cycle_stats_by_article_phase(o))
    p = ml.predict(b, o).withColumnRenamed("prediction", "before")
    both = ml.predict(ml.load_model(spark, path), p.drop(*[c for c in p.columns if c not in [*o.columns, "before"]]))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("n_differ"))


# ---------------------------------------------------------------- small projections and sinks

@register("drop_leakage_columns", with_wo(f"SELECT {KEY_SQL}, machine, pieces_counted FROM work_orders"))
def q_drop_leakage_columns(spark, sf):
    d = clean.drop_leakage_columns(work_orders(spark, sf), ["inefficiency", "work_hours", "theoretical_hours", "article",
                                                            "not_a_column", "cycle_hours"])
    return clean.select_existing(d, [*KEY, "end_ts", "machine", "pieces_counted", "missing_col"]).withColumn(
        "end_ts", F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss"))


@register("fill_categories", with_wo(f"""
SELECT {KEY_SQL}, coalesce(CAST(cic_code AS VARCHAR), 'MISSING') AS cic_code,
       coalesce(CAST(CASE WHEN pieces_reworked = 1 THEN NULL ELSE work_center_planned END AS VARCHAR), 'MISSING') AS work_center_planned,
       coalesce(CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE article END, 'MISSING_ARTICOLO') AS article
FROM work_orders"""))
def q_fill_categories(spark, sf):
    wo = work_orders(spark, sf).withColumns({
        "work_center_planned": F.when(F.col("pieces_reworked") == 1, F.lit(None)).otherwise(F.col("work_center_planned")),
        "article": F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("article"))})
    d = clean.fill_article(clean.fill_categories(wo, ["cic_code", "work_center_planned"]))
    return d.select(*_key_cols(), "cic_code", "work_center_planned", "article")


@register("write_read_partitioned", with_wo(f"""
SELECT {KEY_SQL}, machine, inefficiency FROM work_orders WHERE machine = 'M7'"""))
def q_write_read_partitioned(spark, sf):
    """A3 + A1 + B13: write partitioned by machine, read back, one machine (partition pruning)."""
    from oeeflow.sources.io import read_work_orders, write_table
    path = shared_dir(spark, f"wo-{_uuid.uuid4().hex}")
    write_table(work_orders(spark, sf), path, partition_by=["machine"])
    back = clean.isolate_machine(read_work_orders(spark, path), "M7")
    return back.select(*_key_cols(), "machine", "inefficiency")


@register("write_read_csv", with_wo(f"""
SELECT {KEY_SQL}, work_hours, stop_hours, scrap_material FROM work_orders"""))
def q_write_read_csv(spark, sf):
    """A3 (CSV with header) → A1 (explicit schema, no inference)."""
    from oeeflow.schema import CLEAN_SCHEMA as S
    from oeeflow.sources.io import read_work_orders, write_table
    path = shared_dir(spark, f"wocsv-{_uuid.uuid4().hex}")
    write_table(work_orders(spark, sf).select(*[f.name for f in S.fields]), path, fmt="csv")
    back = read_work_orders(spark, path, fmt="csv", schema=S)
    return back.select(*_key_cols(), "work_hours", "stop_hours", "scrap_material")


@register("write_marts", _a_sql("""
SELECT article_group, count(is_anomaly) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
       round(sum(is_anomaly) / count(is_anomaly) * 100, 1) AS rate_pct
FROM scored WHERE article_group <> 'ALTRO' GROUP BY article_group HAVING count(is_anomaly) >= 3
ORDER BY rate_pct DESC, article_group LIMIT 20"""))
def q_write_marts(spark, sf):
    """A5: marts written as JSON lines and read back."""
    from oeeflow.sources.io import write_marts
    path = shared_dir(spark, f"marts-{_uuid.uuid4().hex}")
    write_marts({"by_article": marts_anomaly.anomaly_by_article(scored_rows(spark, sf))}, path)
    back = spark.read.schema("article_group string, total long, anomalies long, rate_pct double").json(
        _os.path.join(path, "by_article"))
    return back


@register("oee_forecast_features", with_wo("""
WITH src AS (
  SELECT o.*, CASE WHEN o.article IN (SELECT article FROM top20) THEN o.article ELSE 'ALTRO' END AS article_group,
    CASE WHEN setup_hours + work_hours > 0 THEN setup_hours / (setup_hours + work_hours) END AS pct_setup,
    CASE WHEN setup_hours + work_hours > 0 THEN coalesce(stop_hours, 0.0) / (setup_hours + work_hours) ELSE 0.0 END AS pct_stops,
    erp_setup_hours / nullif(erp_machine_hours, 0.0) AS erp_setup_machine_ratio,
    CASE WHEN pieces_counted > 0 THEN (coalesce(scrap_material, 0) + coalesce(scrap_machining, 0) + coalesce(pieces_reworked, 0)) / pieces_counted END AS pct_scrap,
    s.cycle_mean_art, coalesce(s.cycle_std_art, 0.0) AS cycle_std_art
  FROM oee_rows o LEFT JOIN (
    SELECT article, phase, avg(cycle_hours) AS cycle_mean_art, stddev_samp(cycle_hours) AS cycle_std_art
    FROM work_orders WHERE article IS NOT NULL AND phase IS NOT NULL GROUP BY article, phase) s
  ON o.article = s.article AND o.phase = s.phase
  WHERE o.article IS NOT NULL AND o.phase IS NOT NULL),
last3 AS (
  SELECT article, phase, max(CASE WHEN r = 1 THEN oee END) AS l1, max(CASE WHEN r = 2 THEN oee END) AS l2,
         max(CASE WHEN r = 3 THEN oee END) AS l3
  FROM (SELECT article, phase, oee, row_number() OVER (PARTITION BY article, phase
          ORDER BY end_ts DESC, wo DESC, phase DESC, l_partkey DESC, l_suppkey DESC) AS r
        FROM src WHERE oee IS NOT NULL) t GROUP BY article, phase),
med AS (
  SELECT article, phase, count(*) AS n, min(work_center_planned) AS work_center_planned, min(article_group) AS article_group,
    round(quantile_cont(qty_erp, 0.5), 9) AS qty_erp, round(quantile_cont(setup_hours, 0.5), 9) AS setup_hours,
    round(quantile_cont(erp_machine_hours, 0.5), 9) AS erp_machine_hours, round(quantile_cont(erp_setup_hours, 0.5), 9) AS erp_setup_hours,
    round(quantile_cont(cycle_hours, 0.5), 9) AS cycle_hours, round(quantile_cont(erp_setup_machine_ratio, 0.5), 9) AS erp_setup_machine_ratio,
    round(quantile_cont(pct_setup, 0.5), 9) AS pct_setup, round(quantile_cont(pct_stops, 0.5), 9) AS pct_stops,
    round(quantile_cont(pct_scrap, 0.5), 9) AS pct_scrap, round(quantile_cont(cycle_mean_art, 0.5), 9) AS cycle_mean_art,
    round(quantile_cont(cycle_std_art, 0.5), 9) AS cycle_std_art
  FROM src GROUP BY article, phase)
SELECT med.*, 4 AS weekday, 1 AS month, 53 AS iso_week, round(l1, 9) AS lag_1_oee, round(l2, 9) AS lag_2_oee,
       round(l3, 9) AS lag_3_oee,
       round((coalesce(l1, 0.0) + coalesce(l2, 0.0) + coalesce(l3, 0.0))
             / nullif(CAST(l1 IS NOT NULL AS INTEGER) + CAST(l2 IS NOT NULL AS INTEGER) + CAST(l3 IS NOT NULL AS INTEGER), 0), 9) AS rolling_oee_3
FROM med LEFT JOIN last3 USING (article, phase)""", OEE_CTE, TOP_CTE))
def q_oee_forecast_features(spark, sf):
    wo = work_orders(spark, sf)
    base = encode.group_rare_articles(wo, encode.top_articles(wo, 20))
    fe = features.add_oee_features(oee.compute_oee(base), with_lags=False)
    fe = materialize(fe.select(*marts_oee.forecast_columns(fe)))
    f = marts_oee.oee_forecast_features(fe, TODAY)
    num = [c for c, t in f.dtypes if t == "double"]
    return f.select(*[F.round(c, 9).alias(c) if c in num else F.col(c) for c in f.columns])


# ---------------------------------------------------------------- whole reports

from oeeflow.plans import reports  # noqa: E402


@register("anomaly_report")
def q_anomaly_report(spark, sf):
    """All anomaly marts off one table scored by the 3-class model, published as JSON (A5);
    returns the row count of every mart read back."""
    s, bundle = score.score_for_report(materialize(work_orders(spark, sf)))
    marts = reports.anomaly_report(s, bundle.params["top_articles"],
                                   {c: bundle.params[c] for c in ("attention_cut", "anomaly_cut")})
    path = shared_dir(spark, f"anomaly-report-{_uuid.uuid4().hex}")
    reports.publish(marts, path)
    parts = [spark.read.json(_os.path.join(path, n)).groupBy().count().select(F.lit(n).alias("mart"), "count")
             for n in marts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("oee_report")
def q_oee_report(spark, sf):
    """All OEE marts off one OEE table, the forecast by the OEE model, published as JSON (A5); row
    count per mart."""
    wo = materialize(work_orders(spark, sf))
    marts = reports.oee_report(wo, TODAY, model=score.fit_oee(wo))
    path = shared_dir(spark, f"oee-report-{_uuid.uuid4().hex}")
    reports.publish(marts, path)
    parts = [spark.read.json(_os.path.join(path, n)).groupBy().count().select(F.lit(n).alias("mart"), "count")
             for n in marts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- raw CSV export, period labels, learner comparison

@register("read_raw_export_csv", with_raw("""
SELECT wo, phase, l_partkey, l_suppkey,
       strftime(strptime(end_date_raw || ' ' || end_time_raw, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS end_ts,
       TRY_CAST(replace(work_hours, ',', '.') AS DOUBLE) AS work_hours,
       TRY_CAST(replace(stop_hours, ',', '.') AS DOUBLE) AS stop_hours,
       TRY_CAST(replace(cycle_minutes, ',', '.') AS DOUBLE) / 60 AS cycle_hours,
       TRY_CAST(scrap_material AS BIGINT) AS scrap_material
FROM raw_export"""))
def q_read_raw_export_csv(spark, sf):
    """A2: the export written as ';'-separated text with the ERP's own headers, read back
    as STRING columns, renamed once and parsed (B1-B3)."""
    from oeeflow.sources.io import read_raw_export, to_raw_names
    path = shared_dir(spark, f"raw-{_uuid.uuid4().hex}")
    to_raw_names(raw_export_view(spark, sf)).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    raw = read_raw_export(spark, path)
    df = clean.minutes_to_hours(clean.parse_integers(clean.parse_decimal_comma(clean.parse_end_ts(raw))))
    return df.select(F.col("wo").cast("string").alias("wo"), "phase", F.col("l_partkey").cast("string").alias("l_partkey"),
                     F.col("l_suppkey").cast("string").alias("l_suppkey"), ts_text(), "work_hours", "stop_hours",
                     "cycle_hours", "scrap_material")


@register("period_labels", with_wo(f"""
SELECT {KEY_SQL}, strftime(end_ts, '%Y-%m') AS month,
       strftime(date_trunc('week', end_ts), '%Y-%m-%d') || '/' || strftime(date_trunc('week', end_ts) + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
       CAST(day(end_ts) AS BIGINT) AS day_of_month, CAST(day(last_day(end_ts)) AS BIGINT) AS days_in_month,
       strftime(date_trunc('month', end_ts) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month
FROM work_orders"""))
def q_period_labels(spark, sf):
    """H2 + H3: month and Monday-Sunday week labels, calendar scalars."""
    from oeeflow.functions import scalars as S
    wo = work_orders(spark, sf)
    return wo.select(*_key_cols(), S.month_label("end_ts").alias("month"), S.week_label("end_ts").alias("week"),
                     S.day_of_month("end_ts").cast("bigint").alias("day_of_month"),
                     S.days_in_month("end_ts").cast("bigint").alias("days_in_month"),
                     F.date_format(S.next_month_start("end_ts"), "yyyy-MM-dd").alias("next_month"))


def _index_split(spark, sf):
    return materialize(folds.temporal_split(materialize(feat_rows(spark, sf))))


@register("compare_regressors")
def q_compare_regressors(spark, sf):
    """J3-J6 + J14 + J22: the six base regressors of the index on the last 20 % in time,
    ranked by (RMSE, −R²)."""
    d = _index_split(spark, sf)
    tr, te = d.filter("is_train"), d.filter("NOT is_train")
    spec = score.spec_for(tr, "inefficiency", score.LEAKAGE)

    def job(algo):
        def run():
            b = ml.fit(tr, spec, algo, "regression")
            m = metrics.regression_metrics(ml.predict(b, te), "inefficiency", "prediction")
            return materialize(m.select(F.lit(algo).alias("model"), "r2", "mae", "rmse"))
        return run
    rows = ml.side_by_side([job(a) for a in ["linear", "ridge", "lasso", "tree", "forest", "boosted"]])
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r)
    return metrics.compare_models(u, [F.asc("rmse"), F.desc("r2")])


@register("compare_classifiers")
def q_compare_classifiers(spark, sf):
    """J4-J8 + J9 + J18-J22: balanced binary classifiers of the p85 anomaly label on the last
    20 % in time: accuracy, macro F1, anomaly recall, AUC; ranked by macro F1."""
    d = materialize(labels.label_p85_binary(_index_split(spark, sf).drop("anomaly_cut")))
    tr, te = d.filter("is_train"), d.filter("NOT is_train")
    spec = score.spec_for(tr, "label", score.LEAKAGE)

    def run(algo):
        b = ml.fit(tr, spec, algo, "binary", weighted=True)
        p = materialize(ml.predict(b, te).select("label", "prediction", "prob_1"), "scored")
        rep = metrics.classification_report(p.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")
        macro = rep.filter(F.col("class") == "macro avg").select(F.col("f1").alias("f1_macro"))
        acc = rep.filter(F.col("class") == "accuracy").select(F.col("f1").alias("accuracy"))
        rec = metrics.recall_of_class(p, "label", "prediction", 1).withColumnRenamed("recall", "recall_anomaly")
        auc = metrics.roc_auc(p, "label", "prob_1").select("auc")
        return materialize(macro.crossJoin(acc).crossJoin(rec).crossJoin(auc).select(F.lit(algo).alias("model"), "*"))
    rows = ml.side_by_side([lambda a=a: run(a) for a in ["logistic", "tree", "forest", "boosted", "kernel_svm"]])
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r)
    return metrics.compare_models(u, [F.desc("f1_macro"), F.desc("recall_anomaly")])


@register("histogram_density", with_wo("""
SELECT CAST(g AS INTEGER) AS point, round(lo + (hi - lo) * g / 199, 9) AS x,
       round(sum(k * exp(-0.5 * ((lo + (hi - lo) * g / 199 - c) / bw) ^ 2) / (bw * sqrt(2 * 3.141592653589793))) / min(nn), 9) AS density
FROM (SELECT stddev_samp(inefficiency) * pow(CAST(count(inefficiency) AS DOUBLE), -0.2) AS bw, count(inefficiency) AS nn,
             min(inefficiency) AS lo, max(inefficiency) AS hi FROM work_orders) m,
     (SELECT ((lo2 + (bin - 1) * (hi2 - lo2) / 50) + (lo2 + bin * (hi2 - lo2) / 50)) / 2 AS c, count(*) AS k FROM (
        SELECT CASE WHEN hi2 = lo2 THEN 1 ELSE least(CAST(floor((inefficiency - lo2) * 50 / (hi2 - lo2)) AS INTEGER) + 1, 50) END AS bin, lo2, hi2
        FROM work_orders, (SELECT min(inefficiency) AS lo2, max(inefficiency) AS hi2 FROM work_orders) m2
        WHERE inefficiency IS NOT NULL) t GROUP BY bin, lo2, hi2) b,
     range(200) r(g)
GROUP BY g, lo, hi"""))
def q_histogram_density(spark, sf):
    """D8 (curve): Gaussian density of the index on 200 points from the 50 bin counts."""
    d = stats.histogram_density(work_orders(spark, sf), "inefficiency", bins=50, grid=200)
    return d.select("point", F.round("x", 9).alias("x"), F.round("density", 9).alias("density"))
