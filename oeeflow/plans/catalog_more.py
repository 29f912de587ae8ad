"""Further registered queries: table sorting on every kind of column, tied quantiles, probability
cuts, prediction joins, folds and whole-period KPIs, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from oeeflow.operators import clean, encode, features, folds, interact, labels, marts_anomaly, metrics, oee, stats
from oeeflow.operators.quantiles import quantiles
from oeeflow.plans import ml, score
from oeeflow.plans.catalog import (FEAT_CTE, KEY, KEY_SQL, OEE_CTE, SCORED_CTE, TOP_CTE, ORDER_TIES, _a_sql, _key_cols, _r6, oee_rows, register,
                                   scored_rows)
from oeeflow.plans.oracle_sql import with_wo
from oeeflow.session import materialize
from oeeflow.sources.fixture import work_orders

_TIES_SQL = "end_ts, wo, phase, l_partkey, l_suppkey"
_CLASS_SQL = "CASE oee_class WHEN 'Critico' THEN 0 WHEN 'Accettabile' THEN 1 WHEN 'Ottimo' THEN 2 END"


def _sort_query(name: str, col: str, ascending: bool, key_sql: str):
    ties = ", ".join(t for t in _TIES_SQL.split(", ") if t != col)
    order = f"{key_sql} {'ASC' if ascending else 'DESC'} NULLS LAST, {ties}"

    @register(name, with_wo(f"SELECT {KEY_SQL}, row_number() OVER (ORDER BY {order}) AS row_number FROM oee_rows", OEE_CTE))
    def run(spark, sf):
        s = interact.table_sort(oee_rows(spark, sf), col, ascending=ascending, tie_breakers=ORDER_TIES)
        return s.select(*_key_cols(), "row_number")
    return run


_sort_query("table_sort_article", "article", True, "article")
_sort_query("table_sort_time", "end_ts", False, "end_ts")
_sort_query("table_sort_order_number", "wo", True, "wo")
_sort_query("table_sort_class", "oee_class", False, _CLASS_SQL)


@register("quantiles_tied", with_wo("""
SELECT quantile_cont(pieces_reworked, 0.5) AS reworked, quantile_cont(scrap_machining, 0.5) AS scrap,
       quantile_cont(scrap_machining, 0.9) AS scrap_p90 FROM work_orders"""))
def q_quantiles_tied(spark, sf):
    w = work_orders(spark, sf)
    a = quantiles(w, "pieces_reworked", [0.5], names=["reworked"])
    b = quantiles(w, "scrap_machining", [0.5, 0.9], names=["scrap", "scrap_p90"])
    return a.crossJoin(F.broadcast(b))  # one row each


@register("correlated_pairs_large_means", with_wo("""
SELECT 'a' AS col_a, 'b' AS col_b, round(corr(a, b), 4) AS corr
FROM (SELECT pieces_counted + 1e9 AS a, 3 * pieces_counted + 1e9 AS b FROM work_orders) t"""))
def q_correlated_large(spark, sf):
    w = work_orders(spark, sf).select((F.col("pieces_counted") + 1e9).alias("a"), (3 * F.col("pieces_counted") + 1e9).alias("b"))
    return stats.correlated_pairs(w, ["a", "b"]).select("col_a", "col_b", F.round("corr", 4).alias("corr"))


@register("apply_threshold", _a_sql(f"SELECT {KEY_SQL}, CASE WHEN prob_anomaly >= 0.3 THEN 1 ELSE 0 END AS pred FROM scored"))
def q_apply_threshold(spark, sf):
    return labels.apply_threshold(scored_rows(spark, sf), cut=0.3).select(*_key_cols(), "pred")


@register("apply_two_thresholds", _a_sql(f"""
SELECT {KEY_SQL}, CASE WHEN prob_anomaly >= 0.5 THEN 2 WHEN prob_anomaly >= 0.25 THEN 1 ELSE 0 END AS pred3 FROM scored"""))
def q_apply_two_thresholds(spark, sf):
    s = labels.apply_two_thresholds(scored_rows(spark, sf), "prob_anomaly", "prob_anomaly", 0.5, 0.25)
    return s.select(*_key_cols(), "pred3")


_PRED_KEY = [*KEY, "end_ts"]


@register("join_predictions", with_wo(f"""
SELECT {KEY_SQL}, CASE WHEN machine = 'M3' THEN round(inefficiency, 6) END AS pred FROM work_orders"""))
def q_join_predictions(spark, sf):
    w = work_orders(spark, sf)
    preds = w.filter("machine = 'M3'").select(*_PRED_KEY, F.round("inefficiency", 6).alias("pred"))
    return ml.attach_predictions(w.select(*_PRED_KEY), preds, _PRED_KEY).select(*_key_cols(), "pred")


@register("align_actuals", with_wo(f"""
SELECT {KEY_SQL}, round(work_hours, 6) AS work_hours, round(theoretical_hours, 6) AS theoretical_hours
FROM work_orders WHERE machine = 'M3'"""))
def q_align_actuals(spark, sf):
    w = work_orders(spark, sf)
    a = ml.align_actuals(w.filter("machine = 'M3'").select(*_PRED_KEY), w, _PRED_KEY, ["work_hours", "theoretical_hours"])
    return a.select(*_key_cols(), F.round("work_hours", 6).alias("work_hours"), F.round("theoretical_hours", 6).alias("theoretical_hours"))


@register("sort_by_time", with_wo(f"SELECT {KEY_SQL}, machine FROM work_orders"))
def q_sort_by_time(spark, sf):
    return clean.sort_by_time(work_orders(spark, sf)).select(*_key_cols(), "machine")


@register("make_folds_kfold", with_wo("""
SELECT CAST(p % 5 AS INTEGER) AS fold, count(*) AS n
FROM (SELECT row_number() OVER () - 1 AS p FROM work_orders) t GROUP BY 1"""))
def q_make_folds_kfold(spark, sf):
    f = folds.make_folds(work_orders(spark, sf), "kfold", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("table_filter_percent", with_wo(f"""
SELECT {KEY_SQL}, quality FROM oee_rows WHERE quality IS NOT NULL AND contains(printf('%.1f', quality * 100), '97.')""", OEE_CTE))
def q_table_filter_percent(spark, sf):
    f = interact.table_filter(oee_rows(spark, sf), {"quality": "97.%"}, numeric_cols=["quality"], percent_cols=["quality"])
    return f.select(*_key_cols(), "quality")


@register("anomaly_kpis_all_periods", _a_sql("""
SELECT count(*) AS n_total, count(*) FILTER (WHERE is_anomaly = 1) AS n_anomalies,
       count(*) - count(*) FILTER (WHERE is_anomaly = 1) AS n_normal,
       round(count(*) FILTER (WHERE is_anomaly = 1) / greatest(count(*), 1) * 100, 1) AS rate_pct,
       round(coalesce(sum(CASE WHEN round(work_hours, 3) IS NULL OR round(cycle_hours, 3) IS NULL THEN NULL
                               ELSE greatest(round(work_hours, 3) - round(cycle_hours, 3), 0.0) END), 0.0), 1) AS lost_hours
FROM scored"""))
def q_anomaly_kpis_all(spark, sf):
    return marts_anomaly.anomaly_kpis_by_period(scored_rows(spark, sf), "all").select(
        "n_total", "n_anomalies", "n_normal", "rate_pct", "lost_hours")


def _auc_sql(cls: int, score: str) -> str:
    return f"""(SELECT sum(pos * ((cum - neg) + neg / 2.0)) / (sum(pos) * sum(neg)) * sum(pos) AS part, sum(pos) AS support FROM (
      SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM (
        SELECT {score} AS s, count(*) FILTER (WHERE label3 = {cls}) AS pos, count(*) FILTER (WHERE label3 <> {cls}) AS neg
        FROM scored WHERE prob_anomaly IS NOT NULL GROUP BY 1) g) c)"""


@register("roc_auc_ovr_weighted", _a_sql(f"""
SELECT round(sum(part) / sum(support), 6) AS auc_weighted FROM (
  SELECT * FROM {_auc_sql(0, '1 - prob_anomaly')} UNION ALL SELECT * FROM {_auc_sql(1, 'abs(prob_anomaly - 0.3)')}
  UNION ALL SELECT * FROM {_auc_sql(2, 'prob_anomaly')}) t"""))
def q_roc_auc_ovr(spark, sf):
    s = scored_rows(spark, sf).withColumns({"p0": 1 - F.col("prob_anomaly"), "p1": F.abs(F.col("prob_anomaly") - 0.3)})
    return _r6(metrics.roc_auc_ovr_weighted(s, "label3", {0: "p0", 1: "p1", 2: "prob_anomaly"}))


_FOLDS = """
sn AS (SELECT *, row_number() OVER (ORDER BY end_ts, wo, phase, l_partkey, l_suppkey) - 1 AS p, count(*) OVER () AS n FROM scored),
sf AS (SELECT *, CAST(floor((p - (n - 5 * (n // 6))) / (n // 6)) AS BIGINT) AS fold FROM sn WHERE p >= n - 5 * (n // 6))"""


@register("cross_validate_at_cut", with_wo("""
SELECT round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std, round(avg(recall), 6) AS recall_mean,
       round(stddev_pop(recall), 6) AS recall_std, round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1), 6) AS f1_std,
       round(avg(auc), 6) AS auc_mean, round(stddev_pop(auc), 6) AS auc_std
FROM (SELECT fold, avg(CAST((y = 1) = (s >= 0.3) AS INTEGER)) AS accuracy, hit / greatest(pos, 1) AS recall,
             2 * hit / greatest(pos + count(*) FILTER (WHERE s >= 0.3), 1) AS f1, max(a) AS auc
      FROM (SELECT *, count(*) FILTER (WHERE y = 1 AND s >= 0.3) OVER (PARTITION BY fold) AS hit, count(*) FILTER (WHERE y = 1) OVER (PARTITION BY fold) AS pos,
                   (sum(rk) FILTER (WHERE y = 1) OVER (PARTITION BY fold) - np * (np + 1) / 2) / (np * (nn - np)) AS a
            FROM (SELECT fold, is_anomaly AS y, prob_anomaly AS s, rank() OVER (PARTITION BY fold ORDER BY prob_anomaly)
                         + (count(*) OVER (PARTITION BY fold, prob_anomaly) - 1) / 2.0 AS rk,
                         count(*) FILTER (WHERE is_anomaly = 1) OVER (PARTITION BY fold) AS np, count(*) OVER (PARTITION BY fold) AS nn FROM sf) x) y
      GROUP BY fold, hit, pos) z""", FEAT_CTE, TOP_CTE, SCORED_CTE, _FOLDS))
def q_cross_validate_at_cut(spark, sf):
    """J13 at a fixed cut: five expanding folds of rows whose score is given."""
    s = folds.time_series_folds(scored_rows(spark, sf)).filter("test_fold is not null").withColumn("fold", F.col("test_fold").cast("int"))
    return _r6(ml.cross_validate_at_cut(materialize(s.select("fold", "is_anomaly", "prob_anomaly")), "is_anomaly", "prob_anomaly", 0.3))


@register("error_by_split", _a_sql("""
SELECT round(a, 6) AS train_rmse, round(b, 6) AS test_rmse, round(b - a, 6) AS gap, CASE WHEN b - a > 0.05 THEN 'OVERFITTING' ELSE 'OK' END AS verdict
FROM (SELECT sqrt(avg(e) FILTER (WHERE is_train)) AS a, sqrt(avg(e) FILTER (WHERE NOT is_train)) AS b
      FROM (SELECT pow(inefficiency - lag_1, 2) AS e, row_number() OVER (ORDER BY end_ts, wo, phase, l_partkey, l_suppkey) - 1
                   < floor(CAST(count(*) OVER () AS DOUBLE) * 0.8) AS is_train FROM scored) t) u"""))
def q_error_by_split(spark, sf):
    """RMSE gap of a given prediction (the index of the order before)."""
    s = folds.temporal_split(scored_rows(spark, sf))
    return _r6(metrics.error_by_split(s.filter("is_train"), s.filter("NOT is_train"), "inefficiency", "lag_1", 0.05))


@register("cycle_history", with_wo("""
SELECT article, phase, count(*) AS n, round(avg(cycle_hours), 6) AS mean, round(coalesce(stddev_samp(cycle_hours), 0), 6) AS std
FROM work_orders WHERE article IS NOT NULL AND phase IS NOT NULL AND cycle_hours IS NOT NULL GROUP BY article, phase"""))
def q_cycle_history(spark, sf):
    """The history of three parts of the orders, saved, read back and merged."""
    wo = work_orders(spark, sf)
    parts = [materialize(features.cycle_history(wo.filter(F.col("l_partkey") % 3 == k)), "cycle-history") for k in range(3)]
    h = features.merge_cycle_history(*parts)
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("squares"), F.lit(0.0)) / (F.col("n") - 1))).otherwise(0.0)
    return h.select("article", "phase", "n", F.round("mean", 6).alias("mean"), F.round(std, 6).alias("std"))


@register("compare_feature_sets")
def q_compare_feature_sets(spark, sf):
    """The OEE forest with all features and with those known before the order, on the last 20 % in time."""
    wo = work_orders(spark, sf)
    o = features.add_oee_features(oee.compute_oee(score.prepare_articles(wo, encode.top_articles(wo, 30)))).filter("oee is not null")
    o = materialize(folds.temporal_split(o))
    out = None
    for name in ("as_is", "plan_only"):
        b = ml.fit(o.filter("is_train"), score.oee_spec(o, name), "forest", "regression", params={"numTrees": 100})
        m = metrics.regression_metrics(ml.predict(b, o.filter("NOT is_train")), "oee", "prediction")
        one = m.select(F.lit(name).alias("feature_set"), F.lit(len(b.spec.numeric) + len(b.spec.categorical)).alias("n_features"), "r2", "mae", "rmse")
        out = one if out is None else out.unionByName(one)
    return out
