"""The two reports as Spark plans: one materialized base table, every mart read off it
(the reference computes the same aggregates before rendering its pages)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oeeflow.functions.scalars import month_label
from oeeflow.operators import encode, marts_anomaly, marts_oee, metrics
from oeeflow.operators.features import add_oee_features
from oeeflow.plans.ml import ModelBundle, predict
from oeeflow.session import materialize
from oeeflow.sources.io import write_marts


def oee_report(wo: DataFrame, today: _dt.date, top_n: int = 30, predictions: DataFrame | None = None,
               model: ModelBundle | None = None) -> dict[str, DataFrame]:
    """OEE dashboard marts (D12-D16, D28-D29, F1-F2) off one materialized OEE table. ``model``
    forecasts the groups off the report's own feature rows, with its own article list."""
    top = model.params["top_articles"] if model is not None else encode.top_articles(wo, top_n)
    base = encode.group_rare_articles(wo, top)
    o = marts_oee.prepare_oee(base)
    columns = o.columns
    # one written table for the marts and for D28, whose month is a number; D28 takes the last three OEE
    # values per group itself, so the look-back window is skipped
    fe = add_oee_features(o, with_lags=False)
    fe = materialize(fe.select(*marts_oee.forecast_columns(fe, ("week", "oee_class", *marts_oee.COMPONENTS))), "oee")
    o = fe.withColumn("month", month_label("end_ts")).select(*[c for c in columns if c in fe.columns])
    feats = marts_oee.oee_forecast_features(fe, today)
    if model is not None:
        feats = materialize(feats, "oee_forecast_features")
        predictions = predict(model, feats).select("article", "phase", F.col("prediction").alias("oee_pred"))
    return {
        "monthly_trend": marts_oee.oee_monthly_trend(o),
        "class_distribution": marts_oee.oee_class_distribution(o),
        "by_article": marts_oee.oee_by_article(o),
        "kpis": marts_oee.oee_kpis(o),
        "kpis_1m": marts_oee.oee_kpis_by_period(o, "1m"),
        "kpis_3m": marts_oee.oee_kpis_by_period(o, "3m"),
        "kpis_1y": marts_oee.oee_kpis_by_period(o, "1y"),
        "worst_orders": marts_oee.worst_orders(o),
        "order_table": marts_oee.oee_order_table(o),
        "forecast_features": feats,
        "forecast": marts_oee.oee_forecast(o, predictions),
    }


def anomaly_report(scored: DataFrame, known: list[str] | None = None,
                   cuts: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """Anomaly dashboard marts (D17-D27, F3) plus AUC and the tuned cut, off one
    materialized scored table (``score_for_report``, or ``prepare_anomaly`` + a score). ``cuts``:
    ``attention_cut`` and ``anomaly_cut`` of the order table's states."""
    s = materialize(scored, "scored")
    return {
        "kpis": marts_anomaly.anomaly_kpis(s),
        "month_delta": marts_anomaly.anomaly_month_delta(s),
        "kpis_3m": marts_anomaly.anomaly_kpis_by_period(s, "3m"),
        "gauge": marts_anomaly.mean_inefficiency_gauge(s),
        "by_article": marts_anomaly.anomaly_by_article(s),
        "by_phase": marts_anomaly.anomaly_by_phase(s),
        "by_phase_month": marts_anomaly.anomaly_by_phase_month(s),
        "lost_hours_by_month": marts_anomaly.lost_hours_by_month(s),
        "calendar": marts_anomaly.day_calendar(s),
        "orders_by_day": marts_anomaly.orders_by_day_flat(s),
        "risk_forecast": marts_anomaly.anomaly_risk_forecast(s, known),
        "order_table": marts_anomaly.anomaly_order_table(s, **(cuts or {})),
        "auc": metrics.roc_auc(s, "is_anomaly", "prob_anomaly"),
        "tuned_cut": metrics.tune_threshold(s, "is_anomaly", "prob_anomaly"),
    }


def publish(marts: dict[str, DataFrame], path: str) -> None:
    """A5: write every mart as JSON lines under ``path/<name>``."""
    write_marts(marts, path)
