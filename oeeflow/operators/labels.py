"""Inefficiency labels (I9-I12) and probability cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oeeflow.operators.folds import temporal_split
from oeeflow.operators.quantiles import quantiles
from oeeflow.schema import DEFAULT_PROBA_CUT
from oeeflow.session import materialize


def _three_way_le(x: Column, a: Column, b: Column) -> Column:
    """≤ a → 0, ≤ b → 1, else 2 (NULL index lands in 2, as the reference's comparison does)."""
    return F.when(x <= a, F.lit(0)).when(x <= b, F.lit(1)).otherwise(F.lit(2))


def _cuts(df: DataFrame, col: str, probs: list[float], names: list[str]) -> DataFrame:
    """Quantile cuts (one row), written: every plan over the labelled rows reads them."""
    return materialize(quantiles(df, col, probs, names=names), "cuts")


def label_mean_std(df: DataFrame, col: str = "inefficiency", out: str = "label") -> DataFrame:
    """≤ mean → 0, ≤ mean + std → 1, else 2 (mean and sample std of all rows)."""
    s = df.agg(F.avg(col).alias("_m"), F.stddev_samp(col).alias("_s"))
    j = df.crossJoin(F.broadcast(s))  # one row
    return (j.withColumn(out, _three_way_le(F.col(col), F.col("_m"), F.col("_m") + F.col("_s")))
            .withColumnsRenamed({"_m": "attention_cut"})
            .withColumn("anomaly_cut", F.col("attention_cut") + F.col("_s")).drop("_s"))


def label_train_quantiles(df: DataFrame, col: str = "inefficiency", out: str = "label",
                          lo: float = 0.60, hi: float = 0.85, split: DataFrame | None = None) -> DataFrame:
    """Three classes with ``<=`` against p60/p85 of the training part only
    (first 80 % in time). ``split``: an already split frame with ``is_train``."""
    d = split if split is not None else temporal_split(df)
    q = _cuts(d.filter(F.col("is_train")), col, [lo, hi], ["attention_cut", "anomaly_cut"])
    j = d.crossJoin(F.broadcast(q))  # one row
    return j.withColumn(out, _three_way_le(F.col(col), F.col("attention_cut"), F.col("anomaly_cut")))


def label_p85_binary(df: DataFrame, col: str = "inefficiency", out: str = "label", p: float = 0.85,
                     fit_on: str = "all") -> DataFrame:
    """1 when the index is above its p85 (of all rows, or ``fit_on='train'``)."""
    if fit_on == "train":
        d = temporal_split(df)
        q = _cuts(d.filter(F.col("is_train")), col, [p], ["anomaly_cut"])
        base = d
    else:
        q = _cuts(df, col, [p], ["anomaly_cut"])
        base = df
    j = base.crossJoin(F.broadcast(q))  # one row
    return j.withColumn(out, F.when(F.col(col) > F.col("anomaly_cut"), F.lit(1)).otherwise(F.lit(0)))


def label_for_report(df: DataFrame, col: str = "inefficiency", attention_cut: float | None = None,
                     anomaly_cut: float | None = None) -> DataFrame:
    """``is_anomaly`` (index > anomaly cut) and ``label3`` (≥ anomaly → 2, ≥ attention → 1).

    Cuts come from the model parameters; when absent, p85 / p60 of the data.
    """
    if attention_cut is None or anomaly_cut is None:
        q = _cuts(df, col, [0.60, 0.85], ["_p60", "_p85"])
        j = df.crossJoin(F.broadcast(q))  # one row
        att = F.lit(attention_cut) if attention_cut is not None else F.col("_p60")
        ano = F.lit(anomaly_cut) if anomaly_cut is not None else F.col("_p85")
    else:
        j, att, ano = df, F.lit(attention_cut), F.lit(anomaly_cut)
    x = F.col(col)
    j = j.withColumns({"attention_cut": att, "anomaly_cut": ano})
    j = j.withColumns({"is_anomaly": F.when(x > F.col("anomaly_cut"), F.lit(1)).otherwise(F.lit(0)),
                       "label3": F.when(x >= F.col("anomaly_cut"), F.lit(2))
                       .when(x >= F.col("attention_cut"), F.lit(1)).otherwise(F.lit(0))})
    return j.drop("_p60", "_p85")


def apply_threshold(df: DataFrame, prob: str = "prob_anomaly", cut: float | None = DEFAULT_PROBA_CUT,
                    out: str = "pred") -> DataFrame:
    """Probability ≥ cut → 1 (a missing cut means 0.30)."""
    c = DEFAULT_PROBA_CUT if cut is None else cut
    return df.withColumn(out, F.when(F.col(prob) >= F.lit(c), F.lit(1)).otherwise(F.lit(0)))


def apply_two_thresholds(df: DataFrame, p_anomaly: str, p_attention: str, anomaly_cut: float,
                         attention_cut: float, out: str = "pred3") -> DataFrame:
    """J25 (3 classes): class 2 first, then class 1, else 0."""
    return df.withColumn(out, F.when(F.col(p_anomaly) >= anomaly_cut, F.lit(2))
                         .when(F.col(p_attention) >= attention_cut, F.lit(1)).otherwise(F.lit(0)))
