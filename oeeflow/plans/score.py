"""Batch scoring (J26-J28, A7, D29): six models over one feature pass.

The index and hours look-back features share one chunked window (one shuffle, one sort);
the six models then transform the same frame one after another, without a join. A row without
the lags that a model needs gets NULL in that column only; a missing model yields a typed NULL
column at plan time (J27) and the other five columns are unaffected.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oeeflow.operators.clean import fill_article, numeric_columns
from oeeflow.operators.encode import group_rare_articles, top_articles
from oeeflow.operators.features import add_oee_features, add_ratio_features, add_time_features, features_classification
from oeeflow.operators.folds import temporal_split
from oeeflow.operators.labels import label_for_report, label_p85_binary, label_train_quantiles
from oeeflow.operators.marts_oee import FEATURE_SETS, oee_forecast, oee_forecast_features
from oeeflow.operators.metrics import tune_threshold
from oeeflow.operators.oee import compute_oee
from oeeflow.operators.windows import DEFAULT_ROWS_PER_CHUNK, chunked_window
from oeeflow.plans.ml import UNLIMITED_DEPTH, FeatureSpec, ModelBundle, fit, predict, side_by_side
from oeeflow.session import materialize
from oeeflow.schema import (BINARY_LABELS, CATEGORICAL_COLS, DEFAULT_PROBA_CUT, ORDER_COLS, PARTITION_COLS,
                            STATE_LABELS)

# fixed values: columns never used as model inputs (identifiers, targets, leakage)
LEAKAGE = ["inefficiency", "work_hours", "theoretical_hours", "wo", "article", "article_desc", "dad_id",
           "machine", "work_center_actual", "end_ts", "label", "is_train", "_pos", "l_partkey", "l_suppkey",
           "attention_cut", "anomaly_cut", "oee", "availability", "performance", "quality", "oee_class"]
HOURS_LEAKAGE = LEAKAGE + ["erp_machine_hours"]
LAGS = (1, 2, 3)
WINDOW = 10


def shared_features(df: DataFrame, rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Time and ratio features plus rolling/lag features of the index and of the hours,
    all from one window specification."""
    cols = {}
    for base, pre in (("inefficiency", ""), ("work_hours", "h_")):
        cols[f"{pre}rolling_mean_{WINDOW}"] = (lambda b: lambda w: F.avg(b).over(w.rowsBetween(-WINDOW, -1)))(base)
        cols[f"{pre}rolling_std_{WINDOW}"] = (lambda b: lambda w: F.stddev_samp(b).over(w.rowsBetween(-WINDOW, -1)))(base)
        for k in LAGS:
            cols[f"{pre}lag_{k}"] = (lambda b, kk: lambda w: F.lag(b, kk).over(w))(base, k)
    d = add_ratio_features(add_time_features(df))
    return chunked_window(d, PARTITION_COLS, ORDER_COLS, cols, lookback=WINDOW, rows_per_chunk=rows_per_chunk)


def index_view(f: DataFrame) -> DataFrame:
    """Rows usable by the index models (lags present), hours look-backs hidden."""
    h = [c for c in f.columns if c.startswith("h_")]
    return f.drop(*h).na.drop(subset=[f"lag_{k}" for k in LAGS])


def hours_view(f: DataFrame) -> DataFrame:
    """Rows usable by the hours model, with its look-backs under the standard names."""
    names = [f"rolling_mean_{WINDOW}", f"rolling_std_{WINDOW}", *[f"lag_{k}" for k in LAGS]]
    g = f.drop(*names).withColumnsRenamed({f"h_{n}": n for n in names})
    return g.na.drop(subset=[f"lag_{k}" for k in LAGS])


def spec_for(df: DataFrame, label: str, drop: list[str]) -> FeatureSpec:
    cats = [c for c in CATEGORICAL_COLS if c in df.columns]
    nums = numeric_columns(df, exclude=[*drop, label, *cats])
    return FeatureSpec(nums, cats, label)


def oee_spec(df: DataFrame, feature_set: str = "as_is") -> FeatureSpec:
    """Inputs of the OEE model: ``as_is`` (also what is measured while the order runs) or ``plan_only`` (known before)."""
    names = FEATURE_SETS[feature_set]
    cats = [c for c in names if c in df.columns and dict(df.dtypes)[c] == "string"]
    nums = [c for c in names if c in df.columns and c not in cats]
    return FeatureSpec(nums, cats, "oee")


def oee_columns(df: DataFrame, more: tuple[str, ...] = ()) -> list[str]:
    """The columns of ``df`` that the OEE models and their folds read, and ``more``: written tables hold no others."""
    return [c for c in df.columns if c in {*FEATURE_SETS["as_is"], *FEATURE_SETS["plan_only"], *ORDER_COLS, "article", "phase", "oee", *more}]


def prepare_articles(df: DataFrame, top: list[str] | DataFrame) -> DataFrame:
    return group_rare_articles(fill_article(df), top)


@dataclass
class Models:
    inefficiency: ModelBundle | None = None
    hours: ModelBundle | None = None
    anomaly: ModelBundle | None = None
    anomaly3: ModelBundle | None = None
    custom_cut: ModelBundle | None = None
    oee: ModelBundle | None = None


#: Sizes of the six learners as in the reference (sources: README, "Hyper-parameter map").
SIZES = {
    "inefficiency": {"numTrees": 100, "maxDepth": UNLIMITED_DEPTH},
    "hours": {"maxIter": 400, "maxDepth": 3, "stepSize": 0.01, "subsamplingRate": 0.8},
    "anomaly": {"maxIter": 100, "maxDepth": 4, "stepSize": 0.3},
    "anomaly3": {"numTrees": 100, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 1},
    "custom_cut": {"numTrees": 400, "maxDepth": 4, "minInstancesPerNode": 10, "featureSubsetStrategy": "0.7"},
    "oee": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3},
}


def fit_anomaly3(split: DataFrame, top: list[str]) -> ModelBundle:
    """The 3-class model on the training rows of ``temporal_split`` rows, cuts from those rows."""
    t3 = materialize(label_train_quantiles(split)).filter("is_train")
    cuts = t3.select("attention_cut", "anomaly_cut").first()
    return fit(t3, spec_for(t3, "label", LEAKAGE), "forest", "multiclass", weighted=True, params=SIZES["anomaly3"],
               extra={"top_articles": top, "attention_cut": cuts[0], "anomaly_cut": cuts[1]})


def fit_oee(wo: DataFrame, top_n: int = 30, rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> ModelBundle:
    """The OEE model on the first 80 % in time, with its own article list."""
    top = [r[0] for r in top_articles(wo, top_n).select("article").collect()]  # n values
    o = add_oee_features(compute_oee(prepare_articles(wo, top)), rows_per_chunk=rows_per_chunk)
    o = o.filter(F.col("oee").isNotNull()).select(*oee_columns(o))
    train = materialize(temporal_split(o)).filter("is_train")
    return fit(train, oee_spec(train), "boosted", "regression", params=SIZES["oee"], extra={"top_articles": top})


def score_for_report(wo: DataFrame, top_n: int = 20) -> tuple[DataFrame, ModelBundle]:
    """The rows of the anomaly report with classes and probabilities of the 3-class model, whose cuts
    also label them."""
    top = [r[0] for r in top_articles(fill_article(wo), top_n).select("article").collect()]  # n values
    split = materialize(temporal_split(materialize(features_classification(prepare_articles(wo, top)))))
    bundle = fit_anomaly3(split, top)
    rows = label_for_report(split.drop("is_train", "_pos"), attention_cut=bundle.params["attention_cut"],
                            anomaly_cut=bundle.params["anomaly_cut"])
    return anomaly_scores(bundle, rows).drop("prediction", "prob_0", "prob_1", "prob_2"), bundle


def train_all(wo: DataFrame, top_n: int = 20, oee_top_n: int = 30,
              rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> Models:
    """Train the six models on the first 80 % in time (thresholds from the training rows) at
    ``SIZES``, side by side. The OEE model has its own article list (``oee_top_n``); a bundle carries the list
    that it was trained on."""
    top = [r[0] for r in top_articles(fill_article(wo), top_n).select("article").collect()]  # n values
    base = materialize(prepare_articles(wo, top))
    f = materialize(shared_features(base, rows_per_chunk))
    split = materialize(temporal_split(index_view(f)))
    train = split.filter("is_train")
    extra = {"top_articles": top}
    hs = materialize(temporal_split(hours_view(f))).filter("is_train")
    b = materialize(label_p85_binary(train, fit_on="all"))
    cut = b.select("anomaly_cut").first()[0]
    binary = spec_for(b, "label", LEAKAGE)

    def custom_cut():
        # fit on the first 80 % of the training rows, tune the cut on the rest
        inner = materialize(temporal_split(b.drop("is_train", "_pos")))
        mc = fit(inner.filter("is_train"), binary, "forest", "binary", weighted=True, params=SIZES["custom_cut"])
        tuned = tune_threshold(predict(mc, inner.filter("NOT is_train")), "label", "prob_1").first()
        return fit(b, binary, "forest", "binary", weighted=True, params=SIZES["custom_cut"],
                   extra={**extra, "anomaly_cut": cut, "proba_cut": float(tuned["cut"]) if tuned else DEFAULT_PROBA_CUT})
    jobs = {
        "hours": lambda: fit(hs, spec_for(hs, "work_hours", HOURS_LEAKAGE), "boosted", "regression", params=SIZES["hours"], extra=extra),
        "oee": lambda: fit_oee(wo, oee_top_n, rows_per_chunk),
        "anomaly": lambda: fit(b, binary, "boosted", "binary", weighted=True, params=SIZES["anomaly"],
                               extra={**extra, "anomaly_cut": cut, "proba_cut": DEFAULT_PROBA_CUT}),
        "inefficiency": lambda: fit(train, spec_for(train, "inefficiency", LEAKAGE), "forest", "regression",
                                    params=SIZES["inefficiency"], extra=extra),
        "anomaly3": lambda: fit_anomaly3(split, top),
        "custom_cut": custom_cut,
    }
    return Models(**dict(zip(jobs, side_by_side(list(jobs.values())))))


def _score_column(bundle: ModelBundle, how: str) -> F.Column:
    """The reported value of one model, over the columns that ``predict`` adds."""
    if how == "value":
        return F.col("prediction")
    if how == "clip01":
        return F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    if how == "binary_cut":
        cut = bundle.params.get("proba_cut") or DEFAULT_PROBA_CUT
        return F.when(F.col("prob_1") >= cut, BINARY_LABELS[1]).otherwise(BINARY_LABELS[0])
    return (F.when(F.col("prediction") == 2, STATE_LABELS[2]).when(F.col("prediction") == 1, STATE_LABELS[1])
            .otherwise(STATE_LABELS[0]))


def score_all(wo: DataFrame, models: Models, rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """J26 + J27 + A7: the result table of the six scorers (FIXTURES §6 contract).

    All models transform one frame, one after another, without a join: the frame's columns travel
    in a struct, each model sees them under the names and with the article list it was trained
    on, and a row without the model's look-backs gets NULL. A missing model blanks its column; a failing one is an error
    that names it.
    """
    base = materialize(prepare_articles(wo, []))  # each model groups by its own list below
    # at scoring time the OEE look-backs are unknown: the model's medians fill them
    frame = add_oee_features(compute_oee(shared_features(base, rows_per_chunk)), with_lags=False).withColumns(
        {c: F.lit(None).cast("double") for c in ["rolling_oee_3", "lag_1_oee", "lag_2_oee", "lag_3_oee"]})
    cols = frame.columns
    hours = [f"rolling_mean_{WINDOW}", f"rolling_std_{WINDOW}", *[f"lag_{k}" for k in LAGS]]
    hours_names = {**{f"h_{n}": n for n in hours}, **{n: None for n in hours}}
    index_names = {f"h_{n}": None for n in hours}
    parts = {
        "hours_pred": (models.hours, hours_names, "h_", "value", "double"),
        "inefficiency_pred": (models.inefficiency, index_names, "", "value", "double"),
        "class_anomaly": (models.anomaly, index_names, "", "binary_cut", "string"),
        "class_anomaly3": (models.anomaly3, index_names, "", "three", "string"),
        "class_custom_cut": (models.custom_cut, index_names, "", "binary_cut", "string"),
        "oee_pred": (models.oee, index_names, None, "clip01", "double"),
    }
    out, scores = frame.select(F.struct(*cols).alias("_row")), []
    for name, (bundle, names, lags, how, kind) in parts.items():
        if bundle is None:
            out = out.withColumn(name, F.lit(None).cast(kind))
        else:
            view = out.select("_row", *scores, *[F.col(f"_row.{c}").alias(names.get(c, c)) for c in cols if names.get(c, c)])
            view = group_rare_articles(view, bundle.params.get("top_articles", []))
            try:
                p = predict(bundle, view)
            except Exception as e:
                raise RuntimeError(f"score_all: the model of {name} failed") from e
            value = _score_column(bundle, how)
            if lags is not None:
                present = F.lit(True)
                for k in LAGS:
                    present = present & F.col(f"_row.{lags}lag_{k}").isNotNull()
                value = F.when(present, value)
            out = p.select("_row", *scores, value.alias(name))
        scores.append(name)
    out = out.select("_row.*", *scores)
    return out.select("wo", "phase", "article", F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss").alias("end_ts"), "machine",
                      "theoretical_hours", "hours_pred", "work_hours",
                      "inefficiency", "inefficiency_pred", "class_anomaly", "class_anomaly3", "class_custom_cut",
                      F.col("oee").alias("oee_real"), "oee_pred")


def anomaly_scores(bundle: ModelBundle, rows: DataFrame) -> DataFrame:
    """Predicted class (3-class), anomaly flag (= class 2) and probability of the anomaly class."""
    p = predict(bundle, rows)
    if bundle.task == "multiclass":
        return p.withColumns({"pred3": F.col("prediction").cast("int"), "pred": (F.col("prediction") == 2).cast("int"),
                              "prob_anomaly": F.col("prob_2")})
    return p.withColumns({"pred3": F.col("prediction").cast("int"), "pred": F.col("prediction").cast("int"),
                          "prob_anomaly": F.col("prob_1")})


def oee_forecast_with_model(o: DataFrame, bundle: ModelBundle | None, today: _dt.date,
                            keys: tuple[str, ...] = ("article", "phase")) -> DataFrame:
    """Next month's OEE per (article, phase) from the model on the D28 feature rows;
    groups the model cannot score fall back to their mean OEE."""
    preds = None
    if bundle is not None:
        feats = oee_forecast_features(o, today, keys)
        preds = predict(bundle, feats).select(*keys, F.col("prediction").alias("oee_pred"))
    return oee_forecast(o, preds, keys)
