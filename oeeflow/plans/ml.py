"""Learning on MLlib (J1-J13, A4): preparation, learners, class weights, folds-based
search and cross-validation, persistence.

A fitted model is a :class:`ModelBundle`: an MLlib ``PipelineModel`` plus the parameters
the reference kept next to its pickles (feature lists, exact medians, top articles, cuts).
Fits are the only actions; the driver loops only over folds and grid points.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oeeflow.operators.labels import apply_threshold
from oeeflow.operators.metrics import roc_auc
from oeeflow.operators.quantiles import quantiles
from oeeflow.operators.windows import _join_on
from oeeflow.plans.boosting import BoostedModel, Boosting, fit_boosting, probability
from oeeflow.plans.forest import Binning, ForestModel, fit_forest
from oeeflow.plans.kernel import KernelSVM, fit_kernel_svm
from oeeflow.schema import MISSING
from oeeflow.session import materialize

SEED = 42
UNLIMITED_DEPTH = 30  # MLlib's greatest depth, for the reference's max_depth=None


@dataclass
class FeatureSpec:
    numeric: list[str]
    categorical: list[str]
    label: str


@dataclass
class ModelBundle:
    model: PipelineModel | list[PipelineModel] | ForestModel | BoostedModel | KernelSVM
    spec: FeatureSpec
    algo: str
    task: str                              # "regression" | "binary" | "multiclass"
    medians: dict[str, float] = field(default_factory=dict)
    params: dict[str, Any] = field(default_factory=dict)


# ---------------------------------------------------------------- preparation

def numeric_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians of the numeric features (one small row reaches the driver: one value
    per column). MLlib's ``Imputer`` would be approximate."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_f"), F.col(c).cast("double").alias("_v"))
                                         for c in cols])).alias("_s")).select("_s._f", "_s._v")
    rows = quantiles(long, "_v", [0.5], by=["_f"], names=["_m"], few_groups=True).collect()
    got = {r["_f"]: r["_m"] for r in rows}
    return {c: float(got[c]) if got.get(c) is not None else 0.0 for c in cols}


def fill_features(df: DataFrame, spec: FeatureSpec, medians: dict[str, float]) -> DataFrame:
    """Numeric NULL → median (NaN first turned to NULL), categorical → STRING with ``MISSING``."""
    num = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(medians.get(c, 0.0)))
           for c in spec.numeric}
    cat = {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in spec.categorical}
    return df.withColumns({**num, **cat})


def binary_categoricals(df: DataFrame, cols: list[str]) -> set[str]:
    """Categorical columns with exactly two levels (one aggregate, bounded output)."""
    if not cols:
        return set()
    row = df.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(MISSING))).alias(c) for c in cols]).first()
    return {c for c in cols if row[c] == 2}


def prep_stages(spec: FeatureSpec, kind: str = "tree", binary: set[str] | None = None) -> list:
    """J1 (``linear``: scaled numerics, one-hot with one column dropped for binary features)
    and J2 (``tree``: numerics as they are, full one-hot). Unseen levels → all zeros."""
    binary = binary or set()
    stages, vec_cols = [], []
    for c in spec.categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if kind == "linear" and c in binary:
            # drop-if-binary: a single 0/1 column for the second level, unseen → 0
            stages.append(SQLTransformer(statement=f"SELECT *, CAST(`{c}__idx` = 1 AS DOUBLE) AS `{c}__bin` FROM __THIS__"))
            vec_cols.append(f"{c}__bin")
        else:
            # dropLast removes the "unseen" slot: known levels one-hot, unseen all zeros
            stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True))
            vec_cols.append(f"{c}__ohe")
    if kind == "linear":
        stages.append(VectorAssembler(inputCols=spec.numeric, outputCol="__num"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True))
        stages.append(VectorAssembler(inputCols=["__num_s", *vec_cols], outputCol="features"))
    else:
        stages.append(VectorAssembler(inputCols=[*spec.numeric, *vec_cols], outputCol="features"))
    return stages


# ---------------------------------------------------------------- learners

LINEAR_ALGOS = {"linear", "ridge", "lasso", "logistic", "svm", "kernel_svm"}


def make_estimator(algo: str, task: str, label: str, n_rows: int | None = None, weight_col: str | None = None,
                   **p):
    """MLlib learner for a reference model name (hyper-parameter map in the README); of trees, forests and boosting
    only its parameters are used (``fit_forest``, ``fit_boosting``)."""
    common = {"labelCol": label, "featuresCol": "features"}
    if task == "regression":
        if algo == "linear":
            return LinearRegression(regParam=0.0, elasticNetParam=0.0, standardization=False, **common)
        if algo == "ridge":  # alpha = 1 → regParam = alpha / n
            return LinearRegression(regParam=p.get("alpha", 1.0) / max(n_rows or 1, 1), elasticNetParam=0.0,
                                    standardization=False, **common)
        if algo == "lasso":
            return LinearRegression(regParam=p.get("alpha", 1.0), elasticNetParam=1.0, standardization=False, **common)
        if algo == "tree":
            return DecisionTreeRegressor(seed=SEED, maxDepth=p.get("maxDepth", UNLIMITED_DEPTH),
                                         minInstancesPerNode=p.get("minInstancesPerNode", 1), **common)
        if algo == "forest":
            return RandomForestRegressor(seed=SEED, numTrees=p.get("numTrees", 100), maxDepth=p.get("maxDepth", UNLIMITED_DEPTH),
                                         minInstancesPerNode=p.get("minInstancesPerNode", 1),
                                         featureSubsetStrategy=p.get("featureSubsetStrategy", "all"), **common)
        if algo == "boosted":
            return GBTRegressor(seed=SEED, maxIter=p.get("maxIter", 100), maxDepth=p.get("maxDepth", 6),
                                stepSize=p.get("stepSize", 0.3), subsamplingRate=p.get("subsamplingRate", 1.0),
                                featureSubsetStrategy=p.get("featureSubsetStrategy", "all"), **common)
    else:
        w = {"weightCol": weight_col} if weight_col else {}
        l2 = 1.0 / max(n_rows or 1, 1)  # C = 1: one over the sum of weights (balanced weights sum to the rows)
        if algo == "logistic":
            return LogisticRegression(maxIter=p.get("maxIter", 1000), regParam=p.get("regParam", l2), standardization=False,
                                      family="auto", **common, **w)
        if algo == "tree":
            return DecisionTreeClassifier(seed=SEED, maxDepth=p.get("maxDepth", 6),
                                          minInstancesPerNode=p.get("minInstancesPerNode", 8), **common, **w)
        if algo == "forest":
            return RandomForestClassifier(seed=SEED, numTrees=p.get("numTrees", 300), maxDepth=p.get("maxDepth", 8),
                                          minInstancesPerNode=p.get("minInstancesPerNode", 8),
                                          featureSubsetStrategy=p.get("featureSubsetStrategy", "sqrt"), **common, **w)
        if algo == "boosted":
            return GBTClassifier(seed=SEED, maxIter=p.get("maxIter", 100), maxDepth=p.get("maxDepth", 4),
                                 stepSize=p.get("stepSize", 0.3), subsamplingRate=p.get("subsamplingRate", 0.8),
                                 featureSubsetStrategy=p.get("featureSubsetStrategy", "0.8"),
                                 minInfoGain=p.get("minInfoGain", 0.0), **common, **w)
        if algo == "svm":  # linear; "kernel_svm" is the RBF one
            return LinearSVC(maxIter=p.get("maxIter", 100), regParam=p.get("regParam", l2), standardization=False, **common, **w)
    raise ValueError(f"unknown algorithm {algo!r} for {task}")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced sample weights n / (k · n_c), from a count per class (k rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")  # one row per class


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """J9 (binary): negatives / positives rounded to 2 decimals (one row)."""
    return df.agg(F.round(F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1)), 2)
                  .alias("pos_weight"))


# ---------------------------------------------------------------- fit / predict

def side_by_side(jobs: list[Callable[[], Any]], at_once: int = 6) -> list[Any]:
    """Results of independent fits that run at the same time: one fit's driver work and short stages
    leave most cores idle, which the tasks of the others use. ``at_once`` bounds what is held. A job may
    call this again: a pool's thread has no active session of its own."""
    inherit = inheritable_thread_target(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def forest_sizes(algo: str, task: str, p: dict[str, Any]) -> dict[str, Any]:
    """Arguments of :func:`fit_forest` for J4 (one tree on all rows) and J5."""
    plain = task == "regression"
    own = {"num_trees": 100 if plain else 300, "max_depth": UNLIMITED_DEPTH if plain else 8, "min_leaf": 1 if plain else 8,
           "feature_subset": "all" if plain else "sqrt", "bootstrap": True}
    if algo == "tree":
        own |= {"num_trees": 1, "feature_subset": "all", "bootstrap": False, "max_depth": UNLIMITED_DEPTH if plain else 6}
    names = {"numTrees": "num_trees", "maxDepth": "max_depth", "minInstancesPerNode": "min_leaf", "featureSubsetStrategy": "feature_subset",
             "minSamplesSplit": "min_split"}
    return {"min_split": 2, **own, **{names[k]: v for k, v in p.items() if k in names}}


def fit(df: DataFrame, spec: FeatureSpec, algo: str, task: str = "regression", weighted: bool = False,
        params: dict[str, Any] | None = None, extra: dict[str, Any] | None = None) -> ModelBundle:
    """Fit preparation + learner. ``weighted``: balanced class weights.
    Multi-class boosting is one-vs-rest binary GBTs with normalised probabilities."""
    p = dict(params or {})
    medians = numeric_medians(df, spec.numeric)
    d = fill_features(df, spec, medians)
    kind = "linear" if algo in LINEAR_ALGOS else "tree"
    binary = binary_categoricals(d, spec.categorical) if kind == "linear" else set()
    wcol = None
    if weighted and task != "regression":
        d = class_weights(d, spec.label, "_w")
        if p.get("positiveFactor", 1.0) != 1.0:
            d = d.withColumn("_w", F.col("_w") * F.when(F.col(spec.label) == 1, p["positiveFactor"]).otherwise(1.0))
        wcol = "_w"
    if algo in ("tree", "forest"):
        sizes = forest_sizes(algo, task, p)
        classes = {"regression": 0, "binary": 2, "multiclass": 3}[task]
        forest = fit_forest(d, spec.numeric, spec.categorical, spec.label, classes, wcol, seed=SEED, **sizes)
        return ModelBundle(forest, spec, algo, task, medians, {**(extra or {}), "hyper": p})
    if algo == "boosted":
        own = make_estimator(algo, "regression" if task == "regression" else "binary", spec.label, **p)
        how = Boosting(own.getMaxIter(), own.getMaxDepth(), own.getStepSize(), own.getSubsamplingRate(), own.getFeatureSubsetStrategy(),
                       own.getMinInfoGain())
        classes = {"regression": 0, "binary": 2, "multiclass": 3}[task]
        boosted = fit_boosting(d, spec.numeric, spec.categorical, spec.label, classes, wcol, how, SEED, side_by_side)
        return ModelBundle(boosted, spec, algo, task, medians, {**(extra or {}), "hyper": p})
    used = [*spec.numeric, *spec.categorical, spec.label, *([wcol] if wcol else [])]
    d = d.select(*dict.fromkeys(used)).persist()
    try:
        n_rows = d.count()
        prep = prep_stages(spec, kind, binary)
        if algo == "kernel_svm":
            if task != "binary":
                raise ValueError("kernel_svm is a two-class learner")
            svm = fit_kernel_svm(d, Pipeline(stages=prep).fit(d), spec.label, wcol, p.get("gamma"), p.get("maxIter", 100), SEED)
            return ModelBundle(svm, spec, algo, task, medians, {**(extra or {}), "hyper": p})
        if task == "multiclass" and algo == "svm":
            models = []
            for c in (0, 1, 2):
                dc = d.withColumn("_y", (F.col(spec.label) == c).cast("double"))
                est = make_estimator(algo, "binary", "_y", n_rows, wcol, **p)
                models.append(Pipeline(stages=[*prep, est]).fit(dc))
            model: PipelineModel | list[PipelineModel] = models
        else:
            est = make_estimator(algo, task, spec.label, n_rows, wcol, **p)
            model = Pipeline(stages=[*prep, est]).fit(d)
    finally:
        d.unpersist()
    return ModelBundle(model, spec, algo, task, medians, {**(extra or {}), "hyper": p})


def _largest(scores: list[Column]) -> Column:
    """The class (of three) with the largest score, the last of equal ones."""
    best = F.when((scores[2] >= scores[1]) & (scores[2] >= scores[0]), 2).when(scores[1] >= scores[0], 1).otherwise(0)
    return best.cast("double")


def _one_vs_rest(scored: DataFrame, keep: list[str], out: str) -> DataFrame:
    """``_raw0`` to ``_raw2`` as probabilities that add up to 1."""
    tot = F.col("_raw0") + F.col("_raw1") + F.col("_raw2")
    probs = [F.when(tot > 0, F.col(f"_raw{c}") / tot).otherwise(F.lit(1.0 / 3)) for c in (0, 1, 2)]
    return scored.select(*keep, _largest(probs).alias(out), *[p.alias(f"prob_{c}") for c, p in enumerate(probs)])


def predict(bundle: ModelBundle, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Scores with the bundle: ``prediction`` and, for classifiers, ``prob_<k>`` columns."""
    d = fill_features(df, bundle.spec, bundle.medians)
    keep = df.columns
    if isinstance(bundle.model, list):  # one-vs-rest; boosting only in models saved before it was ours
        raw = "rawPrediction" if bundle.algo == "svm" else "probability"
        scored = d
        for c, m in enumerate(bundle.model):
            scored = m.transform(scored).withColumn(f"_raw{c}", vector_to_array(raw)[1]).select(*scored.columns, f"_raw{c}")
        if bundle.algo != "svm":
            return _one_vs_rest(scored, keep, out)
        margins = [F.col(f"_raw{c}") for c in (0, 1, 2)]
        return scored.select(*keep, _largest(margins).alias(out), *[p.alias(f"score_{c}") for c, p in enumerate(margins)])
    if isinstance(bundle.model, BoostedModel):
        t = bundle.model.score(d)
        margins = [F.col("_margins")[c] for c in range(len(bundle.model.trees))]
        if bundle.task == "regression":
            return t.select(*keep, margins[0].alias(out))
        if bundle.task == "binary":
            return t.select(*keep, (margins[0] > 0).cast("double").alias(out), (1 - probability(margins[0])).alias("prob_0"),
                            probability(margins[0]).alias("prob_1"))
        return _one_vs_rest(t.select(*keep, *[probability(m).alias(f"_raw{c}") for c, m in enumerate(margins)]), keep, out)
    if isinstance(bundle.model, ForestModel):
        t = bundle.model.score(d)
        if bundle.task == "regression":
            return t.select(*keep, F.col("_forest")[0].alias(out))
        best = F.array_position("_forest", F.array_max("_forest")) - 1
        return t.select(*keep, best.cast("double").alias(out), *[F.col("_forest")[c].alias(f"prob_{c}") for c in range(bundle.model.classes)])
    if isinstance(bundle.model, KernelSVM):
        prob = F.col("_prob")
        return bundle.model.score(d).select(*keep, (F.col("_margin") > 0).cast("double").alias(out), (1 - prob).alias("prob_0"), prob.alias("prob_1"),
                                            F.col("_margin").alias("score_1"))
    t = bundle.model.transform(d)
    cols = [F.col("prediction").alias(out)]
    if bundle.task != "regression" and "probability" in t.columns:
        k = 2 if bundle.task == "binary" else 3
        arr = vector_to_array("probability")
        cols += [arr[c].alias(f"prob_{c}") for c in range(k)]
    elif bundle.algo == "svm":
        cols.append(vector_to_array("rawPrediction")[1].alias("score_1"))
    return t.select(*keep, *cols)


# ---------------------------------------------------------------- search and CV

def fold_parts(df: DataFrame, f: int, fold_col: str, train_col: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of fold ``f``; without ``train_col`` a fold trains on all others."""
    train = F.col(train_col) <= f if train_col in df.columns else F.col(fold_col) != f
    return df.filter(train), df.filter(F.col(fold_col) == f)


def out_of_fold(df: DataFrame, spec: FeatureSpec, algo: str, task: str, fold_col: str = "test_fold", train_col: str = "train_from_fold",
                k: int = 5, params: dict[str, Any] | None = None, weighted: bool = False) -> DataFrame:
    """The test rows of all folds with the scores of their fold's model (``prediction``, ``prob_<k>``): one
    written table that every metric reads. The folds are fitted side by side."""
    def job(f):
        def run():
            train, test = fold_parts(df, f, fold_col, train_col)
            scored = predict(fit(train, spec, algo, task, weighted, params), test)
            probs = [c for c in scored.columns if c.startswith(("prob_", "score_")) and c not in df.columns]
            return materialize(scored.select(F.lit(f).alias("fold"), spec.label, "prediction", *probs), "out-of-fold")
        return run
    parts = side_by_side([job(f) for f in range(k)])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_metrics(scored: DataFrame, label: str, task: str, prediction: str = "prediction") -> DataFrame:
    """One row a fold: rmse, mae and r2, or accuracy and the recalls and F1 of classes 1 and 2 (0 where a
    class has no rows or predictions)."""
    y, p = F.col(label), F.col(prediction)
    if task == "regression":
        e = y - p
        return scored.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                                          (1 - F.sum(e * e) / (F.var_pop(label) * F.count(F.lit(1)))).alias("r2"))
    hit = {c: F.count_if((y == c) & (p == c)) for c in (1, 2)}
    one = lambda x: F.greatest(x, F.lit(1))
    return scored.groupBy("fold").agg(
        F.avg((y == p).cast("double")).alias("accuracy"), (hit[1] / one(F.count_if(y == 1))).alias("recall"),
        (hit[2] / one(F.count_if(y == 2))).alias("recall_2"), (2 * hit[1] / one(F.count_if(y == 1) + F.count_if(p == 1))).alias("f1"))


def over_folds(per_fold: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Mean and population standard deviation of every metric over the folds that have it (one row)."""
    return per_fold.agg(*[x for m in metrics for x in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))])


def cross_validate(df: DataFrame, spec: FeatureSpec, algo: str, task: str, fold_col: str = "test_fold",
                   train_col: str = "train_from_fold", k: int = 5, params: dict[str, Any] | None = None,
                   metrics: tuple[str, ...] = ("rmse", "mae", "r2"), weighted: bool = False) -> DataFrame:
    """Fit on each fold's training rows, score its test rows; mean and population std
    of every metric. ``df`` carries :func:`time_series_folds` (or ``make_folds``) columns."""
    scored = out_of_fold(df, spec, algo, task, fold_col, train_col, k, params, weighted)
    return over_folds(fold_metrics(scored, spec.label, task), metrics)


def cross_validate_at_cut(scored: DataFrame, label: str, prob: str, cut: float, k: int = 5) -> DataFrame:
    """J13, fixed cut: accuracy, recall and F1 of class 1 where ``prob`` reaches ``cut``, and the AUC, of an
    out-of-fold table (``fold`` in [0, k)); mean and population std. A fold with one class has no AUC
    and does not count there."""
    at = apply_threshold(scored, prob, cut, "_at_cut")
    auc = None
    for f in range(k):
        one = roc_auc(scored.filter(F.col("fold") == f), label, prob).select(F.lit(f).alias("fold"), "auc")
        auc = one if auc is None else auc.unionByName(one)
    names = ("accuracy", "recall", "f1", "auc")
    return over_folds(fold_metrics(at, label, "binary", "_at_cut").join(auc, "fold", "left"), names)


#: Grid axes that cut a grown forest instead of growing another one.
FOREST_CUTS = ("numTrees", "maxDepth", "minSamplesSplit")
#: Axes of the reference's learners that MLlib's boosting has no parameter for.
UNMATCHED = ("minSamplesSplit", "regAlpha", "regLambda")


def _forest_cut(point: dict[str, Any], task: str) -> tuple[int, int, int]:
    sizes = forest_sizes("forest", task, point)
    return sizes["num_trees"], sizes["max_depth"], sizes["min_split"]


def _forest_scores(df: DataFrame, spec: FeatureSpec, task: str, points: list[dict[str, Any]], metric: str, k: int, weighted: bool,
                   fold_col: str, train_col: str) -> list[float]:
    """Mean fold scores of forests that differ only in ``FOREST_CUTS``: a fold grows one forest, of the most
    trees, greatest depth and least split size, and all points are read off it in one pass."""
    cuts = [_forest_cut(p, task) for p in points]
    largest = {**points[0], "numTrees": max(c[0] for c in cuts), "maxDepth": max(c[1] for c in cuts), "minSamplesSplit": min(c[2] for c in cuts)}

    def fold(f):
        train, test = fold_parts(df, f, fold_col, train_col)
        bundle = fit(train, spec, "forest", task, weighted, largest)
        test = fill_features(test, spec, bundle.medians).repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
        scored = bundle.model.score(test, cuts).select(F.lit(f).alias("fold"), spec.label, "_forest")
        width = bundle.model.classes or 1
        one = []
        for i in range(len(cuts)):
            values = [F.col("_forest")[i * width + c] for c in range(width)]
            best = values[0] if width == 1 else (F.array_position(F.array(*values), F.greatest(*values)) - 1).cast("double")
            one.append(best.alias(f"p{i}"))
        scored = materialize(scored.select("fold", spec.label, *one), "grid-scores")
        per = None
        for i in range(len(cuts)):
            m = fold_metrics(scored, spec.label, task, f"p{i}").select(F.lit(i).alias("point"), F.col(metric).alias("score"))
            per = m if per is None else per.unionByName(m)
        return {r["point"]: r["score"] for r in per.collect()}              # a row for each point
    by_fold = side_by_side([lambda f=f: fold(f) for f in range(k)], at_once=3)
    return [sum(scores[i] for scores in by_fold) / k for i in range(len(cuts))]


def grid_search(df: DataFrame, spec: FeatureSpec, algo: str, task: str, grid: list[dict[str, Any]],
                metric: str = "r2", maximize: bool = True, k: int = 5, weighted: bool = False,
                fold_col: str = "test_fold", train_col: str = "train_from_fold"
                ) -> tuple[dict[str, Any], DataFrame, ModelBundle]:
    """Mean fold score of every grid point; returns the best point (the first of equal ones), the
    score table and the model of the best point fitted again on all rows of ``df``. Forests that differ
    only in ``FOREST_CUTS`` share one forest a fold; for other learners points that differ only in what
    MLlib has no parameter for share their fits."""
    drop = FOREST_CUTS if algo == "forest" else UNMATCHED
    groups: dict[str, list[dict[str, Any]]] = {}
    for point in grid:
        groups.setdefault(json.dumps({n: v for n, v in point.items() if n not in drop}, sort_keys=True), []).append(point)
    scores = {}
    for points in groups.values():
        if algo == "forest":
            found = _forest_scores(df, spec, task, points, metric, k, weighted, fold_col, train_col)
        else:
            own = {n: v for n, v in points[0].items() if n not in UNMATCHED}
            cv = cross_validate(df, spec, algo, task, fold_col, train_col, k, own, (metric,), weighted).first()
            found = [cv[f"{metric}_mean"]] * len(points)
        scores |= {json.dumps(p, sort_keys=True): float(s) for p, s in zip(points, found)}
    results = [{"params": json.dumps(p, sort_keys=True), "score": scores[json.dumps(p, sort_keys=True)]} for p in grid]
    best = json.loads((max if maximize else min)(results, key=lambda r: r["score"])["params"])
    bundle = fit(df, spec, algo, task, weighted, best if algo == "forest" else {n: v for n, v in best.items() if n not in UNMATCHED})
    return best, df.sparkSession.createDataFrame(results), bundle


def param_grid(**axes: list[Any]) -> list[dict[str, Any]]:
    """Cartesian grid from named axes (``ParamGridBuilder`` over plain names)."""
    import itertools
    keys = list(axes)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[axes[k] for k in keys])]


#: The 24 points of the regression forest.
FOREST_GRID = param_grid(numTrees=[200, 400], maxDepth=[UNLIMITED_DEPTH, 10, 20], minSamplesSplit=[2, 5],
                         minInstancesPerNode=[2, 5])
#: The 24 points of the index boosting.
BOOSTED_GRID = param_grid(maxIter=[200, 400], maxDepth=[3, 6, 10], stepSize=[0.01, 0.1], subsamplingRate=[0.8, 1.0])
#: The 48 points of the custom-cut forest, searched by recall.
CUT_FOREST_GRID = param_grid(numTrees=[200, 400], maxDepth=[4, 6, 8], minSamplesSplit=[10, 20], minInstancesPerNode=[5, 10],
                             featureSubsetStrategy=["sqrt", "0.7"])
#: The 576 points of the custom-cut boosting; ``positiveFactor``
#: multiplies the weight of class 1.
CUT_BOOSTED_GRID = param_grid(maxIter=[200, 400], maxDepth=[3, 6, 10], stepSize=[0.05, 0.1], subsamplingRate=[0.8],
                              featureSubsetStrategy=["0.8"], minInstancesPerNode=[3, 5], regAlpha=[0.0, 0.5], regLambda=[1.0, 3.0],
                              minInfoGain=[0.0, 1.0], positiveFactor=[1.0, 1.5, 2.0])


# ---------------------------------------------------------------- persistence (A4)

def save_model(bundle: ModelBundle, path: str, history: DataFrame | None = None) -> None:
    """A4: MLlib persistence for the pipeline(s) and one JSON row of parameters;
    ``history`` (cycle statistics at training time) is written next to them."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    forest, kernel, boosted, models = None, None, None, bundle.model if isinstance(bundle.model, list) else [bundle.model]
    if isinstance(bundle.model, KernelSVM):
        m = bundle.model
        models = [m.prep, PipelineModel(stages=[m.svm])]
        kernel = {"weights": m.weights.tolist(), "shifts": m.shifts.tolist(), "slope": m.slope, "intercept": m.intercept}
    if isinstance(bundle.model, ForestModel):
        m, models = bundle.model, []
        spark.read.parquet(m.path).write.mode("overwrite").parquet(os.path.join(path, "forest"))
        forest = {"binning": m.binning.__dict__, "classes": m.classes, "num_trees": m.num_trees, "max_depth": m.max_depth, "tops": m.tops}
    if isinstance(bundle.model, BoostedModel):
        boosted, models = bundle.model.save(spark, os.path.join(path, "boosted")), []
    for i, m in enumerate(models):
        m.write().overwrite().save(os.path.join(path, f"pipeline_{i}"))
    meta = {"forest": forest, "kernel": kernel, "boosted": boosted, "spec": bundle.spec.__dict__, "algo": bundle.algo, "task": bundle.task, "medians": bundle.medians,
            "params": bundle.params, "n_models": len(models), "one_vs_rest": isinstance(bundle.model, list)}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "params"))
    if history is not None:
        history.write.mode("overwrite").parquet(os.path.join(path, "history"))


def load_model(spark: SparkSession, path: str) -> ModelBundle:
    """A4: load a bundle; a missing model is an error (as in the reference)."""
    meta = json.loads(spark.read.text(os.path.join(path, "params")).first()[0])
    models = [PipelineModel.load(os.path.join(path, f"pipeline_{i}")) for i in range(meta["n_models"])]
    if meta["kernel"]:
        own = meta["kernel"]
        model = KernelSVM(models[0], np.array(own["weights"]), np.array(own["shifts"]), models[1].stages[0], own["slope"], own["intercept"])
    elif meta.get("boosted"):
        model = BoostedModel.load(spark, os.path.join(path, "boosted"), **meta["boosted"])
    elif meta["forest"]:
        own = meta["forest"]
        model = ForestModel(os.path.join(path, "forest"), Binning(**own.pop("binning")), **own)
    else:
        model = models if meta["one_vs_rest"] else models[0]
    return ModelBundle(model, FeatureSpec(**meta["spec"]), meta["algo"], meta["task"], meta["medians"], meta["params"])


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """The cycle history that :func:`save_model` wrote next to a model (C1 at scoring)."""
    return spark.read.parquet(os.path.join(path, "history"))


def attach_predictions(df: DataFrame, preds: DataFrame, key: list[str]) -> DataFrame:
    """Left join of predictions on the row key; rows without a score get NULL."""
    return _join_on(df, preds, key, "left")


def align_actuals(preds: DataFrame, actual: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """The actual values of the predicted rows (inner join on the row key)."""
    return _join_on(preds, actual.select(*key, *cols), key, "inner")
