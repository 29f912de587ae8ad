"""Kernel SVM, regularisation, saved history, feature sets, cuts of out-of-fold scores."""
import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from oeeflow.operators import features, marts_oee, metrics
from oeeflow.plans import ml, score


def ring(spark, n=800):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    return spark.createDataFrame([(float(a), float(b), int(a * a + b * b < 1.2)) for a, b in x], "a double, b double, y int")


def test_kernel_svm_solves_a_ring(spark):
    df, spec = ring(spark), ml.FeatureSpec(["a", "b"], [], "y")
    b = ml.fit(df, spec, "kernel_svm", "binary", weighted=True)
    p = ml.predict(b, df)
    auc = metrics.roc_auc(p, "y", "prob_1").first()["auc"]
    line = metrics.roc_auc(ml.predict(ml.fit(df, spec, "svm", "binary"), df), "y", "score_1").first()["auc"]
    right = p.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert auc > 0.98 and right > 0.93 and line < 0.8
    sums = p.agg(F.max(F.abs(F.col("prob_0") + F.col("prob_1") - 1)), F.min("prob_1"), F.max("prob_1")).first()
    assert sums[0] < 1e-9 and 0 <= sums[1] < 0.2 and 0.8 < sums[2] <= 1
    path = tempfile.mkdtemp(prefix="oeeflow-svm-")
    ml.save_model(b, path)
    again = ml.predict(ml.load_model(spark, path), df).select("prob_1").collect()
    assert all(abs(x[0] - y[0]) < 1e-12 for x, y in zip(p.select("prob_1").collect(), again))


def test_l2_is_one_over_the_weights(spark):
    for algo in ("logistic", "svm"):
        e = ml.make_estimator(algo, "binary", "y", 250)
        assert e.getRegParam() == 1 / 250 and not e.getStandardization()


def test_saved_history_gives_the_training_values(spark):
    rows = [("A", "1", 1.0), ("A", "1", 2.0), ("A", "1", 6.0), ("B", "1", 4.0), ("B", "2", None), (None, "1", 3.0)]
    train = spark.createDataFrame(rows, "article string, phase string, cycle_hours double")
    path = tempfile.mkdtemp(prefix="oeeflow-history-")
    b = ml.fit(train.withColumn("y", F.lit(1.0)).fillna(0.0), ml.FeatureSpec(["cycle_hours"], [], "y"), "tree", "regression")
    ml.save_model(b, path, history=features.cycle_history(train))
    new = spark.createDataFrame([("A", "1", 100.0), ("B", "1", 50.0), ("B", "2", 7.0), ("C", "1", 8.0), ("C", "1", 10.0), (None, "1", 1.0)], train.schema)
    got = {(r["article"], r["phase"]): (r["cycle_mean_art"], r["cycle_std_art"])
           for r in features.join_cycle_stats(new, ml.load_history(spark, path)).collect()}
    want = {(r["article"], r["phase"]): (r["cycle_mean_art"], r["cycle_std_art"]) for r in features.join_cycle_stats(train).collect()}
    for key in (("A", "1"), ("B", "1")):
        assert got[key] == pytest.approx(want[key])
    assert got["B", "2"] == (7.0, 0.0) and got["C", "1"] == pytest.approx((9.0, math.sqrt(2))) and got[None, "1"] == (None, 0.0)
    halves = [features.cycle_history(train.filter(c)) for c in ("cycle_hours < 2", "cycle_hours >= 2")]
    whole = {r["article"]: r for r in features.cycle_history(train).collect()}
    for r in features.merge_cycle_history(*halves).collect():
        assert (r["n"], r["mean"], r["squares"]) == pytest.approx(tuple(whole[r["article"]][c] for c in ("n", "mean", "squares")))


def test_feature_sets(spark):
    df = spark.createDataFrame([tuple(["x"] * 3 + [1.0] * 18)], ["phase", "work_center_planned", "article_group", *[c for c in marts_oee.OEE_FEATURES if c not in (
        "phase", "work_center_planned", "article_group")]])
    all_, plan = (score.oee_spec(df, s) for s in ("as_is", "plan_only"))
    assert set(all_.numeric) - set(plan.numeric) == {"setup_hours", "pct_setup", "pct_stops", "pct_scrap"} and all_.categorical == plan.categorical


def test_last_n_is_cut_before_its_only_shuffle(spark):
    df = spark.range(300).select((F.col("id") % 4).alias("g"), F.col("id").alias("wo"), F.col("id").cast("double").alias("v"))
    out = marts_oee.last_n_per_group(df, ["g"], "v", 3, ["wo"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2
    assert {tuple(r) for r in out.collect()} == {(g, 296.0 + g, 292.0 + g, 288.0 + g) for g in range(4)}


def test_metrics_at_a_cut(spark):
    rows = [(0, 1, 0.9), (0, 0, 0.4), (0, 0, 0.1), (1, 1, 0.2), (1, 0, 0.1), (2, 0, 0.5), (2, 0, 0.6)]
    got = ml.cross_validate_at_cut(spark.createDataFrame(rows, "fold int, y int, p double"), "y", "p", 0.3, 3).first()
    acc, f1 = [2 / 3, 1 / 2, 0.0], [2 / 3, 0.0, 0.0]
    assert got["accuracy_mean"] == pytest.approx(np.mean(acc)) and got["accuracy_std"] == pytest.approx(np.std(acc))
    assert got["recall_mean"] == pytest.approx(1 / 3) and got["f1_mean"] == pytest.approx(np.mean(f1)) and got["f1_std"] == pytest.approx(np.std(f1))
    assert got["auc_mean"] == 1.0 and got["auc_std"] == 0.0                  # the last fold has one class
