"""Boosting grows MLlib's trees: the same predictions on tables that both see whole, and figures that do not depend on the cut."""
import tempfile

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from oeeflow.plans import boosting, forest, ml


def rows(spark, n=1500, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.integers(0, 6, n)
    c = rng.choice(["x", "y", "z", "u"], n)
    y = 2.0 * a + np.where(c == "x", 3.0, 0.0) + (b > 3) + rng.normal(size=n) * 0.1
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), str(c[i]), float(y[i]), int(y[i] > 2), int(y[i] > 0) + int(y[i] > 2))
                                  for i in range(n)], "i int, a double, b double, c string, y double, y2 int, y3 int").repartition(3, "i")


PARAMS = {"maxIter": 12, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


def mllib(df, label, task, weight=None):
    spec = ml.FeatureSpec(["a", "b"], ["c"], label)
    est = ml.make_estimator("boosted", task, label, weight_col=weight, **PARAMS)
    return Pipeline(stages=[*ml.prep_stages(spec), est]).fit(df).transform(df)


@pytest.mark.parametrize("cut", [{}, {"TASK_ROWS": 500, "BLOCK_ROWS": 64, "CHUNK_ROWS": 64, "MAX_OPEN": 3, "DRIVER_BYTES": 0}])
def test_regression_is_mllibs(spark, monkeypatch, cut):
    for name, value in cut.items():
        monkeypatch.setattr(forest if name == "BLOCK_ROWS" else boosting, name, value)
    df = rows(spark)
    b = ml.fit(df, ml.FeatureSpec(["a", "b"], ["c"], "y"), "boosted", "regression", params=PARAMS)
    assert isinstance(b.model, boosting.BoostedModel) and len(b.model.trees[0]) == 12
    got = {r["i"]: r["prediction"] for r in ml.predict(b, df).collect()}
    want = {r["i"]: r["prediction"] for r in mllib(df, "y", "regression").collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9 and len(got) == 1500


def test_weighted_classes_are_mllibs(spark):
    df = rows(spark)
    b = ml.fit(df, ml.FeatureSpec(["a", "b"], ["c"], "y2"), "boosted", "binary", weighted=True, params=PARAMS)
    got = {r["i"]: (r["prediction"], r["prob_1"]) for r in ml.predict(b, df).collect()}
    want = mllib(ml.class_weights(df, "y2", "_w"), "y2", "binary", "_w").withColumn("p", vector_to_array("probability")[1]).collect()
    assert all(got[r["i"]][0] == r["prediction"] and abs(got[r["i"]][1] - r["p"]) < 1e-9 for r in want)


def test_one_vs_rest_saved_and_loaded(spark):
    df = rows(spark)
    spec = ml.FeatureSpec(["a", "b"], ["c"], "y3")
    b = ml.fit(df, spec, "boosted", "multiclass", weighted=True, params=PARAMS)
    got = ml.predict(b, df).orderBy("i").collect()
    weighted, raw = ml.class_weights(df, "y3", "_w"), []
    for c in range(3):
        one = mllib(weighted.withColumn("_y", (F.col("y3") == c).cast("double")), "_y", "binary", "_w")
        raw.append({r["i"]: r["p"] for r in one.withColumn("p", vector_to_array("probability")[1]).collect()})
    for r in got:
        whole = sum(x[r["i"]] for x in raw)
        assert all(abs(r[f"prob_{c}"] - raw[c][r["i"]] / whole) < 1e-9 for c in range(3))
    path = tempfile.mkdtemp(prefix="oeeflow-model-")
    ml.save_model(b, path)
    assert ml.predict(ml.load_model(spark, path), df).orderBy("i").collect() == got


def test_sampled_rows_and_features(spark):
    df = rows(spark)
    spec = ml.FeatureSpec(["a", "b"], ["c"], "y2")
    b = ml.fit(df, spec, "boosted", "binary", weighted=True, params={"maxIter": 20, "maxDepth": 3})
    assert b.model.trees and len(b.model.trees[0]) == 20
    s = ml.predict(b, df)
    assert s.filter((F.col("prediction") == F.col("y2"))).count() > 1425
    again = ml.predict(ml.fit(df, spec, "boosted", "binary", weighted=True, params={"maxIter": 20, "maxDepth": 3}), df)
    assert s.orderBy("i").collect() == again.orderBy("i").collect()


def test_cuts_and_awkward_rows(spark):
    v = np.array([1.0, 1.0, 2.0, 5.0])
    assert boosting.numeric_cuts(v, np.ones(4), 32) == [1.5, 3.5]
    many = np.arange(1000.0)
    cuts = boosting.numeric_cuts(many, np.ones(1000), 32)
    assert len(cuts) == 31 and max(np.diff(cuts)) <= 32
    assert boosting.numeric_cuts(np.array([3.0]), np.ones(1), 32) == []
    df = rows(spark, 300)
    spec = ml.FeatureSpec(["a", "b"], ["c"], "y")
    b = ml.fit(df, spec, "boosted", "regression", params={"maxIter": 3, "maxDepth": 3})
    odd = spark.createDataFrame([(1, 1e9, None, "never", 0.0), (2, None, 0.0, None, 0.0)], "i int, a double, b double, c string, y double")
    assert ml.predict(b, odd).filter("prediction IS NOT NULL AND NOT isnan(prediction)").count() == 2 and ml.predict(b, odd.limit(0)).count() == 0
    flat = df.withColumns({"a": F.lit(1.0), "c": F.lit("x"), "b": F.lit(2.0)})
    assert ml.predict(ml.fit(flat, spec, "boosted", "regression", params={"maxIter": 3}), flat).select("prediction").distinct().count() == 1
    for bad in (df.limit(0), df.withColumn("y", F.lit(None).cast("double")), df.withColumn("a", F.lit(float("inf")))):
        with pytest.raises(ValueError):
            ml.fit(bad, spec, "boosted", "regression", params={"maxIter": 3})


def test_fits_side_by_side_fit_side_by_side(spark):
    """A fit in a pool's thread, which has no active session, grows its own models side by side."""
    df, spec = rows(spark, 300), ml.FeatureSpec(["a", "b"], ["c"], "y3")

    def job():
        return ml.fit(df, spec, "boosted", "multiclass", params={**PARAMS, "maxIter": 2})
    for b in ml.side_by_side([job, job]):
        assert [len(trees) for trees in b.model.trees] == [2, 2, 2]
