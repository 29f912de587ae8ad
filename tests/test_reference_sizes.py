"""Model plans run at the reference's sizes, each model with its own article list."""
import inspect

from pyspark.sql import functions as F

from oeeflow.plans import ml, score


def test_sizes_are_the_reference_ones(spark):
    assert "small" not in inspect.signature(score.train_all).parameters
    for algo in ("tree", "forest"):
        assert ml.make_estimator(algo, "regression", "y").getMaxDepth() == 30
    assert len({str(p) for p in ml.FOREST_GRID}) == 24 and max(p["maxDepth"] for p in ml.FOREST_GRID) == 30
    boosted = ml.make_estimator("boosted", "binary", "y")
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (100, 4, 0.3)


def test_each_model_is_trained_and_scored_with_its_own_articles(spark, wo, monkeypatch):
    fitted, groups = [], []

    def fit(df, spec, algo, task="regression", weighted=False, params=None, extra=None):
        fitted.append((spec.label, algo, params, len((extra or {}).get("top_articles", []))))
        return ml.ModelBundle(None, spec, algo, task, {}, dict(extra or {}))

    def predict(bundle, df):
        groups.append((bundle.spec.label, df.select("article_group").distinct().count()))
        return df.withColumns({"prediction": F.lit(0.5), "prob_0": F.lit(0.5), "prob_1": F.lit(0.5)})

    monkeypatch.setattr(score, "fit", fit)
    monkeypatch.setattr(score, "predict", predict)
    models = score.train_all(wo)
    sizes = {(label, algo): (p.get("numTrees") or p.get("maxIter"), p["maxDepth"], n) for label, algo, p, n in fitted}
    assert sizes[("inefficiency", "forest")] == (100, 30, 20)
    assert sizes[("work_hours", "boosted")] == (400, 3, 20)
    assert sizes[("oee", "boosted")] == (100, 6, 30)
    groups.clear()
    score.score_all(wo, models)
    assert dict(groups)["inefficiency"] == 21 and dict(groups)["oee"] == 31


def test_grid_search_refits_the_best_point(spark, monkeypatch):
    df = spark.range(60).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"),
                                (F.col("id") % 3).alias("test_fold"))
    grid = ml.param_grid(maxDepth=[1, 3], minSamplesSplit=[2, 5])
    fits = []
    plain = ml.fit
    monkeypatch.setattr(ml, "fit", lambda d, *a: fits.append(d.count()) or plain(d, *a))
    best, table, bundle = ml.grid_search(df, ml.FeatureSpec(["x"], [], "y"), "tree", "regression", grid, k=3)
    assert table.count() == 4 and best["maxDepth"] == 3
    assert fits == [40] * 6 + [60] and bundle.params["hyper"] == {"maxDepth": 3}
