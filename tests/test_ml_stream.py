import tempfile

from pyspark.sql import functions as F

from oeeflow.operators.features import features_inefficiency
from oeeflow.operators.folds import temporal_split
from oeeflow.plans import ml
from oeeflow.plans.score import LEAKAGE, spec_for
from oeeflow.session import materialize


def test_forest_beats_mean_and_round_trips(spark, wo):
    d = materialize(temporal_split(features_inefficiency(wo)))
    tr, te = d.filter("is_train"), d.filter("NOT is_train")
    spec = spec_for(tr, "inefficiency", LEAKAGE)
    b = ml.fit(tr, spec, "forest", "regression", params={"numTrees": 10, "maxDepth": 5})
    p = ml.predict(b, te)
    mean = tr.agg(F.avg("inefficiency")).first()[0]
    rmse_model = p.agg(F.sqrt(F.avg((F.col("inefficiency") - F.col("prediction")) ** 2))).first()[0]
    rmse_mean = te.agg(F.sqrt(F.avg((F.col("inefficiency") - F.lit(mean)) ** 2))).first()[0]
    assert rmse_model < rmse_mean
    path = tempfile.mkdtemp(prefix="oeeflow-model-")
    ml.save_model(b, path)
    again = ml.predict(ml.load_model(spark, path), te)
    diff = p.select(*spec.numeric[:0], "wo", "phase", "l_partkey", "l_suppkey", F.col("prediction").alias("a")).join(
        again.select("wo", "phase", "l_partkey", "l_suppkey", F.col("prediction").alias("b")),
        ["wo", "phase", "l_partkey", "l_suppkey"])
    assert diff.filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r.y: r.weight for r in ml.class_weights(df, "y").distinct().collect()}
    assert abs(w[0] - 8 / 12) < 1e-12 and abs(w[1] - 2.0) < 1e-12


def test_streaming_oee(spark, wo):
    from oeeflow.streaming import oee_stream, write_stream
    src = tempfile.mkdtemp(prefix="oeeflow-src-")
    wo.limit(200).write.mode("overwrite").parquet(src)
    out, ck = tempfile.mkdtemp(prefix="oeeflow-out-"), tempfile.mkdtemp(prefix="oeeflow-ck-")
    q = write_stream(oee_stream(spark, src), out, ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 200 and "oee" in got.columns
