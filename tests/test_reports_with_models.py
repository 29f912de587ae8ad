"""The registered reports take their forecast and scores from fitted models."""
from pyspark.sql import functions as F

from oeeflow.plans import catalog, reports, score
from tests.conftest import SF_SMALL


def test_reports_pass_model_output_to_the_marts(spark, monkeypatch):
    light = {**score.SIZES, "anomaly3": {"numTrees": 5, "maxDepth": 3}, "oee": {"maxIter": 2, "maxDepth": 2}}
    monkeypatch.setattr(score, "SIZES", light)
    seen = {}
    plain, plain_oee = reports.anomaly_report, reports.oee_report
    monkeypatch.setattr(reports, "publish", lambda marts, path: seen.update(marts) or spark.range(1).write.json(path + "/x"))
    monkeypatch.setattr(reports, "anomaly_report", lambda s, *a: seen.update(scored=s) or plain(s, *a))
    monkeypatch.setattr(reports, "oee_report", lambda *a, **k: plain_oee(*a, **k))
    for query in (catalog.q_anomaly_report, catalog.q_oee_report):
        try:
            query(spark, SF_SMALL)
        except Exception as e:  # nothing was published to read back
            assert "PATH_NOT_FOUND" in str(e), e
    s = seen["scored"]
    by_lag = F.round(F.least(F.greatest(F.col("lag_1") / 4, F.lit(0.0)), F.lit(1.0)), 2)
    row = s.agg(F.count(F.lit(1)).alias("n"), F.count("prob_anomaly").alias("scored"),
                F.count_if(F.col("prob_anomaly") == by_lag).alias("as_lag")).first()
    assert row.n == row.scored > 0 and row.as_lag < row.n / 2
    forecast = seen["forecast"].agg(F.count(F.lit(1)).alias("n"), F.count_if("use_model").alias("model")).first()
    assert forecast.n == forecast.model > 0
