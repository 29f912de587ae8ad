import datetime as dt

from pyspark.sql import functions as F

from oeeflow.operators import interact, marts_anomaly, marts_oee
from oeeflow.operators.oee import compute_oee


def _scored(spark, rows):
    return spark.createDataFrame(rows, "end_ts timestamp_ntz, label3 int, is_anomaly int, work_hours double, "
                                       "cycle_hours double, phase string, article_group string, wo long")


def test_calendar_covers_leap_february(spark):
    rows = [(dt.datetime(2024, 2, 29, 8), 2, 1, 1.0, 0.5, "F1", "A", 1),
            (dt.datetime(2024, 2, 3, 8), 0, 0, 1.0, 0.5, "F1", "A", 2),
            (dt.datetime(2024, 2, 3, 9), 1, 0, 1.0, 0.5, "F1", "A", 3)]
    cal = marts_anomaly.day_calendar(_scored(spark, rows))
    days = {r.day: r.state for r in cal.collect()}
    assert len(days) == 29 and days[29] == "anomaly" and days[3] == "attention" and days[1] == "empty"


def test_latest_months_with_gap(spark):
    rows = [(dt.datetime(2023, m, 1), 0, 0, 1.0, 0.5, "F1", "A", m) for m in (1, 2, 3)]
    rows += [(dt.datetime(2024, m, 1), 0, 0, 1.0, 0.5, "F1", "A", 10 + m) for m in (1, 2, 3, 4)]
    got = sorted(r.month for r in marts_anomaly.latest_months(_scored(spark, rows), 6).collect())
    assert got == ["2023-02", "2023-03", "2024-01", "2024-02", "2024-03", "2024-04"]


def test_month_delta_label(spark):
    rows = [(dt.datetime(2024, 1, 5), 2, 1, 1.0, 0.5, "F1", "A", 1),
            (dt.datetime(2024, 2, 5), 0, 0, 1.0, 0.5, "F1", "A", 2)]
    r = marts_anomaly.anomaly_month_delta(_scored(spark, rows)).first()
    assert r.label == "-1 vs 2024-01" and r.delta == -1


def test_period_filter_clamps_month_end(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31),), (dt.datetime(2024, 2, 29),), (dt.datetime(2024, 2, 28),)],
                               "end_ts timestamp_ntz")
    got = sorted(str(r.end_ts.date()) for r in interact.filter_period(df, "1m").collect())
    assert got == ["2024-02-29", "2024-03-31"]


def test_table_filter_expressions(spark):
    df = spark.createDataFrame([(0.70, "Brand#1/X"), (0.7005, "brand#2/y"), (None, "Brand#1/Z")], "oee double, article string")
    assert interact.table_filter(df, {"oee": "=0.7"}, ["oee"]).count() == 2
    assert interact.table_filter(df, {"oee": ">0.7"}, ["oee"]).count() == 1
    assert interact.table_filter(df, {"article": "BRAND#1"}).count() == 2
    assert interact.table_filter(df, {"oee": "70.0"}, ["oee"], ["oee"]).count() == 1


def test_table_sort_nulls_last(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9)], "wo long, oee double")
    asc = {r.wo: r.row_number for r in interact.table_sort(df, "oee", True, ["wo"]).collect()}
    desc = {r.wo: r.row_number for r in interact.table_sort(df, "oee", False, ["wo"]).collect()}
    assert asc == {1: 1, 3: 2, 2: 3} and desc == {3: 1, 1: 2, 2: 3}


def test_oee_marts_invariants(spark, wo):
    o = marts_oee.prepare_oee(wo)
    dist = marts_oee.oee_class_distribution(o)
    assert dist.agg(F.sum("n")).first()[0] == o.count()
    k = marts_oee.oee_kpis(o).first()
    assert 0 <= k.oee_pct <= 100 and k.n_total == o.count()
    assert marts_oee.worst_orders(o).count() <= 10
    last = marts_oee.last_n_per_group(o, ["article", "phase"], "oee", 3)
    ref = (o.groupBy("article", "phase").agg(F.max_by("oee", F.struct("end_ts", "wo", "phase", "l_partkey", "l_suppkey")).alias("m")))
    j = last.join(ref, ["article", "phase"])
    assert j.filter(F.col("m") != F.col("oee_last1")).count() == 0


def test_forecast_features_calendar(spark, wo):
    from oeeflow.operators.encode import group_rare_articles, top_articles
    from oeeflow.operators.features import add_oee_features
    fe = add_oee_features(compute_oee(group_rare_articles(wo, top_articles(wo, 20))))
    f = marts_oee.oee_forecast_features(fe, dt.date(2024, 12, 30)).first()
    assert f.month == 1 and f.weekday == 2 and f.iso_week == 1   # 2025-01-01 is a Wednesday in ISO week 1


def test_report_plans_publish_every_mart(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    q = E.queries()
    a = {r.mart: r["count"] for r in q["anomaly_report"](spark, SF_SMALL).collect()}
    o = {r.mart: r["count"] for r in q["oee_report"](spark, SF_SMALL).collect()}
    assert len(a) == 14 and a["kpis"] == 1 and a["order_table"] > 0
    assert len(o) == 11 and o["kpis"] == 1 and o["order_table"] > 0
