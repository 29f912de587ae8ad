import numpy as np
import pytest
from pyspark.sql import functions as F

from oeeflow.operators import clean
from oeeflow.sources.fixture import raw_export_view
from tests.conftest import SF_SMALL


def test_parse_timestamp_strict_and_lenient(spark):
    df = spark.createDataFrame([("29/02/2024", "23:59:59"), ("31/02/2024", "10:00:00")], "end_date_raw string, end_time_raw string")
    good = spark.createDataFrame([("29/02/2024", "23:59:59")], "end_date_raw string, end_time_raw string")
    ok = clean.parse_end_ts(good).first().end_ts
    assert str(ok) == "2024-02-29 23:59:59"
    lenient = [r.end_ts for r in clean.parse_end_ts(df, lenient=True).collect()]
    assert lenient[1] is None
    with pytest.raises(Exception):
        clean.parse_end_ts(df).collect()


def test_decimal_comma(spark):
    df = spark.createDataFrame([("12,5", None), ("0,000001", "3")], "work_hours string, setup_hours string")
    r = clean.parse_decimal_comma(df, ["work_hours", "setup_hours"]).collect()
    assert r[0].work_hours == 12.5 and r[0].setup_hours is None and r[1].work_hours == 1e-06 and r[1].setup_hours == 3.0


def test_raw_round_trip_matches_clean_hours(spark, wo):
    raw = raw_export_view(spark, SF_SMALL)
    p = clean.parse_integers(clean.parse_decimal_comma(clean.parse_end_ts(raw)))
    j = p.select("wo", "phase", "l_partkey", "l_suppkey", "end_ts", F.col("work_hours").alias("wh")).join(
        wo.select("wo", "phase", "l_partkey", "l_suppkey", "end_ts", "work_hours"),
        ["wo", "phase", "l_partkey", "l_suppkey", "end_ts"])
    assert j.count() == wo.count()
    assert j.filter(F.col("wh") != F.col("work_hours")).count() == 0


def test_iqr_filter_matches_numpy(spark, wo):
    x = np.array([r[0] for r in wo.select("inefficiency").collect()])
    q1, q3 = np.quantile(x, [0.25, 0.75])
    expected = int(((x < q3 + 1.5 * (q3 - q1)) & (x > q1 - 1.5 * (q3 - q1))).sum())
    assert clean.iqr_filter(wo).count() == expected


def test_derive_filters_zero_theoretical(spark):
    df = spark.createDataFrame([(1.0, 0.0, 10), (1.0, 0.1, 10)], "work_hours double, cycle_hours double, pieces_counted long")
    r = clean.derive_inefficiency(df).collect()
    assert len(r) == 1 and abs(r[0].inefficiency - 1.0) < 1e-12


def test_fill_and_select(spark):
    df = spark.createDataFrame([(None, None)], "article string, phase string")
    r = clean.fill_categories(clean.fill_article(df), ["phase"]).first()
    assert r.article == "MISSING_ARTICOLO" and r.phase == "MISSING"
    assert clean.select_existing(df, ["phase", "nope"]).columns == ["phase"]
    assert clean.fill_article(spark.createDataFrame([(1,)], "x int")).first().article == "MISSING_ARTICOLO"


def test_sort_by_time_orders_ties(spark, wo):
    rows = clean.sort_by_time(wo).select("end_ts", "wo").limit(50).collect()
    assert all((a.end_ts, a.wo) <= (b.end_ts, b.wo) for a, b in zip(rows, rows[1:]))


def test_density_integrates_to_one(spark, wo):
    from oeeflow.operators.stats import histogram_density
    d = histogram_density(wo, "inefficiency", bins=50, grid=400).orderBy("point").collect()
    step = d[1].x - d[0].x
    assert 0.8 < sum(r.density for r in d) * step < 1.05
