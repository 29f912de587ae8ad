"""Correlations of pairs: what Spark's ``corr`` gives, without one aggregate of hundreds of buffers."""

import math

from pyspark.sql import functions as F

from oeeflow.operators.stats import correlated_pairs


def rows(spark):
    return spark.range(500).selectExpr(
        "cast(id AS double) AS a", "if(id % 3 = 0, null, id * 2.0 + id % 7) AS b", "1e9D + 3 * (id % 50) AS c", "if(id % 5 = 0, null, 1e9D - (id % 50)) AS d",
        "0.1D AS same", "if(id < 100, 0.3D, null) AS short", "if(id < 100 or id > 400, 0.7D * (id div 400), null) AS step",
        "if(id = 17, double('NaN'), id) AS nan", "if(id = 18, double('Infinity'), id) AS inf", "cast(null AS double) AS none", "cast(id % 10 AS int) AS whole"
    ).repartition(7, "a")


def test_pairs_are_those_of_corr(spark):
    df = rows(spark)
    cols = df.columns
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")                       # there corr of equal values is an error
    try:
        one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}.{b}") for a, b in pairs]).first().asDict()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    for threshold in (-1.0, 0.7):
        want = {p: one[".".join(p)] for p in pairs}
        want = {p: r for p, r in want.items() if r is not None and not math.isnan(r) and abs(r) > threshold and not {"same", "short"} & {*p}}
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlated_pairs(df, cols, threshold).collect()}
        assert got.keys() == want.keys()
        assert {p: (got[p], want[p]) for p in want if abs(got[p] - want[p]) > 1e-8} == {}
    assert not [p for p in got if {"same", "short", "nan", "none"} & {*p}]
    assert ("a", "inf") not in got and ("b", "inf") in got                  # b is NULL where the other is infinite


def test_no_aggregate_of_a_buffer_a_pair(spark):
    plan = correlated_pairs(rows(spark), rows(spark).columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan
    assert correlated_pairs(rows(spark).limit(0), ["a", "b"]).collect() == [] and correlated_pairs(rows(spark), ["a"]).collect() == []
