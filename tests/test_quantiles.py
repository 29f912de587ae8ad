import numpy as np

from oeeflow.operators.quantiles import quantiles


def _np(x, p):
    return float(np.quantile(np.asarray(x, dtype=float), p))


def test_global_quantiles_match_numpy(spark, wo):
    x = [r[0] for r in wo.select("inefficiency").collect()]
    probs = [0.0, 0.25, 0.5, 0.6, 0.85, 1.0]
    r = quantiles(wo, "inefficiency", probs, names=[f"q{i}" for i in range(len(probs))]).first()
    for i, p in enumerate(probs):
        assert abs(r[f"q{i}"] - _np(x, p)) <= 1e-12 * max(1.0, abs(_np(x, p)))


def test_grouped_with_ties_and_single_rows(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", 5.0), ("c", None)]
    q = {r.g: r for r in quantiles(spark.createDataFrame(rows, "g string, x double"), "x", [0.25, 0.5], by=["g"],
                                   names=["q1", "med"]).collect()}
    assert q["a"].q1 == 1.0 and q["a"].med == 1.5
    assert q["b"].q1 == 5.0 and q["b"].med == 5.0
    assert "c" not in q   # a group without values is absent


def test_approx_switch(spark, wo):
    r = quantiles(wo, "inefficiency", [0.5], names=["m"], approx=True).first()
    assert r.m is not None


def test_tied_column_stays_one_row_a_value(spark):
    import numpy as np
    x = [0.0] * 9900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    q = quantiles(df, "x", [0.25, 0.5, 0.99, 0.995], names=["a", "b", "c", "d"])
    assert [round(v, 9) for v in q.first()] == [round(float(np.quantile(x, p)), 9) for p in (0.25, 0.5, 0.99, 0.995)]
    assert "collect_list" not in q._jdf.queryExecution().optimizedPlan().toString()


def test_small_groups_of_every_size(spark):
    import numpy as np
    rows = [(n, float((i * 37) % 11)) for n in range(1, 30) for i in range(n)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.6, 0.85, 0.9, 1.0]
    names = [f"p{k}" for k in range(len(probs))]
    for r in quantiles(spark.createDataFrame(rows, "g long, x double"), "x", probs, by=["g"], names=names).collect():
        x = [v for g, v in rows if g == r.g]
        for p, name in zip(probs, names):
            assert abs(r[name] - np.quantile(x, p)) < 1e-9, (r.g, p)


def test_medians_of_several_columns(spark):
    """As ``quantiles`` of each column; a row is shuffled once, not once for each column."""
    from oeeflow.operators.quantiles import medians
    df = spark.range(700).selectExpr("if(id % 11 = 0, null, id % 4) AS g", "id % 3 AS k", "id / 7 AS a", "if(id % 4 = 1, null, id % 9) AS b", "cast(null AS double) AS c")
    m = medians(df, ["a", "b", "c"], ["g", "k"])
    got = {(r["g"], r["k"]): (r["a"], r["b"], r["c"]) for r in m.collect()}
    want = {c: {(r["g"], r["k"]): r["m"] for r in quantiles(df, c, [0.5], by=["g", "k"], names=["m"]).collect()} for c in ("a", "b", "c")}
    assert got == {k: tuple(want[c].get(k) for c in ("a", "b", "c")) for k in want["a"]} and len(got) == 15
    lines = m._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join, long = ([i for i, x in enumerate(lines) if word in x] for word in ("Join", "Generate"))
    assert len(long) == 1 and long[0] < join[0]                             # above the join


def test_forecast_features_write_only_what_is_read(spark, monkeypatch):
    from oeeflow.plans import catalog
    seen, real = [], catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, *a: seen.append(df.columns) or real(df, *a))
    catalog.QUERIES["oee_forecast_features"](spark, "/root/testdata/sf0.001")
    assert not {"machine", "cic_code", "work_hours", "scrap_material", "availability", "oee_class", "inefficiency"} & {*seen[0]}
