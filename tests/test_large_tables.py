"""Plans of steps that large tables go through: no interpreted search, no copied expressions, cuts written once."""

import datetime as dt

from oeeflow.operators.labels import label_for_report
from oeeflow.operators.marts_oee import last_n_per_group
from oeeflow.operators.oee import compute_oee, oee_alerts
from oeeflow.operators.windows import assign_chunks

ORDERS = ("setup_hours double, work_hours double, stop_hours double, inefficiency double, pieces_counted long, scrap_material long, "
          "scrap_machining long, pieces_reworked long, article string, end_ts timestamp_ntz, wo long")


def _orders(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1.0, 4.0, 0.5, 1.0 + k % 3, 10, None, k % 2, 0, "A" if k % 2 else "B", day + dt.timedelta(days=k), k) for k in range(12)]
    return spark.createDataFrame([*rows, (0.0, 0.0, None, 1.0, 10, 0, 0, 0, "C", day, 99)], ORDERS)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_alerts_filter_carries_no_copy_of_the_oee(spark):
    o = compute_oee(_orders(spark))
    a = oee_alerts(o)
    assert _optimized(a).count("greatest(") <= 2 * _optimized(o).count("greatest(")
    low = [r for r in o.collect() if any(r[c] is not None and r[c] < 0.65 for c in ("oee", "availability", "performance", "quality"))]
    got = {r["wo"]: r["alert_reasons"] for r in a.collect()}
    assert got == {r["wo"]: [c for c in ("oee", "availability", "performance", "quality") if r[c] is not None and r[c] < 0.65] for r in low}


def test_last_values_filter_carries_no_copy_of_the_oee(spark):
    o = compute_oee(_orders(spark))
    last = last_n_per_group(o, ["article"], "oee", 3)
    assert _optimized(last).count("greatest(") <= 2 * _optimized(o).count("greatest(")
    got = {r["article"]: list(r[1:]) for r in last.collect()}
    rows = sorted((r for r in o.collect() if r["oee"] is not None), key=lambda r: r["end_ts"], reverse=True)
    assert got == {x: [r["oee"] for r in rows if r["article"] == x][:3] for x in "AB"}    # C has no OEE


def test_chunks_are_found_without_lambdas(spark):
    df = spark.range(5000).selectExpr("concat('M', id % 3) AS g", "if(id % 50 = 0, null, id) AS k")
    c = assign_chunks(df, ["g"], ["k"], 300)
    assert "lambda" not in _optimized(c)
    rows = sorted(c.collect(), key=lambda r: (r["g"], -1 if r["k"] is None else r["k"]))
    assert [r["_chunk"] for r in rows] == sorted(r["_chunk"] for r in rows)
    assert len({r["_chunk"] for r in rows}) > 8


def test_report_cuts_are_written_once(spark):
    df = spark.range(100).selectExpr("id / 10 AS inefficiency")
    out = label_for_report(df)
    assert "percentile" not in _optimized(out)
    assert sum(r["is_anomaly"] for r in out.collect()) == 15
