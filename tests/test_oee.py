import pytest
from pyspark.sql import functions as F

from oeeflow.operators import oee

COLS = ("setup_hours double, work_hours double, stop_hours double, inefficiency double, pieces_counted long, "
        "scrap_material long, scrap_machining long, pieces_reworked long")


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_class_edges_are_right_closed(spark):
    # availability 1, quality 1, performance = 1 / index → OEE exactly 0.65 / 0.85 / 0.9
    rows = [(0.0, 1.0, None, 1 / 0.65, 10, 0, 0, 0), (0.0, 1.0, None, 1 / 0.85, 10, 0, 0, 0),
            (0.0, 1.0, None, 1 / 0.9, 10, 0, 0, 0)]
    out = oee.compute_oee(frame(spark, rows)).select(F.round("oee", 12).alias("o"), "oee_class").collect()
    got = {round(r.o, 6): r.oee_class for r in out}
    assert got[0.65] == "Critico" and got[0.85] == "Accettabile" and got[0.9] == "Ottimo"


def test_left_closed_kpi_edges(spark):
    df = spark.createDataFrame([(0.65,), (0.85,), (0.5,)], "oee double")
    got = {r.oee: r.c for r in df.select("oee", oee.oee_class_expr("oee", closed="left").alias("c")).collect()}
    assert got == {0.65: "Accettabile", 0.85: "Ottimo", 0.5: "Critico"}


def test_null_rules(spark):
    rows = [(0.0, 0.0, None, 1.0, 10, 0, 0, 0),      # planned time 0 → availability NULL
            (1.0, 1.0, None, 0.0, 10, 0, 0, 0),      # index 0 → performance NULL
            (1.0, 1.0, None, 1.0, 0, 0, 0, 0)]       # no pieces → quality NULL
    r = oee.compute_oee(frame(spark, rows)).collect()
    assert r[0].availability is None and r[0].oee is None and r[0].oee_class is None
    assert r[1].performance is None
    assert r[2].quality is None


def test_clipping_and_null_scraps(spark):
    rows = [(1.0, 1.0, 5.0, 0.5, 10, None, 20, 1)]   # stops > time, scraps > pieces, index < 1
    r = oee.compute_oee(frame(spark, rows)).first()
    assert r.availability == 0.0 and r.quality == 0.0 and r.performance == 1.0 and r.oee == 0.0


def test_defined_predicate_matches_oee(spark, wo):
    o = oee.compute_oee(wo)
    a = o.filter(F.col("oee").isNotNull()).count()
    b = o.filter(oee.oee_defined_expr(wo)).count()
    assert a == b


def test_alerts_reasons(spark):
    df = spark.createDataFrame([(0.5, 0.9, 0.9, 0.6), (0.9, 0.9, 0.9, 0.9)],
                               "oee double, availability double, performance double, quality double")
    r = oee.oee_alerts(df).collect()
    assert len(r) == 1 and r[0].alert_reasons == ["oee", "quality"]


def test_lost_hours_null_guard(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 3.0), (None, 1.0)], "work_hours double, cycle_hours double")
    got = [r.lost_hours for r in oee.lost_hours(df).collect()]
    assert got == [2.0, 0.0, None]


def test_empty_input_keeps_schema(spark):
    out = oee.compute_oee(frame(spark, []))
    assert out.count() == 0 and {"oee", "oee_class"} <= set(out.columns)
