"""Chunked windows write nothing; written tables and shuffles of the steps behind them hold only what is read."""

import os

from pyspark.sql import functions as F

from oeeflow.operators.windows import chunked_window
from oeeflow.plans.ml import numeric_medians
from oeeflow.session import ensure_checkpoint_dir


def test_chunked_window_writes_nothing_and_prunes(spark):
    rows = [(f"m{i % 3}" if i % 11 else None, None if i % 13 == 0 else i // 4, i, float(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, t long, k long, v double")
    cols = {"s": lambda w: F.sum("v").over(w.rowsBetween(-6, -1)), "l": lambda w: F.lag("v", 7).over(w)}
    def written():
        return {x for x in os.listdir(ensure_checkpoint_dir(spark)) if x.startswith("window-")}
    before = written()
    for rows_per_chunk in (5, 60, 10_000):
        b = chunked_window(df, ["g"], ["t", "k"], cols, 7, rows_per_chunk=rows_per_chunk)
        a = chunked_window(df, ["g"], ["t", "k"], cols, 7, rows_per_chunk=None)
        assert a.exceptAll(b).count() == 0 and b.count() == 700
    assert written() == before
    assert "sum(" not in b.select("l")._jdf.queryExecution().optimizedPlan().toString()


def test_medians_broadcast_their_brackets(spark, monkeypatch):
    from oeeflow.plans import ml
    seen, real = [], ml.quantiles
    monkeypatch.setattr(ml, "quantiles", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    df = spark.range(101).select(F.col("id").alias("a"), F.when(F.col("id") < 100, F.col("id") * 2.0).alias("b"))
    assert numeric_medians(df, ["a", "b"]) == {"a": 50.0, "b": 99.0}
    joins = [x for x in seen[0]._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert joins and all("broadcast" in x for x in joins)
