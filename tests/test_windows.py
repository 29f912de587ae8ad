import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from oeeflow.operators.features import add_rolling_and_lags, smooth_times
from oeeflow.operators.windows import chunked_window, cumulative_sums, global_position

KEY = ["wo", "phase", "l_partkey", "l_suppkey"]


def test_chunked_equals_plain(spark, wo):
    a = add_rolling_and_lags(wo, "inefficiency", rows_per_chunk=None)
    b = add_rolling_and_lags(wo, "inefficiency", rows_per_chunk=37)   # many chunks per machine
    cols = [*KEY, "end_ts", "rolling_mean_10", "rolling_std_10", "lag_1", "lag_2", "lag_3"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.count() == wo.count()


def test_chunked_sparse_chunks(spark):
    # a group whose chunks hold fewer rows than the look-back: the halo spans several chunks
    rows = [("m", i * (1000 if i % 5 == 0 else 1), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, t long, v double")
    cols = {"s": lambda w: F.sum("v").over(w.rowsBetween(-7, 0)), "l": lambda w: F.lag("v", 7).over(w)}
    a = chunked_window(df, ["g"], ["t"], cols, 7, rows_per_chunk=None)
    b = chunked_window(df, ["g"], ["t"], cols, 7, rows_per_chunk=3)
    assert a.exceptAll(b).count() == 0 and b.count() == 60


def test_smoothing_short_group_is_cumulative(spark):
    df = spark.createDataFrame([("m", i, float(i)) for i in range(4)], "machine string, t long, x double")
    out = smooth_times(df, cols=("x",), order_by=["t"]).orderBy("t").collect()
    assert [r.x_smooth for r in out] == [0.0, 0.5, 1.0, 1.5]


def test_global_position_is_a_permutation(spark, wo):
    p = global_position(wo, ["end_ts", *KEY], rows_per_chunk=500)
    n = wo.count()
    agg = p.agg(F.min("_pos"), F.max("_pos"), F.count_distinct("_pos")).first()
    assert tuple(agg) == (0, n - 1, n)
    w = Window.orderBy("end_ts", *KEY)
    ref = wo.withColumn("_pos", F.row_number().over(w) - 1)
    assert ref.select(*KEY, "_pos").exceptAll(p.select(*KEY, "_pos")).count() == 0


def test_cumulative_sums(spark):
    random.seed(1)
    rows = [(float(i), random.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "s double, k long")
    out = cumulative_sums(df, "s", ["k"], rows_per_chunk=17).orderBy("s").collect()
    acc, ok = 0, True
    for (s, k), r in zip(rows, out):
        acc += k
        ok &= r.cum_k == acc
    assert ok


def test_positions_with_infinite_keys(spark):
    rows = [(float(i),) for i in range(50)] + [(float("inf"),), (float("-inf"),)]
    df = spark.createDataFrame(rows, "k double")
    p = global_position(df, ["k"], rows_per_chunk=7).orderBy("_pos").collect()
    assert [r._pos for r in p] == list(range(52))
    assert p[0].k == float("-inf") and p[-1].k == float("inf")


def test_no_row_shuffle_on_machine_alone(spark, wo):
    import re
    out = add_rolling_and_lags(wo, "inefficiency", rows_per_chunk=100)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    # rows are shuffled on (machine, ..., _chunk); only the chunk counts go by machine alone
    assert [k for k in keys if "_chunk" in k]
    assert "CartesianProduct" not in plan


def test_positions_need_no_cartesian_product(spark, wo):
    p = global_position(wo, ["end_ts", *KEY], rows_per_chunk=500)
    assert "CartesianProduct" not in p._jdf.queryExecution().executedPlan().toString()
    p.write.format("noop").mode("overwrite").save()
    assert "CartesianProduct" not in p._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_balanced_in_a_burst(spark):
    from oeeflow.operators.windows import assign_chunks
    rows = [("m", i if i < 10 else 5, i) for i in range(1000)]  # 991 rows at one time
    c = assign_chunks(spark.createDataFrame(rows, "g string, t long, k long"), ["g"], ["t", "k"], 50)
    assert max(r["count"] for r in c.groupBy("_chunk").count().collect()) <= 100


def test_positions_of_text_and_time_keys_both_ways(spark):
    import datetime
    rows = [(i, None if i % 7 == 0 else f"a{i % 13}", datetime.datetime(2024, 1, 1 + i % 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, a string, t timestamp")
    for col in ("a", "t"):
        for asc in (True, False):
            p = global_position(df, [(col, asc, True), "i"], rows_per_chunk=20)
            first = F.asc_nulls_last(col) if asc else F.desc_nulls_last(col)
            ref = df.withColumn("_pos", F.row_number().over(Window.orderBy(first, "i")) - 1)
            assert ref.select("i", "_pos").exceptAll(p.select("i", "_pos")).count() == 0


def test_positions_of_every_type_in_both_directions(spark):
    """Many chunks, NULLs, NaN and both zeros: the positions of one sort of the whole table."""
    df = spark.range(400).selectExpr(
        "id", "if(id % 7 = 0, null, id % 13) AS n", "cast(id % 5 AS int) AS i", "id % 2 = 0 AS b", "cast(id % 11 AS decimal(9, 2)) AS d",
        "CASE WHEN id % 9 = 0 THEN null WHEN id % 9 = 1 THEN double('NaN') WHEN id % 9 = 2 THEN -0D WHEN id % 9 = 3 THEN 0D ELSE 50 - id / 3 END AS x",
        "if(id % 17 = 0, null, date_add(DATE'2024-01-01', cast(id % 31 AS int))) AS day", "if(id % 6 = 0, null, concat('s', id % 19)) AS s",
        "if(id % 8 = 0, null, TIMESTAMP_NTZ'2024-03-31 00:00:00' + make_dt_interval(0, cast(id % 29 AS int), 7)) AS at",
        "timestamp_seconds(1700000000 + id % 23) AS ts")
    for c in ("n", "i", "b", "d", "x", "day", "s", "at", "ts"):
        for ascending in (True, False):
            for last in (True, False):
                got = global_position(df, [(c, ascending, last), "id"], rows_per_chunk=20).select("id", "_pos")
                sort = (F.asc_nulls_last if last else F.asc_nulls_first) if ascending else F.desc_nulls_last if last else F.desc_nulls_first
                want = df.select("id", (F.row_number().over(Window.orderBy(sort(c), "id")) - 1).alias("_pos"))
                assert dict(got.collect()) == dict(want.collect()), (c, ascending, last)


def test_plan_of_mixed_order_does_not_explode(spark):
    """The planned chunk search of 64 chunks is not much larger than that of 8, in a descending order, too."""
    df = spark.range(640).selectExpr("id / 3 AS x", "id % 7 AS k", "id")
    sizes = [len(global_position(df, [("x", False, True), "k", "id"], rows_per_chunk=n)._jdf.queryExecution().optimizedPlan().toString()) for n in (80, 10)]
    assert sizes[1] < 3 * sizes[0]
