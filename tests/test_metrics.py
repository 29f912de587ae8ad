import itertools
import random

from pyspark.sql import functions as F

from oeeflow.operators import metrics


def test_auc_matches_pair_count(spark):
    random.seed(3)
    rows = [(random.randint(0, 1), round(random.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert abs(metrics.roc_auc(df, "y", "s").first().auc - brute) < 1e-12


def test_confusion_has_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (2, 2)], "y int, p int")
    cm = {(r.true, r.pred): r.n for r in metrics.confusion_matrix(df, "y", "p", [0, 1, 2]).collect()}
    assert len(cm) == 9 and cm[(0, 0)] == 2 and cm[(1, 1)] == 0


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "y int, p int")
    r = {x["class"]: x for x in metrics.classification_report(df, "y", "p").collect()}
    assert abs(r["0"].precision - 0.5) < 1e-12 and r["1"].recall == 0.5 and abs(r["accuracy"].f1 - 2 / 3) < 1e-12


def test_threshold_fallback_without_precision(spark):
    # every flagged set has precision < 0.25 → the floor is dropped
    rows = [(0, 0.9)] * 10 + [(1, 0.1)]
    t = metrics.tune_threshold(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()
    assert t.precision_floor_met is False and t.recall == 1.0 and abs(t.cut - 0.05) < 1e-12


def test_threshold_exact_cut_boundary(spark):
    # p = 0.3 is below the cut 0.05 + 25·0.01 = 0.30000000000000004
    rows = [(1, 0.3), (0, 0.1)]
    tab = {r.i: r.flagged for r in metrics.threshold_table(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect()}
    assert tab[24] == 1 and tab[25] == 0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert abs(r.mae - 1 / 3) < 1e-12 and abs(r.r2 - 0.5) < 1e-12


def test_per_class_accuracy_total(spark):
    df = spark.createDataFrame([("A", "A"), ("B", "A"), ("B", "B")], "r string, p string")
    r = {x["class"]: x for x in metrics.per_class_accuracy(df, "r", "p", ["A", "B"]).collect()}
    assert r["TOTALE"].n_real == 3 and r["TOTALE"].n_correct == 2 and r["B"].accuracy_pct == 50.0
