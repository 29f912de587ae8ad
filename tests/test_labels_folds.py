from pyspark.sql import functions as F

from oeeflow.operators import encode, folds, labels
from oeeflow.operators.features import features_classification


def test_three_way_labels_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "inefficiency double")
    out = labels.label_for_report(df, attention_cut=2.0, anomaly_cut=3.0).collect()
    assert [(r.is_anomaly, r.label3) for r in out] == [(0, 0), (0, 1), (0, 2), (0, 0)]


def test_mean_std_labels_null_goes_to_two(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "inefficiency double")
    got = [r.label for r in labels.label_mean_std(df).collect()]
    assert got == [0, 0, 1, 2]   # mean 2, std 1; a NULL index falls into class 2


def test_temporal_split_counts(spark, wo):
    s = folds.temporal_split(wo)
    n = wo.count()
    assert s.filter("is_train").count() == int(n * 0.8)
    last_train = s.filter("is_train").agg(F.max("_pos")).first()[0]
    first_test = s.filter("NOT is_train").agg(F.min("_pos")).first()[0]
    assert last_train + 1 == first_test


def test_expanding_folds(spark, wo):
    f = folds.time_series_folds(wo, 5)
    n = wo.count()
    size = n // 6
    for k in range(5):
        tr, te = folds.fold_parts(f, k)
        assert te.count() == size
        assert tr.count() == n - (5 - k) * size
        assert tr.agg(F.max("_pos")).first()[0] < te.agg(F.min("_pos")).first()[0]


def test_stratified_folds_balanced(spark, wo):
    lab = labels.label_p85_binary(features_classification(wo))
    f = folds.make_folds(lab, "stratified", 5, label="label")
    c = {(r.label, r.fold): r.n for r in f.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    for lab_v in (0, 1):
        sizes = [c.get((lab_v, k), 0) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_top_articles_and_grouping(spark, wo):
    top = encode.top_articles(wo, 5)
    names = [r.article for r in top.collect()]
    assert len(names) == 5
    g = encode.group_rare_articles(wo, top)
    assert set(r[0] for r in g.select("article_group").distinct().collect()) == set(names) | {"ALTRO"}
    assert encode.filter_known_articles(g, names).filter(F.col("article_group") == "ALTRO").count() == 0


def test_apply_threshold_default(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (None,)], "prob_anomaly double")
    assert [r.pred for r in labels.apply_threshold(df, cut=None).collect()] == [0, 1, 0]
