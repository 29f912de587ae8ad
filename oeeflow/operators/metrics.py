"""Evaluation metrics and threshold search.

Every metric is one aggregate over (truth, prediction) rows; curve-like metrics (AUC,
threshold sweeps) aggregate per distinct score or score bucket first, then work on that
small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.operators.windows import cumulative_sums


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """R², MAE, MSE, RMSE over rows where both are present."""
    d = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.col(y) - F.col(yhat)
    g = d.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
              F.sum(e * e).alias("_ssr"), (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"))
    return g.select("n", F.when(F.col("_sst") > 0, 1 - F.col("_ssr") / F.col("_sst")).alias("r2"),
                    "mae", "mse", F.sqrt("mse").alias("rmse"))


def mape_expr(y: str, yhat: str) -> Column:
    """Mean absolute percentage error (%), rows with y = 0 excluded."""
    return F.avg(F.when(F.col(y) != 0, F.abs((F.col(y) - F.col(yhat)) / F.col(y)))) * 100


def mape(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(mape_expr(y, yhat).alias("mape"))


def within_tolerance(df: DataFrame, y: str, yhat: str, tolerances: tuple[float, ...] = (0.05, 0.10)) -> DataFrame:
    """Share of rows with |error| ≤ each tolerance."""
    d = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.abs(F.col(y) - F.col(yhat))
    return d.agg(*[F.avg((e <= t).cast("double")).alias(f"within_{int(round(t * 100))}") for t in tolerances])


def confusion_matrix(df: DataFrame, label: str, pred: str, labels: list[int] | None = None) -> DataFrame:
    """Counts for every (true, predicted) pair of ``labels`` (zeros included)."""
    counts = df.groupBy(F.col(label).alias("true"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        vals = df.select(F.col(label).alias("v")).union(df.select(F.col(pred).alias("v"))).distinct()
    else:
        vals = df.sparkSession.createDataFrame([(v,) for v in labels], "v int")
    grid = vals.select(F.col("v").alias("true")).crossJoin(vals.select(F.col("v").alias("pred")))  # k² rows
    return grid.join(counts, ["true", "pred"], "left").select("true", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def _per_class(cm: DataFrame) -> DataFrame:
    tp = cm.filter(F.col("true") == F.col("pred")).select(F.col("true").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("true").alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col("pred").alias("cls")).agg(F.sum("n").alias("predicted"))
    j = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    j = j.withColumns({"precision": p, "recall": r})
    return j.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(0.0))


def classification_report(df: DataFrame, label: str, pred: str, labels: list[int] | None = None) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and weighted
    averages (0 on zero division); classes = labels seen in truth or prediction."""
    cm = df.groupBy(F.col(label).alias("true"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    if labels is not None:
        cm = cm.filter(F.col("true").isin(labels) | F.col("pred").isin(labels))
    pc = _per_class(cm)
    if labels is not None:
        pc = pc.filter(F.col("cls").isin(labels))
    tot = pc.agg(F.sum("support").alias("_n"), F.sum("tp").alias("_tp"), F.avg("precision").alias("mp"),
                 F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1") * F.col("support")).alias("wf"))
    rows = pc.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1", F.col("support").cast("bigint"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     F.when(F.col("_n") > 0, F.col("_tp") / F.col("_n")).alias("f1"), F.col("_n").cast("bigint").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("_n").cast("bigint").alias("support"))
    w = F.col("_n")
    weighted = tot.select(F.lit("weighted avg").alias("class"), (F.col("wp") / w).alias("precision"),
                          (F.col("wr") / w).alias("recall"), (F.col("wf") / w).alias("f1"), w.cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """Binary ROC AUC by rank sums with averaged ties:
    Σ pos(s)·(neg below s + neg(s)/2) / (P·N), over the distinct scores."""
    d = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = d.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count_if(F.col(label) != positive).alias("neg"))
    c = cumulative_sums(g, "_s", ["neg"])
    part = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") / 2.0)
    t = c.agg(F.sum(part).alias("_num"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return t.select(F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_num") / (F.col("_p") * F.col("_n"))).alias("auc"),
                    F.col("_p").alias("n_pos"), F.col("_n").alias("n_neg"))


def roc_auc_ovr_weighted(df: DataFrame, label: str, scores: dict[int, str]) -> DataFrame:
    """J19 (multi-class): one-vs-rest AUC per class, averaged with class supports as weights."""
    parts = []
    for cls, col in scores.items():
        a = roc_auc(df.withColumn("_y", (F.col(label) == cls).cast("int")), "_y", col)
        parts.append(a.select(F.lit(cls).alias("cls"), "auc", F.col("n_pos").alias("support")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg((F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc_weighted"))


def recall_of_class(df: DataFrame, label: str, pred: str, cls: int) -> DataFrame:
    """Recall of one class (0 when the class is absent)."""
    t = F.col(label) == cls
    return df.agg(F.coalesce(F.count_if(t & (F.col(pred) == cls)) / F.nullif(F.count_if(t), F.lit(0)), F.lit(0.0))
                  .alias("recall"))


def accuracy_expr(label: str, pred: str) -> Column:
    return F.avg((F.col(label) == F.col(pred)).cast("double"))


def overfit_check(train: DataFrame, test: DataFrame, label: str, pred: str, max_gap: float = 0.05) -> DataFrame:
    """Train and test accuracy, their gap, and OVERFITTING when the gap exceeds ``max_gap``."""
    a = train.agg(accuracy_expr(label, pred).alias("train_accuracy"))
    b = test.agg(accuracy_expr(label, pred).alias("test_accuracy"))
    j = a.crossJoin(b)
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    return j.withColumns({"gap": gap, "verdict": F.when(gap > max_gap, "OVERFITTING").otherwise("OK")})


def error_by_split(train: DataFrame, test: DataFrame, label: str, pred: str, max_gap: float | None = None) -> DataFrame:
    """J21 (regression): train and test RMSE, their gap (test - train) and, with ``max_gap``, the verdict."""
    rmse = F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2)))
    j = train.agg(rmse.alias("train_rmse")).crossJoin(test.agg(rmse.alias("test_rmse")))  # one row each
    gap = F.col("test_rmse") - F.col("train_rmse")
    out = j.withColumn("gap", gap)
    return out if max_gap is None else out.withColumn("verdict", F.when(gap > max_gap, "OVERFITTING").otherwise("OK"))


def compare_models(metrics: DataFrame, order: list[Column]) -> DataFrame:
    """Model table ranked by the task's metric (e.g. ``[asc('rmse'), desc('r2')]``);
    ``rank`` 1 is the pick. The table holds one row per model."""
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


# ---------------------------------------------------------------- threshold search

def arange_step(start: float, step: float) -> float:
    """The increment numpy's ``arange`` really uses: (start + step) − start."""
    return (start + step) - start


def _cut(i: Column, start: float, step: float) -> Column:
    """Cut ``i`` of the grid exactly as ``numpy.arange(start, stop, step)[i]``."""
    return F.lit(start) + i.cast("double") * F.lit(arange_step(start, step))


def _bucket(score: Column, start: float, step: float, n: int) -> Column:
    """Largest cut index i in [0, n) with score ≥ start + i·step (exact), −1 when none."""
    b0 = F.least(F.greatest(F.floor((score - F.lit(start)) / F.lit(arange_step(start, step))).cast("int"),
                            F.lit(-1)), F.lit(n - 1))
    up = F.least(b0 + 1, F.lit(n - 1))
    return (F.when(score.isNull(), F.lit(-1))
            .when(score >= _cut(up, start, step), up)
            .when((b0 >= 0) & (score >= _cut(b0, start, step)), b0)
            .otherwise(F.greatest(b0 - 1, F.lit(-1))))


def threshold_table(df: DataFrame, label: str, prob: str, start: float = 0.05, step: float = 0.01,
                    n: int = 86) -> DataFrame:
    """Confusion counts of every cut ``start + i·step`` (i < n) for ``prob ≥ cut`` in one pass:
    rows are counted per highest cut they pass, then summed from the top."""
    b = df.select(_bucket(F.col(prob), start, step, n).alias("_b"), (F.col(label) == 1).cast("int").alias("_y"))
    g = b.groupBy("_b").agg(F.sum("_y").alias("_tp"), F.count(F.lit(1)).alias("_k"))
    cuts = df.sparkSession.range(n).select(F.col("id").cast("int").alias("i"))
    j = cuts.crossJoin(F.broadcast(g.filter(F.col("_b") >= 0)))  # ≤ n × n rows
    per = j.filter(F.col("_b") >= F.col("i")).groupBy("i").agg(F.sum("_tp").alias("tp"), F.sum("_k").alias("flagged"))
    pos = g.agg(F.sum("_tp").alias("positives"))
    out = cuts.join(per, "i", "left").fillna(0, ["tp", "flagged"]).crossJoin(pos)
    tp, fl, P = F.col("tp"), F.col("flagged"), F.col("positives")
    return out.select(
        "i", _cut(F.col("i"), start, step).alias("cut"), "tp", "flagged", "positives",
        F.when(P > 0, tp / P).otherwise(0.0).alias("recall"),
        F.when(fl > 0, tp / fl).otherwise(0.0).alias("precision"),
        F.when(fl + P > 0, 2 * tp / (fl + P)).otherwise(0.0).alias("f1"),
        (P - tp).alias("fn"))


def tune_threshold(df: DataFrame, label: str, prob: str, min_precision: float = 0.25) -> DataFrame:
    """Cut in 0.05…0.90 flagging something, precision ≥ ``min_precision``, with the
    highest recall, then F1, lowest cut first; without any such cut the precision floor is
    dropped. One row."""
    t = threshold_table(df, label, prob).filter(F.col("flagged") > 0)
    cand = (t.filter(F.col("precision") >= min_precision).withColumn("_pri", F.lit(0))
            .unionByName(t.withColumn("_pri", F.lit(1))))
    w = Window.orderBy("_pri", F.desc("recall"), F.desc("f1"), "i")  # ≤ 2·86 rows
    best = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    return best.select("cut", "recall", "precision", "f1", "fn", (F.col("_pri") == 0).alias("precision_floor_met"))


def tune_two_thresholds(df: DataFrame, label3: str, p_anomaly: str, p_attention: str) -> DataFrame:
    """Anomaly cut 0.15…0.60 and attention cut 0.20…0.70 (step 0.05, attention ≥ anomaly):
    maximise (recall of class 2, −(class 2 predicted as 1), macro F1); first pair wins ties."""
    na, nt = 10, 11
    b = df.select(F.col(label3).alias("y"), _bucket(F.col(p_anomaly), 0.15, 0.05, na).alias("ba"),
                  _bucket(F.col(p_attention), 0.20, 0.05, nt).alias("bt"))
    g = b.groupBy("y", "ba", "bt").agg(F.count(F.lit(1)).alias("k"))  # ≤ 3 · 11 · 12 rows
    sp = df.sparkSession
    pairs = (sp.range(na).select(F.col("id").cast("int").alias("ia"))
             .crossJoin(sp.range(nt).select(F.col("id").cast("int").alias("it")))
             .withColumns({"cut_anomaly": _cut(F.col("ia"), 0.15, 0.05), "cut_attention": _cut(F.col("it"), 0.20, 0.05)})
             .filter(F.col("cut_attention") >= F.col("cut_anomaly")))
    j = pairs.crossJoin(F.broadcast(g))
    pred = F.when(F.col("ba") >= F.col("ia"), 2).when(F.col("bt") >= F.col("it"), 1).otherwise(0)
    cm = j.withColumn("pred", pred).groupBy("ia", "it", "cut_anomaly", "cut_attention", "y", "pred").agg(F.sum("k").alias("n"))
    keys = ["ia", "it", "cut_anomaly", "cut_attention"]
    per = []
    for c in (0, 1, 2):
        per += [F.sum(F.when((F.col("y") == c) & (F.col("pred") == c), F.col("n")).otherwise(0)).alias(f"tp{c}"),
                F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias(f"sup{c}"),
                F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"prd{c}")]
    s = cm.groupBy(*keys).agg(*per, F.sum(F.when((F.col("y") == 2) & (F.col("pred") == 1), F.col("n")).otherwise(0)).alias("err_2_to_1"))
    f1s, present = [], []
    for c in (0, 1, 2):
        p = F.when(F.col(f"prd{c}") > 0, F.col(f"tp{c}") / F.col(f"prd{c}")).otherwise(0.0)
        r = F.when(F.col(f"sup{c}") > 0, F.col(f"tp{c}") / F.col(f"sup{c}")).otherwise(0.0)
        f1s.append(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
        present.append(((F.col(f"sup{c}") + F.col(f"prd{c}")) > 0).cast("int"))
    k = present[0] + present[1] + present[2]
    s = s.withColumns({
        "recall_anomaly": F.when(F.col("sup2") > 0, F.col("tp2") / F.col("sup2")).otherwise(0.0),
        "f1_macro": (f1s[0] * present[0] + f1s[1] * present[1] + f1s[2] * present[2]) / k})
    w = Window.orderBy(F.desc("recall_anomaly"), F.asc("err_2_to_1"), F.desc("f1_macro"), "ia", "it")  # ≤ 110 rows
    return (s.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("cut_anomaly", "cut_attention", "recall_anomaly", "f1_macro", "err_2_to_1"))


# ---------------------------------------------------------------- time comparison and score summaries

def compare_times(df: DataFrame, actual: str, erp: str, model: str, theoretical: str | None = None) -> DataFrame:
    """Absolute errors of the ERP time, the model and the theoretical time, and whether
    the model is closer than each."""
    a = F.col(actual)
    out = df.withColumns({"err_erp": F.abs(a - F.col(erp)), "err_model": F.abs(a - F.col(model)),
                          "err_theoretical": F.abs(a - F.col(theoretical)) if theoretical else F.lit(None).cast("double")})
    return out.withColumns({
        "model_better_than_erp": F.coalesce(F.col("err_model") < F.col("err_erp"), F.lit(False)),
        "model_better_than_theoretical": F.col("err_theoretical").isNotNull()
        & F.coalesce(F.col("err_model") < F.col("err_theoretical"), F.lit(False))})


def compare_times_summary(cmp: DataFrame, actual: str, erp: str, model: str, theoretical: str | None = None) -> DataFrame:
    """How often the model wins, RMSE and MAPE of the three estimators."""
    a = F.col(actual)
    theo_ok = F.col("err_theoretical").isNotNull()
    return cmp.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("model_better_than_erp").alias("n_better_erp"),
        (F.count_if("model_better_than_erp") / F.count(F.lit(1)) * 100).alias("pct_better_erp"),
        F.count_if("model_better_than_theoretical").alias("n_better_theoretical"),
        F.count_if(theo_ok).alias("n_theoretical_valid"),
        (F.count_if("model_better_than_theoretical") / F.nullif(F.count_if(theo_ok), F.lit(0)) * 100).alias("pct_better_theoretical"),
        F.sqrt(F.avg(F.col("err_erp") ** 2)).alias("rmse_erp"), F.sqrt(F.avg(F.col("err_model") ** 2)).alias("rmse_model"),
        F.sqrt(F.avg(F.col("err_theoretical") ** 2)).alias("rmse_theoretical"),
        mape_expr(actual, erp).alias("mape_erp"), mape_expr(actual, model).alias("mape_model"),
        (F.avg(F.when(theo_ok & (a != 0), F.abs((a - F.col(theoretical)) / a))) * 100 if theoretical
         else F.lit(None).cast("double")).alias("mape_theoretical"))


def prediction_summary(df: DataFrame, pred: str, real: str) -> DataFrame:
    """mean/min/max of the predictions and of the real values on the predicted rows."""
    d = df.filter(F.col(pred).isNotNull())
    return d.agg(F.avg(pred).alias("pred_mean"), F.min(pred).alias("pred_min"), F.max(pred).alias("pred_max"),
                 F.avg(real).alias("real_mean"), F.min(real).alias("real_min"), F.max(real).alias("real_max"))


def per_class_accuracy(df: DataFrame, real: str, pred: str, label_order: list[str]) -> DataFrame:
    """Per class real, predicted, correct counts and accuracy %, plus a TOTAL row."""
    d = df.filter(F.col(pred).isin(label_order))
    aggs = []
    for lab in label_order:
        r, p = F.col(real) == lab, F.col(pred) == lab
        aggs += [F.count_if(r).alias(f"r_{lab}"), F.count_if(p).alias(f"p_{lab}"), F.count_if(r & p).alias(f"c_{lab}")]
    g = d.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(lab).alias("class"), F.col(f"r_{lab}").alias("n_real"),
                                         F.col(f"p_{lab}").alias("n_pred"), F.col(f"c_{lab}").alias("n_correct"))
                               for lab in label_order]))
    per = g.select(rows.alias("_s")).select("_s.*")
    total = per.agg(F.lit("TOTALE").alias("class"), F.sum("n_real").alias("n_real"), F.sum("n_pred").alias("n_pred"),
                    F.sum("n_correct").alias("n_correct"))
    out = per.unionByName(total)
    return out.withColumn("accuracy_pct", F.when(F.col("n_real") > 0, F.col("n_correct") / F.col("n_real") * 100).otherwise(0.0))


def prediction_distribution(df: DataFrame, pred: str, label_order: list[str]) -> DataFrame:
    """Count and % of each predicted label among the valid predictions."""
    d = df.filter(F.col(pred).isNotNull())
    g = d.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(pred) == lab).alias(f"n_{i}") for i, lab in enumerate(label_order)])
    rows = F.explode(F.array(*[F.struct(F.lit(lab).alias("label"), F.col(f"n_{i}").alias("n")) for i, lab in enumerate(label_order)]))
    return g.select("_n", rows.alias("_s")).select("_s.*", (F.col("_s.n") / F.col("_n") * 100).alias("pct"))


def oee_prediction_buckets(df: DataFrame, pred: str = "oee_pred", acceptable: float = 0.65, optimal: float = 0.85) -> DataFrame:
    """mean/min/max of the OEE predictions and counts < 0.65, [0.65, 0.85), ≥ 0.85."""
    d = df.filter(F.col(pred).isNotNull())
    x = F.col(pred)
    return d.agg(F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(F.lit(1)).alias("n"),
                 F.count_if(x < acceptable).alias("n_critical"),
                 F.count_if((x >= acceptable) & (x < optimal)).alias("n_acceptable"),
                 F.count_if(x >= optimal).alias("n_optimal"))


def time_error_summary(df: DataFrame, actual: str, estimate: str, model: str) -> DataFrame:
    """MAPE of the estimate and of the model (actual ≠ 0), relative MAPE reduction,
    and how often the model is closer."""
    d = df.filter(F.col(model).isNotNull())
    a = F.col(actual)
    e_est, e_ml = F.abs(a - F.col(estimate)), F.abs(a - F.col(model))
    g = d.agg(F.count(F.lit(1)).alias("n"), F.count_if(e_ml < e_est).alias("n_model_better"),
              (F.avg(F.when(a != 0, e_est / a)) * 100).alias("mape_estimate"),
              (F.avg(F.when(a != 0, e_ml / a)) * 100).alias("mape_model"))
    return g.withColumns({
        "pct_model_better": F.when(F.col("n") > 0, F.col("n_model_better") / F.col("n") * 100).otherwise(0.0),
        "mape_reduction_pct": F.when(F.col("mape_estimate") != 0,
                                     (F.col("mape_estimate") - F.col("mape_model")) / F.col("mape_estimate") * 100).otherwise(0.0)})
