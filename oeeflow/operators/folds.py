"""Train/test splits and cross-validation folds (E6, E7, J11, J12), all from distributed
row positions (:func:`global_position`), never from a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oeeflow.operators.windows import DEFAULT_ROWS_PER_CHUNK, _join_on, global_position
from oeeflow.schema import ORDER_COLS, ROW_KEY


def _count(df: DataFrame, by: list[str] | None = None, name: str = "_n") -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias(name))


def temporal_split(df: DataFrame, train_frac: float = 0.8, order_by: list[str] | None = None,
                   rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """The first ``int(train_frac · n)`` rows in time order are train (``is_train``)."""
    pos = global_position(df, list(order_by or ORDER_COLS), "_pos", rows_per_chunk=rows_per_chunk)
    n = _count(df)
    cut = F.floor(F.col("_n").cast("double") * F.lit(float(train_frac))).cast("bigint")
    return (pos.crossJoin(F.broadcast(n))  # one row
            .withColumn("is_train", F.col("_pos") < cut).drop("_n"))


def time_series_folds(df: DataFrame, n_splits: int = 5, order_by: list[str] | None = None,
                      rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Expanding folds. Test size ``n // (n_splits + 1)``; fold k tests
    ``[n - (n_splits - k)·size, + size)`` and trains on every earlier row.

    Adds ``_pos``, ``test_fold`` (NULL: never tested) and ``train_from_fold`` (the row is in
    the training part of every fold ≥ this one; NULL: never).
    """
    pos = global_position(df, list(order_by or ORDER_COLS), "_pos", rows_per_chunk=rows_per_chunk)
    n = _count(df)
    size = F.floor(F.col("_n") / F.lit(n_splits + 1)).cast("bigint")
    first = F.col("_n") - F.lit(n_splits) * size
    k = F.when(size > 0, F.floor((F.col("_pos") - first) / size).cast("bigint"))
    out = pos.crossJoin(F.broadcast(n))  # one row
    return out.withColumns({
        "test_fold": F.when((F.col("_pos") >= first) & (k < n_splits), k),
        "train_from_fold": F.when(F.col("_pos") < first, F.lit(0).cast("bigint"))
                            .when(k + 1 < n_splits, k + 1),
    }).drop("_n")


def fold_parts(folded: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of expanding fold ``k``."""
    return (folded.filter(F.col("train_from_fold") <= k), folded.filter(F.col("test_fold") == k))


def _hash_order(seed: int, key: list[str]):
    return F.xxhash64(*[F.col(c) for c in key], F.lit(seed))


def make_folds(df: DataFrame, kind: str = "stratified", k: int = 5, label: str | None = None,
               seed: int = 42, key: list[str] | None = None, order_by: list[str] | None = None,
               rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add ``fold`` in [0, k).

    ``stratified``: inside each label rows are ordered by a seeded hash and dealt round-robin,
    so every fold holds the same share of each class. ``kfold``: the same over all rows.
    ``expanding``: :func:`time_series_folds`.
    """
    if kind == "expanding":
        return time_series_folds(df, k, order_by, rows_per_chunk)
    key = list(key or [c for c in ROW_KEY if c in df.columns])
    d = df.withColumn("_h", _hash_order(seed, key))
    part = [label] if (kind == "stratified" and label) else []
    pos = global_position(d, ["_h", *key], "_p", partition_by=part, rows_per_chunk=rows_per_chunk)
    return pos.withColumn("fold", (F.col("_p") % k).cast("int")).drop("_h", "_p")


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42,
                     key: list[str] | None = None,
                     rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Random split keeping class shares: in each class the first
    ``ceil(test_frac · n_class)`` rows of a seeded hash order are test (``is_test``)."""
    key = list(key or [c for c in ROW_KEY if c in df.columns])
    d = df.withColumn("_h", _hash_order(seed, key))
    pos = global_position(d, ["_h", *key], "_p", partition_by=[label], rows_per_chunk=rows_per_chunk)
    n = _count(df, [label], "_nc")
    j = _join_on(pos, n, [label])
    cut = F.ceil(F.col("_nc").cast("double") * F.lit(float(test_frac)))
    return j.withColumn("is_test", F.col("_p") < cut).drop("_h", "_p", "_nc")
