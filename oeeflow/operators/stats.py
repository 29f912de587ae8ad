"""Descriptive statistics and EDA tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.operators.quantiles import quantiles
from oeeflow.operators.windows import _join_on

MOMENTS = ("n", "mean_a", "mean_b", "squares_a", "squares_b", "products")


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULL count — from a single aggregate."""
    names = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(names)])
    types = dict(df.dtypes)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                          F.col(f"_n{i}").alias("n_nulls")) for i, c in enumerate(names)]))
    return agg.select(F.col("_rows").alias("n_rows"), stack.alias("_s")).select("_s.*", "n_rows")


def describe_column(df: DataFrame, col: str = "inefficiency") -> DataFrame:
    """D3: mean, sample std, mean − std, mean + std."""
    g = df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.count(col).alias("n"))
    return g.withColumns({"mean_minus_std": F.col("mean") - F.col("std"), "mean_plus_std": F.col("mean") + F.col("std")})


def machine_stats(df: DataFrame, col: str = "inefficiency", by: str = "machine",
                  cuts: tuple[float, float] = (1.5, 1.8)) -> DataFrame:
    """Count, mean, std and the shares above 1.5 and 1.8 per machine."""
    x = F.col(col)
    return df.groupBy(by).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        *[F.avg(F.when(x.isNotNull(), (x > c).cast("double"))).alias(f"share_over_{str(c).replace('.', '_')}")
          for c in cuts])


def machine_median_rank(df: DataFrame, col: str = "inefficiency", by: str = "machine") -> DataFrame:
    """Median per machine and its rank, highest first."""
    m = quantiles(df, col, [0.5], by=[by], names=["median"])
    return m.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("median"), F.asc(by))))  # one row per machine


def observations_per_machine(df: DataFrame, by: str = "machine", min_obs: int = 100) -> DataFrame:
    """Rows per machine, flagged when below ``min_obs``."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_obs"))
    return g.withColumn("below_min", (F.col("n_obs") < min_obs).cast("int"))


def histogram(df: DataFrame, col: str = "inefficiency", bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (the max falls in the last bin)."""
    x = df.select(F.col(col).alias("_x")).filter(F.col("_x").isNotNull())
    mm = x.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    j = x.crossJoin(F.broadcast(mm))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))).cast("int") + 1,
                F.lit(bins)))
    g = j.withColumn("bin", b.cast("int")).groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return g.select("bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("lower"),
                    (F.col("_lo") + F.col("bin") * width).alias("upper"), "n")


def histogram_density(df: DataFrame, col: str = "inefficiency", bins: int = 50, grid: int = 200) -> DataFrame:
    """D8 (curve): Gaussian kernel density with Scott's bandwidth (std · n^-1/5),
    evaluated on ``grid`` points from the bin counts (grid × bins work, not grid × rows)."""
    h = histogram(df, col, bins)
    st = df.agg(F.stddev_samp(col).alias("_sd"), F.count(col).alias("_n"), F.min(col).alias("_lo"),
                F.max(col).alias("_hi"))
    pts = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_g"))
    pts = pts.withColumn("x", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_g") / (grid - 1))
    bw = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    j = pts.crossJoin(F.broadcast(h.select(((F.col("lower") + F.col("upper")) / 2).alias("_c"), F.col("n").alias("_k"))))
    z = (F.col("x") - F.col("_c")) / bw
    dens = F.col("_k") * F.exp(-0.5 * z * z) / (bw * F.sqrt(F.lit(2 * 3.141592653589793)))
    return j.groupBy("_g", "x", "_n").agg(F.sum(dens).alias("_s")).select(
        F.col("_g").alias("point"), "x", (F.col("_s") / F.col("_n")).alias("density"))


def boxplot_stats(df: DataFrame, col: str = "inefficiency", by: str = "machine", k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside 1.5·IQR) and outlier count per machine."""
    q = quantiles(df, col, [0.25, 0.5, 0.75], by=[by], names=["q1", "median", "q3"])
    j = _join_on(df.select(by, col), q, [by])
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    x = F.col(col)
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(x >= lo, x)).alias("whisker_low"), F.max(F.when(x <= hi, x)).alias("whisker_high"),
        F.count_if((x < lo) | (x > hi)).alias("n_outliers"))


def skewness(df: DataFrame, col: str = "inefficiency", by: list[str] | None = None) -> DataFrame:
    """Bias-adjusted sample skewness (Spark's ``skewness`` is the population form)."""
    g = df.groupBy(*(by or [])).agg(F.skewness(col).alias("_g1"), F.count(col).alias("_n"))
    n = F.col("_n").cast("double")
    adj = F.when(F.col("_n") > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return g.select(*(by or []), adj.alias("skewness"), F.col("_n").alias("n"))


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.7) -> DataFrame:
    """Pairs (upper triangle) with |Pearson r| > ``threshold``, each pair on its
    pairwise complete rows. A column without variance correlates with nothing.

    Each task sums the centred moments of all pairs over blocks of rows and leaves one row a pair; these
    are merged pair by pair. One ``corr`` a pair would be hundreds of buffers in one aggregate, too many for
    generated code."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")

    def centred(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``x`` less their means, and the means; equal values give zeros exactly."""
        first = x[:, 0]
        x = x - first[:, None]
        mean = x.mean(axis=1)
        return x - mean[:, None], first + mean

    def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(rows, means, squares, products) of two parts together, a column each pair."""
        n, (dx, dy) = a[0] + b[0], b[1:3] - a[1:3]
        share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
        apart = a[0] * share
        return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * apart, a[4] + b[4] + dy * dy * apart, a[5] + b[5] + dx * dy * apart])

    def moments(x: np.ndarray, there: np.ndarray) -> np.ndarray:
        out, n = np.zeros((6, len(pairs))), x.shape[1]
        whole = there.all(axis=1)
        full = np.flatnonzero(whole)
        at = np.cumsum(whole) - 1
        z, mean = centred(x[full])
        products = z @ z.T
        for k, (i, j) in enumerate(pairs):
            if whole[i] and whole[j]:
                a, b = at[i], at[j]
                out[:, k] = n, mean[a], mean[b], products[a, a], products[b, b], products[a, b]
            elif (both := there[i] & there[j]).any():
                own, means = centred(x[[i, j]][:, both])
                out[:, k] = own.shape[1], *means, own[0] @ own[0], own[1] @ own[1], own[0] @ own[1]
        return out

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros((6, len(pairs)))
        with np.errstate(all="ignore"):
            for b in batches:
                if b.num_rows:
                    there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns])
                    x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns])
                    state = merged(state, moments(x, there))
        some = np.flatnonzero(state[0] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, *state[:, some])], ["pair", *MOMENTS])

    def whole(table: pa.Table) -> pa.Table:
        k, parts = table.column("pair")[0].as_py(), np.stack([table.column(c).to_numpy() for c in MOMENTS])[:, :, None]
        state = np.zeros((6, 1))
        with np.errstate(all="ignore"):
            for part in range(parts.shape[1]):
                state = merged(state, parts[:, part])
            r = float((state[5] / np.sqrt(state[3] * state[4]))[0])
        return pa.table({"col_a": [cols[pairs[k][0]]], "col_b": [cols[pairs[k][1]]], "corr": pa.array([r], pa.float64())})
    d = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = d.mapInArrow(summed, ", ".join(["pair long", *(f"{m} double" for m in MOMENTS)]))
    out = parts.groupBy("pair").applyInArrow(whole, "col_a string, col_b string, corr double")
    return out.filter(~F.isnan("corr") & (F.abs(F.col("corr")) > threshold))


def class_distribution(df: DataFrame, label: str = "label", warn_below_pct: float = 10.0) -> DataFrame:
    """Count and share per label; ``minority_warning`` when the smallest share < 10 %."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # one row per label
    g = g.withColumn("pct", F.col("n") / F.sum("n").over(w) * 100)
    return g.withColumn("minority_warning", (F.min("pct").over(w) < warn_below_pct).cast("int"))
