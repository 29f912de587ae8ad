"""Cleaning of the ERP export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oeeflow.operators.quantiles import quantiles
from oeeflow.operators.windows import _join_on
from oeeflow.schema import DECIMAL_COMMA_COLS, INTEGER_COLS, MISSING, MISSING_ARTICLE


def parse_end_ts(df: DataFrame, date_col: str = "end_date_raw", time_col: str = "end_time_raw",
                 out: str = "end_ts", lenient: bool = False) -> DataFrame:
    """B1: ``dd/MM/yyyy`` + ``HH:mm:ss`` text → TIMESTAMP_NTZ; the two parts are dropped.

    Strict (default) raises on a malformed value, as the reference's explicit format does;
    ``lenient=True`` turns malformed values into NULL.
    """
    s = F.concat_ws(" ", F.col(date_col), F.col(time_col))
    if lenient:
        ok = s.rlike(r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$")
        ts = F.when(ok, F.try_make_timestamp_ntz(
            F.substring(s, 7, 4).cast("int"), F.substring(s, 4, 2).cast("int"),
            F.substring(s, 1, 2).cast("int"), F.substring(s, 12, 2).cast("int"),
            F.substring(s, 15, 2).cast("int"), F.substring(s, 18, 2).cast("int")))
    else:
        ts = F.to_timestamp_ntz(s, F.lit("dd/MM/yyyy HH:mm:ss"))
    return df.withColumn(out, ts).drop(date_col, time_col)


def parse_decimal_comma(df: DataFrame, cols: list[str] | None = None, strict: bool = False) -> DataFrame:
    """B2: decimal-comma text → DOUBLE (``'12,5'`` → 12.5); NULL stays NULL."""
    cols = [c for c in (cols or DECIMAL_COMMA_COLS) if c in df.columns]
    conv = {}
    for c in cols:
        txt = F.regexp_replace(F.col(c).cast("string"), ",", ".")
        conv[c] = txt.cast("double") if strict else txt.try_cast("double")
    return df.withColumns(conv)


def parse_integers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Counts of the export as BIGINT (the reference's reader infers them as integers)."""
    cols = [c for c in (cols or INTEGER_COLS + ["wo", "l_partkey", "l_suppkey"]) if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("bigint") for c in cols})


def minutes_to_hours(df: DataFrame, src: str = "cycle_minutes", out: str = "cycle_hours") -> DataFrame:
    """Minutes per piece → hours per piece, renamed."""
    return df.withColumn(out, F.col(src) / 60).drop(src)


def filter_positive(df: DataFrame, cols: tuple[str, ...] = ("pieces_counted", "work_hours")) -> DataFrame:
    """Keep rows where every column in ``cols`` is > 0."""
    cond = None
    for c in cols:
        e = F.col(c) > 0
        cond = e if cond is None else cond & e
    return df.filter(cond)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any ``subset``) column."""
    return df.na.drop(how="any", subset=subset)


def derive_inefficiency(df: DataFrame) -> DataFrame:
    """theoretical = cycle × pieces; index = hours / theoretical; theoretical > 0 kept."""
    th = F.col("cycle_hours") * F.col("pieces_counted")
    return (df.withColumn("theoretical_hours", th)
            .withColumn("inefficiency", F.col("work_hours") / F.nullif(F.col("theoretical_hours"), F.lit(0)))
            .filter(F.col("theoretical_hours") > 0))


def drop_leakage_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a list of columns; absent ones are ignored."""
    return df.drop(*cols)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep those of ``cols`` that exist, in the given order."""
    return df.select(*[c for c in cols if c in df.columns])


def fill_categories(df: DataFrame, cols: list[str], fill: str = MISSING) -> DataFrame:
    """Cast to STRING, NULL → ``MISSING``."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(fill)) for c in cols})


def fill_article(df: DataFrame, col: str = "article") -> DataFrame:
    """NULL article → ``MISSING_ARTICOLO``; an absent column becomes that constant."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(MISSING_ARTICLE))
    return df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit(MISSING_ARTICLE)))


def isolate_machine(df: DataFrame, machine: str) -> DataFrame:
    """One machine's orders (prunes partitions when the table is partitioned by machine)."""
    return df.filter(F.col("machine") == F.lit(machine))


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Numeric column names from the schema (plan time, no data pass)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def iqr_filter(df: DataFrame, col: str = "inefficiency", by: list[str] | None = None,
               k: float = 1.5, approx: bool = False) -> DataFrame:
    """Keep Q1 - k·IQR < x < Q3 + k·IQR, both bounds from the same unfiltered quartiles.

    Global by default (a one-row bound table, broadcast); ``by=[...]`` per group.
    """
    by = list(by or [])
    q = quantiles(df, col, [0.25, 0.75], by=by, names=["_q1", "_q3"], approx=approx)
    q = q.select(*by, (F.col("_q1") - k * (F.col("_q3") - F.col("_q1"))).alias("_lob"),
                 (F.col("_q3") + k * (F.col("_q3") - F.col("_q1"))).alias("_upb"))
    j = _join_on(df, F.broadcast(q) if not by else q, by)
    return j.filter((F.col(col) < F.col("_upb")) & (F.col(col) > F.col("_lob"))).drop("_lob", "_upb")


def clean_raw_export(raw: DataFrame, iqr: bool = True) -> DataFrame:
    """The whole cleaning plan: parse → units → positive → no NULLs → index → IQR filter."""
    df = parse_end_ts(raw)
    df = parse_decimal_comma(df)
    df = parse_integers(df)
    df = minutes_to_hours(df)
    df = filter_positive(df)
    df = drop_nulls(df)
    df = derive_inefficiency(df)
    return iqr_filter(df) if iqr else df


def sort_by_time(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """chronological order with the tie-breakers — a distributed sort, used at sinks."""
    from oeeflow.schema import ORDER_COLS
    return df.orderBy(*[c for c in (order_by or ORDER_COLS) if c in df.columns])
