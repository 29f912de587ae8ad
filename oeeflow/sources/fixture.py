"""Work orders derived from the test tables (``lineitem`` joined with ``part``).

The derivation uses integer arithmetic first so that every engine computes the same
doubles. ``work_orders`` is the clean table; ``raw_export_view`` is the same data as the
text export of the ERP (decimal commas, ``dd/MM/yyyy`` dates, all columns STRING).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
_PART_COLS = ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"]


def load_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")) for n in (names or TABLES)}


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).select(*_LINEITEM_COLS)
    pa = spark.read.parquet(os.path.join(sf_dir, "part.parquet")).select(*_PART_COLS)
    # part grows with the data; the join strategy is left to the planner (AQE turns it
    # into a broadcast only when the runtime size is under the threshold)
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        "*",
        F.col("l_quantity").cast("bigint").alias("_q"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("_work_u"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("_cyc_u"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("_tax_u"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("_disc_u"),
        F.timestamp_add("SECOND",
                       (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729
                        + F.col("l_partkey") * 13) % 86400,
                       F.col("l_shipdate")).alias("_end_ts"),
    )


def _common(b: DataFrame) -> list[Column]:
    return [
        F.col("l_orderkey").alias("wo"),
        F.concat(F.lit("F"), F.col("l_linenumber").cast("string")).alias("phase"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("article"),
        F.concat(F.lit("M"), (F.col("l_suppkey") % 20).cast("string")).alias("machine"),
        F.col("p_type").alias("work_center_planned"),
        F.concat(F.lit("C"), (F.col("p_size") % 5).cast("string")).alias("cic_code"),
    ]


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean work orders (one row = one phase of one order), typed as in ``schema.CLEAN_SCHEMA``."""
    b = _base(spark, sf_dir)
    q = F.col("_q")
    cycle = F.col("_cyc_u").cast("double") / 450000.0
    disc_u, tax_u = F.col("_disc_u"), F.col("_tax_u")
    return b.select(
        *_common(b),
        F.col("_end_ts").alias("end_ts"),
        q.alias("pieces_counted"),
        (q + F.col("l_linenumber")).alias("qty_erp"),
        (q - 1).alias("pieces_to_advance"),
        (tax_u.cast("double") / 10.0).alias("setup_hours"),
        (F.col("_work_u").cast("double") / 1000000.0).alias("work_hours"),
        F.when(disc_u == 0, F.lit(None).cast("double"))
         .otherwise(disc_u.cast("double") / 5.0).alias("stop_hours"),
        cycle.alias("cycle_hours"),
        F.when(F.col("l_partkey") % 6 == 0, F.lit(0.0))
         .otherwise(cycle * q * 1.05).alias("erp_machine_hours"),
        (tax_u.cast("double") / 8.0).alias("erp_setup_hours"),
        F.when(F.col("l_returnflag") == "R", F.expr("(_q * _disc_u) div 100"))
         .when(F.col("l_returnflag") == "N", F.lit(None).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("scrap_material"),
        F.expr("(_q * _tax_u) div 100").alias("scrap_machining"),
        F.when(F.col("l_returnflag") == "A", F.lit(1).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("pieces_reworked"),
        (cycle * q).alias("theoretical_hours"),
        (F.col("_work_u").cast("double") / 1000000.0 / (cycle * q)).alias("inefficiency"),
        "l_partkey", "l_suppkey",
    )


def _dec(units: Column, scale_digits: int) -> Column:
    """Integer ``units`` of 10^-scale as decimal-comma text (``12,345678``)."""
    p = F.lit(10 ** scale_digits)
    whole = F.floor(units / p).cast("bigint")
    return F.concat(whole.cast("string"), F.lit(","),
                    F.lpad((units % p).cast("string"), scale_digits, "0"))


def raw_export_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as the ERP's text export: every column STRING, decimal commas."""
    b = _base(spark, sf_dir)
    q = F.col("_q")
    tax_u, disc_u, cyc_u = F.col("_tax_u"), F.col("_disc_u"), F.col("_cyc_u")
    minutes_u = F.expr("(_cyc_u * 400 + 1) div 3")          # cycle minutes in 1e-6 units
    erp_u = F.expr("(_cyc_u * _q * 7 + 1) div 3")            # ERP machine hours in 1e-6 units
    return b.select(
        F.date_format("_end_ts", "dd/MM/yyyy").alias("end_date_raw"),
        F.date_format("_end_ts", "HH:mm:ss").alias("end_time_raw"),
        F.col("l_orderkey").cast("string").alias("wo"),
        *_common(b)[1:],
        _dec(tax_u, 1).alias("setup_hours"),
        _dec(F.col("_work_u"), 6).alias("work_hours"),
        F.when(disc_u == 0, F.lit(None).cast("string")).otherwise(_dec(disc_u * 2, 1)).alias("stop_hours"),
        _dec(minutes_u, 6).alias("cycle_minutes"),
        F.when(F.col("l_partkey") % 6 == 0, F.lit("0")).otherwise(_dec(erp_u, 6)).alias("erp_machine_hours"),
        _dec(tax_u * 125, 3).alias("erp_setup_hours"),
        q.cast("string").alias("pieces_counted"),
        (q + F.col("l_linenumber")).cast("string").alias("qty_erp"),
        (q - 1).cast("string").alias("pieces_to_advance"),
        F.when(F.col("l_returnflag") == "R", F.expr("cast((_q * _disc_u) div 100 as string)"))
         .when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
         .otherwise(F.lit("0")).alias("scrap_material"),
        F.expr("cast((_q * _tax_u) div 100 as string)").alias("scrap_machining"),
        F.when(F.col("l_returnflag") == "A", F.lit("1")).otherwise(F.lit("0")).alias("pieces_reworked"),
        F.col("l_partkey").cast("string").alias("l_partkey"),
        F.col("l_suppkey").cast("string").alias("l_suppkey"),
    )
