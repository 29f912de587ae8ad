"""What several operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oeeflow.session import ensure_checkpoint_dir

#: A word is a run of anything but the six ASCII white-space characters.
WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster it is
    installed or shipped with ``--py-files``; a path that is not there does no harm)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([x for x in have if x] + [_ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable, rows: int = 512) -> Iterator:
    """Arrow batches cut into pieces of ``rows`` rows, so that what a task derives from a batch stays
    small however many rows Spark puts into one."""
    import pyarrow as pa
    for batch in batches:
        n = batch.num_rows
        for lo in range(0, n, rows):  # copies: string functions of Arrow misread some views
            yield batch if n <= rows else batch.take(pa.array(range(lo, min(lo + rows, n)), pa.int64()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage, so that
    several readers share one computation and a lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row however often ``use`` names it (also
    inside the lambdas of array functions, where Spark would evaluate it once per element)."""
    return F.transform(F.array(value), use)[0]


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without building the words: each word with the white
    space around it becomes one character."""
    t = F.coalesce(text, F.lit(""))
    one_each = F.regexp_replace(t, f"{WS}*+{NOT_WS}++{WS}*+", "w")
    return F.when(F.regexp_like(t, F.lit(NOT_WS)), F.length(one_each)).otherwise(0).cast("long")
