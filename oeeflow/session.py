"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

_SHIPPING = threading.Lock()  # fits run side by side


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "oeeflow", driver_memory: str | None = None) -> SparkSession:
    """Return the active session or build one with AQE on and the UI off.

    On a cluster the launcher owns master and resources; this only fills gaps.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = (SparkSession.builder.appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         # generated methods above 8000 bytes are never JIT-compiled by the JVM: let
         # Spark split such stages instead of running them in the bytecode interpreter
         .config("spark.sql.codegen.hugeMethodLimit", "8000"))
    if master:
        b = b.master(master)
    if driver_memory or (master and master.startswith("local")):
        # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", driver_memory or "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a local master (tests) gets a
    scratch folder; a cluster must name a folder that all executors share."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="oeeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def shared_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df, name: str = "table"):
    """Cut the lineage of a table that several plans read: write it once as parquet under
    the shared ``spark.checkpoint.dir`` and read it back (one computation, survives executor
    loss, later reads prune columns). Never a local checkpoint."""
    import uuid
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: once per application it is zipped and
    handed to them with ``addPyFile`` (needless, and harmless, where it is installed)."""
    import zipfile
    sc = spark.sparkContext
    with _SHIPPING:
        if any(x.startswith("oeeflow-") for x in sc._python_includes):
            return
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="oeeflow-ship-"), f"oeeflow-{os.getpid()}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(here)))
        sc.addPyFile(path)
