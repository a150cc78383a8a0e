"""Session set-up and the shared scratch location.

Intermediate tables (CSV/JSON round trips, checkpoints, stream sinks and
checkpoints, saved models) go below the folder the cluster names in
``spark.checkpoint.dir``. Only a local session (tests) may go without that
setting; it gets a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PACKAGE_HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "chartstreak", driver_memory: str | None = None) -> SparkSession:
    """A session with adaptive execution; sizes are the cluster's unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if base:
        if not current:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    if current:
        # setCheckpointDir appends a random sub folder; use its parent.
        return os.path.dirname(current.rstrip("/"))
    if not (sc.master.startswith("local[") or sc.master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = tempfile.mkdtemp(prefix="chartstreak-ckpt-")
    sc.setCheckpointDir(base)
    _delete_at_end(spark, base)
    return base


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Ask the file system to remove ``path`` when the application ends."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)


_open_scopes = threading.local()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder; removed when the application ends."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _delete_at_end(spark, path)
    for made in getattr(_open_scopes, "lists", ()):
        made.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose readers are done."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make()`` returns, written and read back; the scratch tables made on the way are removed.

    For an operator whose result is used more than once, or whose scratch
    tables should not stay until the application ends. Tables made by other
    threads (streams, pools) are left alone, and so is everything if ``make`` or
    the write fails: a retry of the application may still read them.
    """
    made: list[str] = []
    lists = _open_scopes.lists = getattr(_open_scopes, "lists", [])
    lists.append(made)
    try:
        df = make()
    finally:
        lists.pop()
    out = materialise(df, name)
    for path in made:
        remove_path(spark, path)
    return out


ROWS_PER_BATCH, BYTES_PER_BATCH = 1_000, 16 << 20


def workers_import_package(spark: SparkSession) -> None:
    """Prepare a session for Python operators: the package's path, and small batches.

    Python workers can import the package where the driver's checkout is
    visible to them; on a cluster without one ship it with ``--py-files``.
    Batches of ``ROWS_PER_BATCH`` rows bound a worker's memory when texts are long.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_HOME, *paths])
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ROWS_PER_BATCH:
        spark.conf.set(rows, ROWS_PER_BATCH)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
