"""Session construction and the shared scratch location.

Scratch output (landed snapshots, sink tables, stream checkpoints) lives
under the folder the cluster names in ``spark.checkpoint.dir`` so that every
executor sees it. Where that setting is absent, a local master (tests) gets a
folder of its own, registered as the checkpoint directory; any other master
stops with an error, since a folder of the driver's machine is not shared.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: A scratch folder that old belongs to no job that still runs.
EXPIRE_HOURS = 7 * 24


def build_session(master: str | None = None, app: str = "tickwise",
                  shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # INT96 timestamps carry no usable Parquet statistics; micros let the
        # run-stamp filters of the serving reads skip row groups
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # PySpark records a Python call stack for every Column operation (for
        # error messages); the scoring plans build ~1,000 of them (~1 s/plan)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_base(spark: SparkSession) -> str | None:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    """One process: a folder of this machine is shared by all of it."""
    master = spark.conf.get("spark.master", None) or ""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; set up only when unset."""
    base = _checkpoint_base(spark)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a "
                               "folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # no SparkContext (Spark Connect): folder only
            pass
    return base.rstrip("/")


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the scratch root for one run."""
    return f"{scratch_root(spark)}/tickwise-{label}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete one of this library's scratch folders."""
    if f"{scratch_root(spark)}/tickwise-" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def expire_scratch(spark: SparkSession, hours: float = EXPIRE_HOURS) -> list[str]:
    """Delete scratch folders that nothing was put into for ``hours``: those of
    jobs that failed. Returns their names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    limit, gone = (time.time() - hours * 3600) * 1000, []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("tickwise-") and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stored`` for one job: what it wrote is deleted when the job succeeds. A
    job that fails leaves it to ``expire_scratch``."""
    paths: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(new_scratch_dir(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    yield keep
    for path in paths:
        remove_scratch(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the scratch folder and read back: later passes
    read only the columns they need, and a lost executor loses nothing."""
    path = new_scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

