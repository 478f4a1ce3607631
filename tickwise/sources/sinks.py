"""Table sinks: landed snapshots, raw records, processed rows, alerts, summaries.

All writers are distributed DataFrame writes; nothing is collected to the
driver. Collections are Parquet directories; ``replace`` overwrites,
``append`` adds files.

A job's collections are partitioned by run: ``<collection>/run_id=<folder>``, a
folder of its own for each try. The run's entry in the catalogue (``runs``),
written last, makes it one of the current runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schema import RAW, SNAPSHOT_GLOB, SNAPSHOT_PREFIX
from tickwise.sources.runs import COLLECTIONS, run_folder  # noqa: F401


#: Records of one landed part file (a few hundred MB of JSON at most).
FILE_RECORDS = 1_000_000


def land_snapshot(df: DataFrame, raw_dir: str, stamp: str, mode: str = "errorifexists",
                  prefix: str = SNAPSHOT_PREFIX, file_records: int = FILE_RECORDS) -> str:
    """Write one snapshot as JSON lines under ``<prefix><stamp>.json``, in part
    files of bounded size."""
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("landing mode is overwrite or errorifexists")
    path = f"{raw_dir.rstrip('/')}/{prefix}{stamp}.json"
    df.select(*RAW.fieldNames()).write.mode(mode).option("maxRecordsPerFile",
                                                         file_records).json(path)
    return path


def append_raw(spark: SparkSession, records, table: str) -> None:
    """Append raw feed records (a DataFrame, a list of dicts or one dict)."""
    from tickwise.sources.snapshots import rows_frame

    df = records if isinstance(records, DataFrame) else rows_frame(spark, records)
    df.select(*RAW.fieldNames()).write.mode("append").parquet(table)


def write_processed(df: DataFrame, table: str, mode: str = "append",
                    batch_size: int | None = None) -> None:
    """Processed rows; ``batch_size`` bounds the rows per output file."""
    w = df.write.mode("overwrite" if mode == "replace" else mode)
    if batch_size:
        w = w.option("maxRecordsPerFile", int(batch_size))
    w.parquet(table)


def write_alerts(alerts: DataFrame, table: str, mode: str = "append") -> None:
    """Alerts. ``replace`` clears old alerts even when there are none now."""
    alerts.write.mode("overwrite" if mode == "replace" else mode).parquet(table)


def write_metrics(summary: DataFrame, table: str, mode: str = "append") -> None:
    summary.write.mode("overwrite" if mode == "replace" else mode).parquet(table)


def list_snapshots(spark: SparkSession, raw_dir: str,
                   pattern: str = SNAPSHOT_GLOB, layout: str = "auto",
                   with_counts: bool = True) -> DataFrame:
    """Landed snapshots.

    ``with_counts``: (snapshot, records) from one scan of the records.
    Without: (snapshot, files, bytes) from the file listing alone — the
    ``binaryFile`` source prunes the content column, so no record is read.
    """
    from tickwise.sources.snapshots import SNAPSHOT_NAME, read_snapshots

    path = f"{raw_dir.rstrip('/')}/{pattern}"
    if not with_counts:
        files = spark.read.format("binaryFile").load(path).select("path", "length")
        return (files.select(F.regexp_extract("path", SNAPSHOT_NAME, 1).alias("snapshot"),
                             "length")
                .groupBy("snapshot").agg(F.count(F.lit(1)).alias("files"),
                                         F.sum("length").alias("bytes")))
    rows = read_snapshots(spark, path, layout)
    return (rows.select(F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_NAME, 1)
                        .alias("snapshot"))
            .groupBy("snapshot").agg(F.count(F.lit(1)).alias("records")))



def write_run(df: DataFrame, output: str, collection: str, run_id: str,
              batch_size: int | None = None) -> DataFrame:
    """Write one run's partition of a collection, replacing what an earlier try
    left there; returns the rows as written."""
    path = run_folder(output, collection, run_id)
    write_processed(df, path, "replace", batch_size)
    return df.sparkSession.read.schema(df.schema).parquet(path)
