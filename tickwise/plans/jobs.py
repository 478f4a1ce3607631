"""End-to-end jobs: profile A ETL, profile B analysis, replay of the newest
snapshot, plus a ``spark-submit`` entry point.

Each job reads and parses its input once and writes the processed rows to a
folder of their own; the alerts and the market summary are then derived from
those written rows (column-pruned Parquet reads), so nothing is cached in
executors and a lost executor never loses intermediate state. The run's entry in
the catalogue comes last: in one step it makes the run count and, where the job
replaces results, takes the others' place. A run that is tried again with its id
replaces itself. Scratch tables are deleted when the job has succeeded.
Stage counts are collected with ``Observation``s on the same jobs.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import logging
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.stamps import as_utc, stamp, utc_now
from tickwise.operators import documents as D
from tickwise.operators.cleaning import score_absolute, scored_metrics
from tickwise.operators.relative import (filter_relative, relative_anomalies,
                                          relative_indicators)
from tickwise.schema import SNAPSHOT_GLOB
from tickwise.session import expire_scratch, job_scratch
from tickwise.sources import runs, sinks
from tickwise.sources.snapshots import (ensure_nonempty, first_records, load_directory,
                                        read_latest_snapshot, read_ticker)

log = logging.getLogger("tickwise")


def new_run_id(run_ts: _dt.datetime) -> str:
    """The run's stamp in UTC, to the microsecond; ids sort like stamps."""
    return as_utc(run_ts).strftime("%Y%m%dT%H%M%S%f")


def _finish(profile: str, rows: DataFrame, alerts: DataFrame, summary: DataFrame, output: str,
            run_id: str, folder: str, run_ts: _dt.datetime, replace: bool) -> None:
    spark = rows.sparkSession
    written = {"processed_data": rows,
               "critical_alerts": sinks.write_run(alerts, output, "critical_alerts", folder),
               "market_metrics": sinks.write_run(summary, output, "market_metrics", folder)}
    total = written["market_metrics"].select("total_symbols", "critical_alerts").first()
    made = runs.entry(spark, output, run_id, folder, profile, as_utc(run_ts).isoformat(),
                      total["total_symbols"], total["critical_alerts"])
    runs.commit(spark, output, made, {c: df.schema for c, df in written.items()}, replace)
    runs.drop_failed_tries(spark, output, run_id, profile, folder)


def run_absolute(spark: SparkSession, raw: DataFrame, output: str,
                 batch_size: int | None = None, run_ts: _dt.datetime | None = None,
                 run_id: str | None = None, replace: bool = False) -> dict:
    """Profile A: clean -> indicators -> anomalies -> the run's three partitions.

    ``batch_size`` bounds the rows per written file (the writer's unit of
    work); by default Spark sizes files by partition. Repeating a run with its
    ``run_id`` (by default its stamp) replaces that run only.
    """
    run_ts = run_ts or utc_now()
    run_id = run_id or new_run_id(run_ts)
    folder = runs.new_folder(run_id, "a")
    loaded = Observation("loaded")
    raw = raw.observe(loaded, F.count(F.lit(1)).alias("rows"))
    stats, parsed, cleaned = Observation("scored"), Observation("parsed"), Observation("cleaned")
    scored = score_absolute(raw, run_ts, stats, parsed, cleaned)
    rows = sinks.write_run(scored, output, "processed_data", folder, batch_size)
    _finish("a", rows, D.alerts_a(rows, run_ts), D.summary_a(rows, run_ts), output, run_id,
            folder, run_ts, replace)
    result = {"loaded": loaded.get.get("rows", 0), "parsed": parsed.get.get("rows", 0),
              "cleaned": cleaned.get.get("rows", 0), **stats.get}
    log.info("profile A: %s", result)
    return result


def run_relative(spark: SparkSession, raw: DataFrame, output: str,
                 run_ts: _dt.datetime | None = None, exact_median: bool = True,
                 run_id: str | None = None, replace: bool = True) -> dict:
    """Profile B: filter -> indicators -> median-relative anomalies; with
    ``replace`` this run's rows become the only ones, once all are written.

    The filtered rows are written once to the scratch folder; the median passes
    read their one column and the scoring reads them again.
    """
    run_ts = run_ts or utc_now()
    run_id = run_id or new_run_id(run_ts)
    folder = runs.new_folder(run_id, "b")
    loaded, kept, stats = Observation("loaded"), Observation("kept"), Observation("relative")
    raw = raw.observe(loaded, F.count(F.lit(1)).alias("rows"))
    with job_scratch(spark) as stored:
        base = stored(relative_indicators(filter_relative(raw))
                      .observe(kept, F.count(F.lit(1)).alias("rows")), "relative")
        scored = (relative_anomalies(base, exact_median).observe(stats, *scored_metrics())
                  .withColumn("processing_timestamp", stamp(run_ts)))
        rows = sinks.write_run(scored, output, "processed_data", folder)
    _finish("b", rows, D.alerts_b(rows, run_ts), D.summary_b(rows, run_ts), output, run_id,
            folder, run_ts, replace)
    result = {"loaded": loaded.get.get("rows", 0), "filtered": kept.get.get("rows", 0),
              **stats.get}
    log.info("profile B: %s", result)
    return result


def replay_latest(spark: SparkSession, raw_dir: str, output: str,
                  pattern: str = SNAPSHOT_GLOB, layout: str = "auto",
                  run_ts: _dt.datetime | None = None) -> dict:
    """Newest landed snapshot through profile B, in the same session."""
    raw = read_latest_snapshot(spark, raw_dir, pattern, layout)
    return run_relative(spark, ensure_nonempty(raw), output, run_ts)


def compact_runs(spark: SparkSession, output: str, profile: str, largest: int = 1_000_000,
                 batch_size: int = 1_000_000) -> dict | None:
    """Rewrite a profile's runs of up to ``largest`` rows (micro-batches) as one
    run in files of bounded size, under one commit; rows, alerts and summaries
    stay as they are. Returns the new entry, None if fewer than two runs are small.
    """
    state = runs.current(spark, output)
    small = sorted((r for r in state["runs"] if r["profile"] == profile and r["rows"] <= largest),
                   key=lambda r: (r["timestamp"], r["run_id"]))
    if len(small) < 2:
        return None
    run_id = f"{small[-1]['run_id']}-compact"
    folder = runs.new_folder(run_id, profile)
    files = 1 + sum(r["rows"] for r in small) // batch_size
    schemas = {}
    for collection in sinks.COLLECTIONS:
        rows = runs.read(spark, output, collection, state, small)
        schemas[collection] = rows.schema
        sinks.write_run(rows.coalesce(files), output, collection, folder, batch_size)
    made = runs.entry(spark, output, run_id, folder, profile, small[-1]["timestamp"],
                      sum(r["rows"] for r in small), sum(r["alerts"] for r in small),
                      min(r["oldest"] for r in small), sum(r["summaries"] for r in small))
    runs.commit(spark, output, made, schemas, instead=[r["run_id"] for r in small])
    return made


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tickwise", description="Ticker snapshot analytics on Spark")
    p.add_argument("--profile", choices=["a", "b"], default="a")
    p.add_argument("--input", required=True,
                   help="snapshot directory, or one snapshot file / glob")
    p.add_argument("--mode", choices=["all", "latest", "new"], default="all",
                   help="all snapshots, the newest one, or only those not yet "
                        "processed (stream with a checkpoint under --output)")
    p.add_argument("--layout", choices=["auto", "lines", "array"], default="auto")
    p.add_argument("--pattern", default=SNAPSHOT_GLOB,
                   help="names of the snapshots among which --mode latest chooses")
    p.add_argument("--preview", type=int, default=5, metavar="N",
                   help="records to show before processing (0: none)")
    p.add_argument("--output", required=True)
    p.add_argument("--batch-size", type=int, default=1_000_000,
                   help="rows per written file of processed rows")
    p.add_argument("--compact", action="store_true",
                   help="with --mode new: rewrite small runs as one afterwards")
    p.add_argument("--approx-median", action="store_true")
    args = p.parse_args(argv)

    from tickwise.session import build_session

    active = SparkSession.getActiveSession()
    spark = active or build_session()
    try:
        expire_scratch(spark)
        if args.mode == "new":
            from tickwise.streaming.snapshots import stream_snapshots

            n = stream_snapshots(spark, args.input, args.output, layout=args.layout,
                                 profile=args.profile)
            log.info("processed %d new micro-batch(es)", n)
            if args.compact:
                compact_runs(spark, args.output, args.profile, batch_size=args.batch_size)
            return 0
        if args.mode == "latest":
            raw = read_latest_snapshot(spark, args.input, args.pattern, args.layout)
        elif args.input.endswith(".json") or "*" in args.input:
            raw = read_ticker(spark, file=args.input, layout=args.layout)
        else:
            raw = load_directory(spark, args.input, args.layout)
        for row in first_records(raw, args.preview):
            log.info("record %s", row.asDict())
        if args.profile == "a":
            run_absolute(spark, raw, args.output, args.batch_size)
        else:
            run_relative(spark, raw, args.output, exact_median=not args.approx_median)
        return 0
    except Exception:
        log.exception("job failed")
        return 1
    finally:
        if active is None:          # only stop a session this call started
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
