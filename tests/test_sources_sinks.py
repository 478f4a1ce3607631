import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tickwise.plans import serving
from tickwise.session import new_scratch_dir
from tickwise.sources import sinks
from tickwise.sources import snapshots as S
from tickwise.sources.fixture import ticker_snapshot
from tickwise.streaming.snapshots import stream_snapshots

from conftest import SF_SMALL, feed_row


def _processed(spark, out):
    return serving.read_collection(spark, out, "processed_data")


def _array_file(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        json.dump(rows, f, indent=2)


def test_array_layout_and_latest_by_parsed_stamp(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _array_file(d, "ticker_20240315_120000.json", [feed_row(symbol="NEW1USDT")])
    _array_file(d, "ticker_2024-06-01_08-30-00.json",
                [feed_row(symbol="NEW1USDT"), feed_row(symbol="NEW2USDT")])
    # by name the compact stamp sorts last, by time the dashed one is newer
    assert S.latest_snapshot_name(spark, d) == "ticker_2024-06-01_08-30-00.json"
    latest = S.read_latest_snapshot(spark, d, layout="array")
    assert sorted(r.symbol for r in latest.collect()) == ["NEW1USDT", "NEW2USDT"]
    everything = S.read_all_snapshots(spark, d, layout="array")
    assert everything.count() == 3          # no dedup across snapshots
    assert everything.where("symbol = 'NEW1USDT'").count() == 2
    assert latest.where("symbol = 'NEW1USDT'").count() == 1


def test_single_file_failfast(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(os.path.join(d, "ticker_20240101_000000.json"), "w") as f:
        f.write('[{"symbol": "AUSDT", "lastPrice": "1"}, {"symbol": ')
    with pytest.raises(Exception):
        S.read_single_file(spark, os.path.join(d, "ticker_20240101_000000.json")).collect()


def test_fallbacks_and_dispatch(spark):
    d = new_scratch_dir(spark, "t")
    sinks.land_snapshot(S.rows_frame(spark, [feed_row(symbol="AUSDT")]), d, "20240101_000000")
    got = S.read_with_glob_fallback(spark, d, ("nothing_*.json", "ticker_*.json"))
    assert [r.symbol for r in got.collect()] == ["AUSDT"]
    got = S.read_with_path_fallback(spark, [d + "/missing/x.json", d + "/ticker_*.json"])
    assert got.count() == 1
    assert S.local_fallback("hdfs://namenode:9000/feed/raw") == "./feed/raw"
    assert S.local_fallback("data/raw") == "./data/raw"
    assert S.read_with_local_fallback(spark, d + "/ticker_*.json").count() == 1
    with pytest.raises(ValueError):
        S.read_ticker(spark)


def test_empty_input_guard(spark):
    empty = S.rows_frame(spark, [feed_row()]).limit(0)
    with pytest.raises(ValueError):
        S.ensure_nonempty(empty)
    with pytest.raises(ValueError):                # records, but none usable
        S.ensure_nonempty(S.rows_frame(spark, [feed_row(symbol=None)]))


def test_rows_frame_takes_records_in_memory(spark):
    rows = [feed_row(symbol="AUSDT", lastPrice=1.5), feed_row(symbol="BUSDT", volume=None),
            {"symbol": "CUSDT"}]
    got = S.rows_frame(spark, rows).orderBy("symbol").collect()
    assert [(r.symbol, r.lastPrice, r.volume) for r in got] == [
        ("AUSDT", "1.5", "1000"), ("BUSDT", "100", None), ("CUSDT", None, None)]
    assert S.rows_frame(spark, rows[0]).count() == 1


def test_layouts_are_found_and_mismatches_fail(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _array_file(d, "ticker_20240101_000000.json", [feed_row(symbol=f"A{i}USDT") for i in range(3)])
    assert S.read_all_snapshots(spark, d).count() == 3
    with pytest.raises(Exception):
        S.read_all_snapshots(spark, d, "lines").collect()
    lines = new_scratch_dir(spark, "t")
    sinks.land_snapshot(S.rows_frame(spark, [feed_row(symbol="AUSDT"), feed_row(symbol="BUSDT")]),
                        lines, "20240101_000000")
    assert S.read_all_snapshots(spark, lines).count() == 2
    with pytest.raises(ValueError):
        S.read_all_snapshots(spark, lines, "array")


def test_land_modes_and_listing(spark):
    d = new_scratch_dir(spark, "t")
    df = S.rows_frame(spark, [feed_row(symbol="AUSDT"), feed_row(symbol="BUSDT")])
    sinks.land_snapshot(df, d, "20240101_000000")
    with pytest.raises(Exception):
        sinks.land_snapshot(df, d, "20240101_000000")          # errorifexists
    sinks.land_snapshot(df, d, "20240101_000000", "overwrite")
    sinks.land_snapshot(df.limit(1), d, "2024-02-01_00-00-00")
    listed = {r.snapshot: r.records for r in sinks.list_snapshots(spark, d).collect()}
    assert listed == {"ticker_20240101_000000.json": 2, "ticker_2024-02-01_00-00-00.json": 1}
    cheap = {r.snapshot: (r.files, r.bytes) for r in
             sinks.list_snapshots(spark, d, with_counts=False).collect()}
    assert set(cheap) == set(listed) and all(f >= 1 and b > 0 for f, b in cheap.values())


def test_raw_append_accepts_one_record_or_many(spark):
    t = new_scratch_dir(spark, "raw")
    sinks.append_raw(spark, feed_row(symbol="AUSDT"), t)
    sinks.append_raw(spark, [feed_row(symbol="BUSDT"), feed_row(symbol="CUSDT")], t)
    assert spark.read.parquet(t).count() == 3


def test_processed_batches_bound_file_size(spark):
    t = new_scratch_dir(spark, "p")
    df = ticker_snapshot(spark, SF_SMALL)
    sinks.write_processed(df, t, "append", batch_size=50)
    counts = spark.read.parquet(t).groupBy(F.input_file_name()).count().collect()
    assert max(r[1] for r in counts) <= 50
    assert sum(r[1] for r in counts) == df.count()


def test_stream_takes_only_new_snapshots(spark):
    d = new_scratch_dir(spark, "s")
    rows = ticker_snapshot(spark, SF_SMALL)
    sinks.land_snapshot(rows, f"{d}/raw", "20240101_000000")
    assert stream_snapshots(spark, f"{d}/raw", f"{d}/out") == 1
    first = _processed(spark, f"{d}/out").count()
    assert stream_snapshots(spark, f"{d}/raw", f"{d}/out") == 0
    sinks.land_snapshot(rows, f"{d}/raw", "20240102_000000")
    assert stream_snapshots(spark, f"{d}/raw", f"{d}/out") == 1
    assert _processed(spark, f"{d}/out").count() == 2 * first


def test_latest_rows_span_runs(spark):
    import datetime as dt

    from tickwise.plans.serving import latest

    t = new_scratch_dir(spark, "runs")
    for run, size in ((1, 5), (2, 5), (3, 5)):
        rows = [(f"S{run}{i}USDT", dt.datetime(2024, 1, run)) for i in range(size)]
        spark.createDataFrame(rows, "symbol string, processing_timestamp timestamp") \
            .write.mode("append").parquet(t)
    df = spark.read.parquet(t)
    got = [r.symbol for r in latest(df, "processing_timestamp", 7).collect()]
    assert got == [f"S3{i}USDT" for i in range(5)] + ["S20USDT", "S21USDT"]


def test_stream_bounds_files_per_batch(spark):
    d = new_scratch_dir(spark, "s")
    rows = ticker_snapshot(spark, SF_SMALL).coalesce(1)
    sinks.land_snapshot(rows, f"{d}/raw", "20240101_000000")
    sinks.land_snapshot(rows, f"{d}/raw", "20240102_000000")
    n = stream_snapshots(spark, f"{d}/raw", f"{d}/out", max_files_per_trigger=1)
    assert n == 2
    sizes = [r["rows"] for r in serving.run_log(spark, f"{d}/out")]
    assert len(sizes) == 2 and sizes[0] == sizes[1] > 0
    with pytest.raises(ValueError):
        stream_snapshots(spark, f"{d}/raw", f"{d}/out", profile="b", max_files_per_trigger=1)


def test_stream_profile_b_matches_batch(spark):
    from tickwise.operators.relative import score_relative

    d = new_scratch_dir(spark, "s")
    rows = ticker_snapshot(spark, SF_SMALL)
    sinks.land_snapshot(rows, f"{d}/raw", "20240101_000000")
    assert stream_snapshots(spark, f"{d}/raw", f"{d}/out", profile="b") == 1
    got = _processed(spark, f"{d}/out").drop("processing_timestamp")
    want = score_relative(rows)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
        sorted(map(tuple, want.select(cols).collect()), key=str)


def test_stream_reads_feed_array_files(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw_dir = os.path.join(d, "raw")
    os.makedirs(raw_dir)
    rows = [r.asDict() for r in ticker_snapshot(spark, SF_SMALL).collect()]
    _array_file(raw_dir, "ticker_20240101_000000.json", rows)
    out = new_scratch_dir(spark, "out")
    assert stream_snapshots(spark, raw_dir, out) == 1        # layout found
    lines = ticker_snapshot(spark, SF_SMALL)
    from tickwise.operators.cleaning import score_absolute

    assert _processed(spark, out).count() == score_absolute(lines).count()
