"""Files judged by their own content, in one reading; malformed ones set aside."""

import json
import os
import tempfile

import pytest

from tickwise.plans import jobs, serving
from tickwise.session import new_scratch_dir
from tickwise.sources import sinks
from tickwise.sources import snapshots as S
from tickwise.streaming.snapshots import rejected_files, stream_snapshots

from conftest import feed_row


def good(n, tag):
    """Rows that profile A keeps."""
    return [feed_row(symbol=f"{tag}{i}USDT", volume=5000 + i) for i in range(n)]


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def lines(rows):
    return "\n".join(json.dumps(r) for r in rows) + "\n"


def mixed(spark):
    """One array file of five records, one landed snapshot of seven."""
    d = folder()
    put(d, "ticker_20240101_000000.json", json.dumps(good(5, "A"), indent=2))
    sinks.land_snapshot(S.rows_frame(spark, good(7, "L")), d, "20240102_000000")
    return d


def test_mixed_folder_gives_every_record(spark):
    d = mixed(spark)
    got = sorted(r.symbol for r in S.read_all_snapshots(spark, d).collect())
    assert got == sorted(r["symbol"] for r in good(5, "A") + good(7, "L"))
    for profile in "ab":
        out = new_scratch_dir(spark, "out")
        args = ["--input", d, "--mode", "new", "--profile", profile, "--output", out]
        assert jobs.main(args) == 0
        rows = serving.read_collection(spark, out, "processed_data")
        assert rows.count() == (12 if profile == "a" else 0)
        assert serving.read_collection(spark, out, "market_metrics").count() == 1
        assert rejected_files(spark, out).count() == 0


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_forced_wrong_layout_fails_and_keeps_the_files(spark, layout):
    d, out = mixed(spark), new_scratch_dir(spark, "out")
    args = ["--input", d, "--mode", "new", "--output", out]
    assert jobs.main(args + ["--layout", layout]) == 1
    assert serving.run_log(spark, out) == []
    assert jobs.main(args) == 0                    # nothing was marked as done
    assert serving.read_collection(spark, out, "processed_data").count() == 12
    with pytest.raises(Exception):
        S.read_all_snapshots(spark, d, layout).collect()


def test_lines_in_a_plain_file_and_odd_ones(spark):
    d = folder()
    put(d, "ticker_20240101_000000.json", lines(good(4, "P")))
    put(d, "ticker_20240102_000000.json", "")
    put(d, "ticker_20240103_000000.json", " \n[]\n")
    put(d, "ticker_20240104_000000.json", "﻿" + json.dumps(good(2, "B")) + "\n")
    put(d, "ticker_20240105_000000.json", lines(good(1, "X")) + json.dumps(good(2, "Y")) + "\n\n")
    assert S.read_all_snapshots(spark, d).count() == 4 + 2 + 1 + 2
    for bad in ("{", "[{\"symbol\": \"A\"}] [", "[1, 2", lines(good(2, "Z"))[:-20], "x"):
        put(d, "ticker_20240106_000000.json", bad)
        with pytest.raises(Exception, match="ticker_20240106_000000"):
            S.read_all_snapshots(spark, d).collect()


def test_truncated_file_is_set_aside_and_the_batch_goes_on(spark):
    d, out = mixed(spark), new_scratch_dir(spark, "out")
    whole = json.dumps(good(6, "T"), indent=2)
    put(d, "ticker_20240103_000000.json", whole[:len(whole) // 2])
    put(d, "ticker_20240104_000000.json", lines(good(3, "U"))[:-9])
    args = ["--input", d, "--mode", "new", "--output", out]
    assert jobs.main(args) == 0
    assert serving.read_collection(spark, out, "processed_data").count() == 12
    bad = {os.path.basename(r.file): r for r in rejected_files(spark, out).collect()}
    assert set(bad) == {"ticker_20240103_000000.json", "ticker_20240104_000000.json"}
    assert bad["ticker_20240103_000000.json"].bytes == len(whole) // 2
    put(d, "ticker_20240105_000000.json", whole)   # the folder is not poisoned
    assert jobs.main(args) == 0
    assert serving.read_collection(spark, out, "processed_data").count() == 18
    assert rejected_files(spark, out).count() == 2


def test_input_is_read_once(spark):
    d = folder()
    for i in range(3):
        put(d, f"ticker_2024010{i + 1}_000000.json", json.dumps(good(400, f"R{i}x"), indent=2))
    for layout in ("auto", "array"):
        df = S.read_all_snapshots(spark, d, layout)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert df.count() == 1200


def test_a_job_reads_its_input_once(spark):
    """Counted by the records that the scan hands on, for both profiles."""
    d = folder()
    put(d, "ticker_20240101_000000.json", json.dumps(good(300, "R"), indent=2))
    for run in (jobs.run_absolute, jobs.run_relative):
        seen = spark.sparkContext.accumulator(0)
        rows = S.read_all_snapshots(spark, d)
        from pyspark.sql import functions as F

        @F.udf("string")
        def counted(x, seen=seen):
            seen.add(1)
            return x

        run(spark, rows.withColumn("symbol", counted.asNondeterministic()("symbol")),
            new_scratch_dir(spark, "out"))
        assert seen.value == 300
