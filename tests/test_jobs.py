import datetime as dt
import json
import os
import tempfile

from tickwise.operators.cleaning import score_absolute
from tickwise.plans import jobs, serving
from tickwise.session import new_scratch_dir
from tickwise.sources import sinks
from tickwise.sources.fixture import ticker_snapshot
from tickwise.sources.snapshots import rows_frame

from conftest import SF_SMALL, feed_row


def test_run_absolute_counts_every_stage(spark):
    out = new_scratch_dir(spark, "job")
    res = jobs.run_absolute(spark, ticker_snapshot(spark, SF_SMALL), out)
    assert res["loaded"] == 200
    assert res["loaded"] >= res["parsed"] >= res["cleaned"] == res["rows"] > 0
    processed = serving.read_collection(spark, out, "processed_data")
    alerts = serving.read_collection(spark, out, "critical_alerts")
    metrics = serving.read_collection(spark, out, "market_metrics")
    assert processed.count() == res["rows"]
    assert alerts.count() == res["critical"]
    m = metrics.collect()[0]
    assert m.total_symbols == res["rows"] and m.critical_alerts == res["critical"]
    assert sum(m.risk_distribution.values()) == res["rows"]
    # a second run appends
    jobs.run_absolute(spark, ticker_snapshot(spark, SF_SMALL), out)
    assert serving.read_collection(spark, out, "market_metrics").count() == 2
    # a run that is tried again replaces itself only
    for _ in range(2):
        jobs.run_absolute(spark, ticker_snapshot(spark, SF_SMALL), out,
                          run_ts=dt.datetime(2030, 1, 1))
    assert serving.read_collection(spark, out, "market_metrics").count() == 3
    assert serving.read_collection(spark, out, "processed_data").count() == 3 * res["rows"]


def test_a_run_without_summary_does_not_count(spark):
    out = new_scratch_dir(spark, "job")
    raw = ticker_snapshot(spark, SF_SMALL)
    res = jobs.run_absolute(spark, raw, out)
    sinks.write_run(score_absolute(raw), out, "processed_data", "29990101T000000000000")
    assert serving.read_collection(spark, out, "processed_data").count() == res["rows"]


def test_collections_without_runs_are_empty(spark):
    out = new_scratch_dir(spark, "none")
    assert serving.read_collection(spark, out, "processed_data").count() == 0
    assert serving.latest_alerts(spark, out).count() == 0
    assert serving.latest_metrics(spark, out).count() == 0
    o = serving.overview(serving.newest_run(spark, out, "processed_data"),
                         serving.newest_run(spark, out, "critical_alerts")).collect()[0]
    assert o.total_rows == 0 and o.alert_count == 0
    assert serving.detail_table(serving.newest_run(spark, out, "processed_data")).count() == 0


def test_stamp_is_the_same_instant_in_any_zone(spark):
    import time

    before = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        out = new_scratch_dir(spark, "zone")
        jobs.run_absolute(spark, ticker_snapshot(spark, SF_SMALL), out)
        apart = serving.read_collection(spark, out, "processed_data").selectExpr(
            "abs(unix_timestamp(processing_timestamp) - unix_timestamp()) AS s").first().s
        assert apart < 60
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def _feed_file(d, name, rows, cut=None):
    text = json.dumps(rows, indent=2)
    with open(os.path.join(d, name), "w") as f:
        f.write(text[:cut] if cut else text)


def test_truncated_newest_snapshot_keeps_stored_results(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [r.asDict() for r in ticker_snapshot(spark, SF_SMALL).collect()]
    _feed_file(d, "ticker_20240101_000000.json", rows)
    out = new_scratch_dir(spark, "cli")
    args = ["--profile", "b", "--input", d, "--mode", "latest", "--output", out]
    assert jobs.main(args) == 0
    size = [serving.read_collection(spark, out, c).count() for c in sinks.COLLECTIONS]
    _feed_file(d, "ticker_20240201_000000.json", rows, cut=len(json.dumps(rows, indent=2)) // 2)
    assert jobs.main(args) == 1
    assert [serving.read_collection(spark, out, c).count() for c in sinks.COLLECTIONS] == size
    assert size[0] > 0 and size[1] > 0


def test_cli_defaults_read_landed_and_indented_snapshots(spark):
    landed = new_scratch_dir(spark, "raw")
    rows = ticker_snapshot(spark, SF_SMALL)
    sinks.land_snapshot(rows, landed, "20240101_000000")
    feed = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _feed_file(feed, "ticker_20240101_000000.json", [r.asDict() for r in rows.collect()])
    for d in (landed, feed):
        out = new_scratch_dir(spark, "cli")
        assert jobs.main(["--input", d, "--output", out]) == 0
        assert serving.read_collection(spark, out, "processed_data").count() == 124
    out = new_scratch_dir(spark, "replay")
    assert jobs.replay_latest(spark, feed, out)["loaded"] == 200


def test_cli_pattern_and_missing_input(spark):
    d = new_scratch_dir(spark, "raw")
    sinks.land_snapshot(ticker_snapshot(spark, SF_SMALL), d, "20240101_000000", prefix="feed_")
    out = new_scratch_dir(spark, "cli")
    args = ["--profile", "b", "--input", d, "--mode", "latest", "--output", out]
    assert jobs.main(args) == 1
    assert jobs.main(args + ["--pattern", "feed_*.json"]) == 0
    assert jobs.main(["--input", d + "/nowhere", "--output", out]) == 1


def test_all_then_new_and_both_profiles(spark):
    d, out = new_scratch_dir(spark, "raw"), new_scratch_dir(spark, "cli")
    sinks.land_snapshot(ticker_snapshot(spark, SF_SMALL), d, "20240101_000000")
    args = ["--input", d, "--output", out]
    assert jobs.main(args) == 0
    assert jobs.main(args + ["--mode", "new"]) == 0
    assert serving.read_collection(spark, out, "processed_data").count() == 2 * 124
    assert jobs.main(args + ["--mode", "new", "--profile", "b"]) == 0
    log = serving.run_log(spark, out)
    assert len(log) == 3 and all(r["rows"] > 0 for r in log)
    alerts = serving.read_collection(spark, out, "critical_alerts").count()
    assert alerts == sum(r["alerts"] for r in log)


def test_relative_replace_leaves_empty_alerts(spark):
    out = new_scratch_dir(spark, "job")
    jobs.run_relative(spark, ticker_snapshot(spark, SF_SMALL), out)
    assert serving.read_collection(spark, out, "critical_alerts").count() > 0
    calm = [feed_row(symbol=f"C{i}USDT", volume=20000 + i) for i in range(5)]
    res = jobs.run_relative(spark, rows_frame(spark, calm), out)
    assert res["critical"] == 0
    assert serving.read_collection(spark, out, "processed_data").count() == 5
    assert serving.read_collection(spark, out, "critical_alerts").count() == 0
    assert serving.read_collection(spark, out, "market_metrics").count() == 1


def test_cli_latest_array_snapshot(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [r.asDict() for r in ticker_snapshot(spark, SF_SMALL).collect()]
    with open(os.path.join(d, "ticker_20240101_000000.json"), "w") as f:
        json.dump(rows[:10], f)
    with open(os.path.join(d, "ticker_2024-02-01_00-00-00.json"), "w") as f:
        json.dump(rows, f)
    out = new_scratch_dir(spark, "cli")
    code = jobs.main(["--profile", "b", "--input", d, "--mode", "latest",
                      "--layout", "array", "--output", out])
    assert code == 0
    assert serving.read_collection(spark, out, "processed_data").count() > 10


def test_cli_new_snapshots_only(spark):
    from tickwise.sources import sinks

    d = new_scratch_dir(spark, "raw")
    out = new_scratch_dir(spark, "cli")
    rows = ticker_snapshot(spark, SF_SMALL)
    sinks.land_snapshot(rows, d, "20240101_000000")
    args = ["--profile", "a", "--input", d, "--mode", "new", "--layout", "lines",
            "--output", out]
    assert jobs.main(args) == 0
    first = spark.read.parquet(f"{out}/processed_data").count()
    sinks.land_snapshot(rows, d, "20240102_000000")
    assert jobs.main(args) == 0
    assert spark.read.parquet(f"{out}/processed_data").count() == 2 * first
