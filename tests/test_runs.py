"""The catalogue of runs: one commit for a replacement, bounded reads, compaction."""

import datetime as dt
import glob
import os

import pytest

from tickwise import session
from tickwise.plans import jobs, serving
from tickwise.session import new_scratch_dir
from tickwise.sources import runs, sinks
from tickwise.sources.snapshots import rows_frame

from conftest import feed_row

START = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def rows(spark, n, tag="R"):
    return rows_frame(spark, [feed_row(symbol=f"{tag}{i}USDT", volume=20000 + i,
                                       priceChangePercent=i) for i in range(n)])


def seen(spark, out):
    """What a reader finds now: symbols, summaries, alerts counted and stored."""
    metrics = serving.read_collection(spark, out, "market_metrics").collect()
    alerts = serving.read_collection(spark, out, "critical_alerts").count()
    got = serving.read_collection(spark, out, "processed_data").select("symbol").collect()
    assert sum(m.total_symbols for m in metrics) == len(got)
    assert sum(m.critical_alerts for m in metrics) == alerts
    return sorted(r.symbol[0] for r in got)


def test_a_reader_sees_the_old_or_the_new_run(spark, monkeypatch):
    out = new_scratch_dir(spark, "swap")
    jobs.run_relative(spark, rows(spark, 3, "O"), out, run_ts=START)
    found = []

    def watched(module, name):
        real = getattr(module, name)

        def step(*args, **kw):
            found.append(seen(spark, out))
            done = real(*args, **kw)
            found.append(seen(spark, out))
            return done

        monkeypatch.setattr(module, name, step)

    held = serving.read_collection(spark, out, "processed_data")     # a reader of before
    for module, name in ((sinks, "write_run"), (runs, "entry"), (runs, "_publish"),
                         (runs, "delete"), (runs, "commit"), (runs, "drop_failed_tries")):
        watched(module, name)
    jobs.run_relative(spark, rows(spark, 5, "N"), out, run_ts=START + dt.timedelta(hours=1))
    monkeypatch.undo()
    assert found[0] == ["O"] * 3 and found[-1] == ["N"] * 5
    assert all(f in (["O"] * 3, ["N"] * 5) for f in found) and len(found) > 10
    assert held.count() == 3                        # finishes on the files it started with
    jobs.run_relative(spark, rows(spark, 2, "L"), out, run_ts=START + dt.timedelta(hours=2))
    folders = glob.glob(out + "/processed_data/run_id=*")
    assert len(folders) == 2                        # the newest and the one before


def test_a_failed_try_leaves_the_stored_run_and_is_cleared_by_the_next(spark, monkeypatch):
    out = new_scratch_dir(spark, "tries")
    jobs.run_relative(spark, rows(spark, 3, "O"), out, run_ts=START)
    later = {"run_ts": START + dt.timedelta(hours=1), "run_id": "again"}

    def fail(*_):
        raise OSError("lost")

    for at in ("entry", "_publish"):
        monkeypatch.setattr(runs, at, fail)
        with pytest.raises(OSError):
            jobs.run_relative(spark, rows(spark, 4, "N"), out, **later)
        monkeypatch.undo()
        assert seen(spark, out) == ["O"] * 3
    jobs.run_relative(spark, rows(spark, 4, "N"), out, **later)
    assert seen(spark, out) == ["N"] * 4
    assert len(glob.glob(out + "/processed_data/run_id=again-*")) == 1


def test_two_writers_both_count(spark, monkeypatch):
    out = new_scratch_dir(spark, "both")
    jobs.run_absolute(spark, rows(spark, 3, "A"), out, run_ts=START)
    real, raced = runs._publish, []

    def race(spark_, output, state):
        if not raced:                               # another writer takes the number first
            raced.append(1)
            jobs.run_absolute(spark, rows(spark, 2, "B"), out, run_ts=START, run_id="other")
        return real(spark_, output, state)

    monkeypatch.setattr(runs, "_publish", race)
    jobs.run_absolute(spark, rows(spark, 4, "C"), out, run_ts=START + dt.timedelta(1))
    assert seen(spark, out) == ["A"] * 3 + ["B"] * 2 + ["C"] * 4


def _many(spark, n):
    """Catalogue entries of ``n`` runs that share the files of one."""
    out = new_scratch_dir(spark, "many")
    jobs.run_absolute(spark, rows(spark, 3), out, run_ts=START)
    state = runs.current(spark, out)
    for i in range(1, n):
        stamp = START + dt.timedelta(minutes=i)
        one = {**state["runs"][0], "run_id": f"r{i:04d}", "timestamp": stamp.isoformat(),
               "oldest": stamp.isoformat()}
        runs.commit(spark, out, one, _schemas(state))
    return out


def _schemas(state):
    import json

    from pyspark.sql import types as T

    return {c: T.StructType.fromJson(json.loads(s)) for c, s in state["schemas"]["a"].items()}


def test_reads_open_a_bounded_number_of_files(spark, monkeypatch):
    out = _many(spark, 200)
    assert len(os.listdir(f"{out}/{runs.CATALOG}")) <= 2 * (runs.KEEP_VERSIONS + 1)
    opened = []
    real = runs._folder

    def counted(spark_, path):
        opened.append(path)
        return real(spark_, path)

    monkeypatch.setattr(runs, "_folder", counted)
    log = serving.run_log(spark, out)
    assert len(log) == 200 and log[0]["run_id"] == "r0199"
    assert len(opened) <= 2                         # the folder's names and one file
    newest = serving.latest_processed(spark, out, n=5)
    assert len(newest.inputFiles()) <= 4 * 2        # two runs of three rows
    assert "mergeSchema" not in newest._jdf.queryExecution().toString()
    assert serving.read_collection(spark, out, "market_metrics").count() == 200


def test_profiles_are_merged_from_the_catalogue(spark):
    out = new_scratch_dir(spark, "mixed")
    jobs.run_absolute(spark, rows(spark, 3), out, run_ts=START)
    jobs.run_relative(spark, rows(spark, 4), out, run_ts=START, replace=False)
    both = serving.read_collection(spark, out, "processed_data")
    assert both.count() == 7
    assert both.where("last_price IS NULL").count() == 4
    assert both.where("lastPrice IS NULL").count() == 3


def test_small_runs_become_one(spark):
    out = new_scratch_dir(spark, "small")
    for i in range(6):
        jobs.run_absolute(spark, rows(spark, 2, "ABCDEA"[i]), out,
                          run_ts=START + dt.timedelta(minutes=i))
    before = {c: sorted(map(str, serving.read_collection(spark, out, c).collect()))
              for c in runs.COLLECTIONS}
    newest = [r.symbol for r in serving.latest_processed(spark, out, n=3).collect()]
    made = jobs.compact_runs(spark, out, "a", batch_size=5)
    assert made["rows"] == 12 and made["summaries"] == 6
    assert len(serving.run_log(spark, out)) == 1
    assert {c: sorted(map(str, serving.read_collection(spark, out, c).collect()))
            for c in runs.COLLECTIONS} == before
    assert [r.symbol for r in serving.latest_processed(spark, out, n=3).collect()] == newest
    assert serving.latest_metrics(spark, out, n=4).count() == 4
    files = serving.read_collection(spark, out, "processed_data").inputFiles()
    assert len(files) <= 2 * 3
    assert jobs.compact_runs(spark, out, "a") is None
    # a run between the compacted ones' stamps is still found by age
    jobs.run_absolute(spark, rows(spark, 2, "Z"), out, run_ts=START + dt.timedelta(seconds=270))
    got = serving.latest_processed(spark, out, n=4).collect()
    assert sorted(r.symbol[0] for r in got) == ["A", "A", "Z", "Z"]


def test_jobs_leave_no_scratch_folder(spark):
    root = session.scratch_root(spark)
    for run in (jobs.run_absolute, jobs.run_relative):
        out = new_scratch_dir(spark, "out")
        before = set(os.listdir(root))
        run(spark, rows(spark, 3), out)
        assert set(os.listdir(root)) - before <= {os.path.basename(out)}


def test_old_scratch_folders_expire(spark):
    old, new = (new_scratch_dir(spark, x) for x in ("old", "new"))
    for path in (old, new):
        spark.range(1).write.parquet(path)
    os.utime(old, (1, 1))
    assert os.path.basename(old) in session.expire_scratch(spark)
    assert not os.path.exists(old) and os.path.exists(new)
    with pytest.raises(ValueError):
        session.remove_scratch(spark, "/tmp/elsewhere")
