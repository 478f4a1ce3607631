"""Registered queries: key -> (Spark callable, oracle SQL or None).

Every query starts from the ticker derived from the driver's ``part`` and
``lineitem`` tables and landed as a JSON snapshot, so its work grows with
those tables. Queries that exercise sources and sinks write under a fresh
folder of the shared scratch root and return what they read back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions import exact_median
from tickwise.operators import aggregates as A
from tickwise.operators import documents as D
from tickwise.operators.cleaning import (cast_feed, clean, enrich, score_absolute,
                                         valid_rows)
from tickwise.operators.indicators import add_indicators, base_indicators
from tickwise.operators.relative import (cast_relative, filter_relative,
                                         relative_indicators, score_relative)
from tickwise.plans import jobs, serving
from tickwise.plans import oracle as O
from tickwise.schema import LABELS_A, RAW, SNAPSHOT_GLOB, SNAPSHOT_PREFIX
from tickwise.session import new_scratch_dir, stored
from tickwise.sources import sinks
from tickwise.sources import snapshots as S
from tickwise.sources.fixture import app_id, landed_fixture, ticker_snapshot
from tickwise.streaming.snapshots import rejected_files, stream_snapshots

TS = "processing_timestamp"
RUN_TS = _dt.datetime(2024, 6, 1, 8, 30, 0, tzinfo=_dt.timezone.utc)
RUN_TEXT = "2024-06-01 08:30:00"
LATER_TS = RUN_TS + _dt.timedelta(minutes=5)
LATER_TEXT = "2024-06-01 08:35:00"
OLDER_STAMP = "20240315_120000"        # compact stamp, ranks above by name
NEWER_STAMP = "2024-06-01_08-30-00"    # dashed stamp, newer by time

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(key: str, sql_tail: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = (fn, None if sql_tail is None else O.sql(sql_tail))
        return fn
    return deco


# ---------------------------------------------------------------- helpers
def raw(spark, sf) -> DataFrame:
    return ticker_snapshot(spark, sf)


def a_rows(spark, sf) -> DataFrame:
    return score_absolute(raw(spark, sf), RUN_TS).drop(TS)


def b_rows(spark, sf) -> DataFrame:
    return score_relative(raw(spark, sf))


def cast_rows(df: DataFrame) -> DataFrame:
    return cast_feed(df).drop(TS)


def with_stamp_text(df: DataFrame, ts: str = TS) -> DataFrame:
    """The stored stamp as text, to the second, for the comparison."""
    return df.withColumn(ts, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))


def _sel(spark_fn, *cols):
    return lambda spark, sf: spark_fn(spark, sf).select(*cols)


CAST_A = "SELECT * FROM a_cast"


# ------------------------------------------------------- profile A steps
register("clean_cast", CAST_A)(lambda spark, sf: cast_rows(raw(spark, sf)))
register("clean_valid", "SELECT * FROM a_valid")(
    lambda spark, sf: cast_feed(raw(spark, sf)).where(valid_rows()).drop(TS))
register("clean_enrich", "SELECT * FROM a_enr")(
    lambda spark, sf: enrich(cast_feed(raw(spark, sf)).where(valid_rows())).drop(TS))
register("clean_quality",
         "SELECT symbol, spread_percent, volatility, data_quality FROM a_enr")(
    lambda spark, sf: enrich(cast_feed(raw(spark, sf)).where(valid_rows()))
    .select("symbol", "spread_percent", "volatility", "data_quality"))
register("clean_final", "SELECT * FROM a_final")(
    lambda spark, sf: clean(raw(spark, sf), RUN_TS).drop(TS))
register("ind_base",
         "SELECT symbol, momentum, liquidity_score, volatility_score FROM a_i0")(
    lambda spark, sf: base_indicators(clean(raw(spark, sf)))
    .select("symbol", "momentum", "liquidity_score", "volatility_score"))


def _ind(spark, sf):
    return add_indicators(clean(raw(spark, sf), RUN_TS)).drop(TS)


for _key, _cols in {
    "ind_strength": ["symbol", "momentum", "signal_strength"],
    "ind_trend": ["symbol", "last_price", "open_price", "trend_direction"],
    "ind_momentum_cat": ["symbol", "momentum", "momentum_category"],
    "ind_liquidity_cat": ["symbol", "liquidity_score", "liquidity_category"],
    "ind_risk": ["symbol", "risk_score", "risk_category"],
    "ind_signal": ["symbol", "momentum", "risk_score", "trading_signal"],
    "ind_confidence": ["symbol", "trading_signal", "signal_confidence"],
}.items():
    register(_key, f"SELECT {', '.join(_cols)} FROM a_ind")(_sel(_ind, *_cols))
register("ind_all", "SELECT * FROM a_ind")(_ind)

for _key, _cols in {
    "anom_price": ["symbol", "momentum", "price_anomaly_score"],
    "anom_volume": ["symbol", "volume_usd", "volume_anomaly_score"],
    "anom_spread": ["symbol", "spread_percent", "spread_anomaly_score"],
    "anom_overall": ["symbol", "overall_anomaly_score", "anomaly_level"],
    "anom_pump_dump": ["symbol", "momentum", "volume_anomaly_score", "pump_dump_risk"],
    "anom_arbitrage": ["symbol", "spread_percent", "arbitrage_opportunity"],
    "anom_wash": ["symbol", "volume_anomaly_score", "price_anomaly_score",
                  "wash_trading_risk"],
    "anom_recommend": ["symbol", "recommendation"],
    "anom_critical": ["symbol", "critical_alert"],
}.items():
    register(_key, f"SELECT {', '.join(_cols)} FROM a_all")(_sel(a_rows, *_cols))
register("anom_all", "SELECT * FROM a_all")(a_rows)

# ------------------------------------------------------- profile B steps
register("b_cast", "SELECT * FROM b_cast")(lambda spark, sf: cast_relative(raw(spark, sf)))
register("b_filter", "SELECT * FROM b_f")(lambda spark, sf: filter_relative(raw(spark, sf)))
register("b_indicators", "SELECT * FROM b_ind")(
    lambda spark, sf: relative_indicators(filter_relative(raw(spark, sf))))
for _key, _cols in {
    "b_risk": ["symbol", "volatility", "risk_score", "risk_category"],
    "b_signal": ["symbol", "momentum", "risk_score", "trading_signal"],
    "b_anomaly_score": ["symbol", "volume_usd", "anomaly_score"],
    "b_anomaly_level": ["symbol", "anomaly_score", "anomaly_level"],
    "b_critical": ["symbol", "anomaly_level", "critical_alert"],
    "b_recommend": ["symbol", "trading_signal", "anomaly_level", "recommendation"],
}.items():
    register(_key, f"SELECT {', '.join(_cols)} FROM b_all")(_sel(b_rows, *_cols))
register("b_all", "SELECT * FROM b_all")(b_rows)

# ------------------------------------------------------------ aggregates
register("agg_stage_counts",
         "SELECT (SELECT count(*) FROM raw) AS loaded, (SELECT count(*) FROM a_valid) AS valid, "
         "(SELECT count(*) FROM a_final) AS final, "
         "(SELECT count(*) FROM a_all WHERE critical_alert) AS critical")(
    lambda spark, sf: A.stage_counts(raw(spark, sf)))
register("agg_group_counts",
         O.label_counts("a_all", ["risk_category", "trading_signal", "anomaly_level"]))(
    lambda spark, sf: A.domain_counts(a_rows(spark, sf), {
        d: LABELS_A[d] for d in ("risk_category", "trading_signal", "anomaly_level")}))
register("agg_totals",
         "SELECT count(*) AS total_symbols, round(sum(volume_usd), 0) AS total_volume_usd, "
         "round(avg(price_change_percent), 6) AS average_price_change FROM a_all")(
    lambda spark, sf: A.totals(a_rows(spark, sf)))
register("agg_median_volume", "SELECT median(volume_usd) AS median_volume_usd FROM b_ind")(
    lambda spark, sf: exact_median(stored(
        relative_indicators(filter_relative(raw(spark, sf))).select("volume_usd"), "volume"),
        "volume_usd")
    .withColumnRenamed("median", "median_volume_usd"))
register("agg_distributions_a", O.label_counts("a_all", A.DIMENSIONS_A))(
    lambda spark, sf: A.distributions_a(a_rows(spark, sf)))
register("agg_distributions_b",
         "SELECT d.dimension, d.label, COALESCE(c.n, 0) AS n FROM (VALUES "
         + ", ".join(f"('risk_category', '{x}')" for x in ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"])
         + ", " + ", ".join(f"('anomaly_level', '{x}')"
                            for x in ["NORMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"])
         + ") d(dimension, label) LEFT JOIN ("
         + O.label_counts("b_all", ["risk_category", "anomaly_level"])
         + ") c ON c.dimension = d.dimension AND c.label = d.label UNION ALL "
         + O.label_counts("b_all", ["trading_signal", "recommendation"]))(
    lambda spark, sf: A.distributions_b(b_rows(spark, sf)))
register("agg_alert_count",
         "SELECT 'A' AS profile, count(*) FILTER (WHERE critical_alert) AS critical_alerts "
         "FROM a_all UNION ALL SELECT 'B', count(*) FILTER (WHERE critical_alert) FROM b_all")(
    lambda spark, sf: A.alert_count(a_rows(spark, sf)).select(F.lit("A").alias("profile"), "*")
    .unionByName(A.alert_count(b_rows(spark, sf)).select(F.lit("B").alias("profile"), "*")))
register("serve_filter_options",
         " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS dimension, {c} AS label FROM a_all"
                            for c in ["risk_category", "trading_signal", "anomaly_level"]))(
    lambda spark, sf: A.filter_options(a_rows(spark, sf)))


# ----------------------------------------------------------------- top-k
def _top_sql(src, by, k, cols, largest=True):
    d = "DESC" if largest else "ASC"
    return (f"SELECT {', '.join(cols)} FROM {src} "
            f"ORDER BY {by} {d} NULLS LAST, symbol LIMIT {k}")


for _key, (_by, _k, _cols, _largest) in {
    "top_gainers": ("price_change_percent", 5, ["symbol", "price_change_percent"], True),
    "top_losers": ("price_change_percent", 5, ["symbol", "price_change_percent"], False),
    "top_volume": ("volume_usd", 5, ["symbol", "volume_usd"], True),
    "top_anomalous": ("overall_anomaly_score", 5,
                      ["symbol", "overall_anomaly_score", "anomaly_level"], True),
    "serve_top_risk": ("overall_anomaly_score", 10,
                       ["symbol", "overall_anomaly_score", "risk_category"], True),
    "serve_gainers": ("price_change_percent", 10, ["symbol", "price_change_percent"], True),
    "serve_losers": ("price_change_percent", 10, ["symbol", "price_change_percent"], False),
}.items():
    register(_key, _top_sql("a_all", _by, _k, _cols, _largest))(
        (lambda by, k, cols, largest: lambda spark, sf: A.top_k(
            a_rows(spark, sf), by, k, cols, largest))(_by, _k, _cols, _largest))

# ------------------------------------------------------------- documents
register("alerts_a", "SELECT * FROM a_alerts")(
    lambda spark, sf: D.alerts_a(a_rows(spark, sf)).drop("timestamp"))
register("alerts_b", "SELECT * FROM b_alerts")(
    lambda spark, sf: D.alerts_b(b_rows(spark, sf)).drop("timestamp"))
register("summary_a", O.summary_a())(
    lambda spark, sf: D.flatten_summary(D.summary_a(a_rows(spark, sf), RUN_TS)))
register("summary_b", O.summary_b())(
    lambda spark, sf: D.flatten_summary(D.summary_b(b_rows(spark, sf), RUN_TS)))


# --------------------------------------------------------------- sources
def _landed_dir(spark, sf) -> str:
    """Folder holding the session's landed fixture snapshot."""
    return landed_fixture(spark, sf).rsplit("/", 1)[0]


def _two_snapshots(spark, sf, older_subset: bool = False) -> str:
    """Fresh raw folder with an older compact-stamped and a newer dashed one.

    With ``older_subset`` the older snapshot holds only the non-USDT pairs,
    so reading the wrong one is visible in the result.
    """
    d = new_scratch_dir(spark, "raw")
    rows = raw(spark, sf)
    older = rows.where(~F.col("symbol").endswith("USDT")) if older_subset else rows
    sinks.land_snapshot(older, d, OLDER_STAMP)
    sinks.land_snapshot(rows, d, NEWER_STAMP)
    return d


register("src_all_snapshots", f"{CAST_A} UNION ALL {CAST_A}")(
    lambda spark, sf: cast_rows(S.read_all_snapshots(spark, _two_snapshots(spark, sf))))
register("src_glob_filter", CAST_A)(
    lambda spark, sf: cast_rows(S.read_with_glob_fallback(
        spark, _landed_dir(spark, sf), ("snapshot_*.json", SNAPSHOT_GLOB))))
register("src_path_fallback", CAST_A)(
    lambda spark, sf: cast_rows(S.read_with_path_fallback(
        spark, [_landed_dir(spark, sf) + "/missing/" + SNAPSHOT_GLOB,
                landed_fixture(spark, sf)])))
register("src_latest_snapshot", CAST_A)(
    lambda spark, sf: cast_rows(S.read_latest_snapshot(
        spark, _two_snapshots(spark, sf, older_subset=True))))
register("src_single_file", CAST_A)(
    lambda spark, sf: cast_rows(S.read_single_file(spark, landed_fixture(spark, sf), "lines")))
register("src_dispatch", CAST_A)(
    lambda spark, sf: (lambda d: cast_rows(S.read_ticker(
        spark, file=f"{d}/{SNAPSHOT_GLOB}", directory=d)))(_two_snapshots(spark, sf, True)))
register("src_nonempty", "SELECT count(*) AS records FROM raw")(
    lambda spark, sf: S.ensure_nonempty(raw(spark, sf)).agg(F.count(F.lit(1)).alias("records")))
register("src_preview",
         "SELECT symbol, last_price, price_change_percent, volume FROM a_cast "
         "ORDER BY symbol LIMIT 5")(
    lambda spark, sf: cast_feed(S.preview(raw(spark, sf)).select(
        "symbol", "lastPrice", "priceChangePercent", "volume",
        *[F.lit(None).cast("string").alias(c) for c in RAW.fieldNames()[4:]]))
    .select("symbol", "last_price", "price_change_percent", "volume"))


def _streamed(spark, sf) -> str:
    """Output folder of two incremental runs, of one snapshot each."""
    d = new_scratch_dir(spark, "stream")
    rows = raw(spark, sf)
    raw_dir, out = f"{d}/raw", f"{d}/out"
    sinks.land_snapshot(rows, raw_dir, OLDER_STAMP)
    first = stream_snapshots(spark, raw_dir, out, run_ts=RUN_TS)
    sinks.land_snapshot(rows, raw_dir, NEWER_STAMP)
    second = stream_snapshots(spark, raw_dir, out, run_ts=LATER_TS)
    if (first, second) != (1, 1):
        raise RuntimeError(f"expected one new batch per run, got {first}, {second}")
    return out


def _twice(tail: str, ts: str = TS) -> str:
    return " UNION ALL ".join(f"SELECT *, '{t}' AS {ts} FROM {tail}"
                              for t in (RUN_TEXT, LATER_TEXT))


register("stream_snapshots", _twice("a_all"))(
    lambda spark, sf: with_stamp_text(
        serving.read_collection(spark, _streamed(spark, sf), "processed_data")))
register("stream_alerts", _twice("a_alerts", "timestamp"))(
    lambda spark, sf: with_stamp_text(
        serving.read_collection(spark, _streamed(spark, sf), "critical_alerts"), "timestamp"))
register("stream_summary", f"SELECT * FROM ({O.summary_a()}) UNION ALL "
                           f"SELECT * FROM ({O.summary_a()})")(
    lambda spark, sf: D.flatten_summary(
        serving.read_collection(spark, _streamed(spark, sf), "market_metrics")))


#: Rows of one feed file in the queries below.
FEED_ROWS = 500
CUT = "symbol LIKE '%7USDT'"


def _feed_files(rows: DataFrame, path: str, cut: bool = False) -> None:
    """The rows as feed files of one indented JSON array each, about FEED_ROWS in
    a file; ``cut`` leaves out the second half of every file."""
    key = F.pmod(F.xxhash64("symbol"), F.lit(1 + rows.count() // FEED_ROWS))
    text = F.concat(F.lit("[\n"), F.concat_ws(",\n", F.collect_list(F.to_json(F.struct(
        *RAW.fieldNames())))), F.lit("\n]\n"))
    files = rows.groupBy(key.alias("file")).agg(text.alias("value"))
    if cut:
        files = files.withColumn("value", F.expr("left(value, length(value) div 2)"))
    files.write.partitionBy("file").text(path)


def _mixed_layouts(spark, sf) -> str:
    """Output of one incremental run over feed arrays and a landed snapshot."""
    d = new_scratch_dir(spark, "layouts")
    rows = raw(spark, sf)
    _feed_files(rows.where(CUT), f"{d}/raw/feed")
    sinks.land_snapshot(rows.where(f"symbol IS NULL OR NOT {CUT}"), f"{d}/raw", NEWER_STAMP)
    stream_snapshots(spark, f"{d}/raw", f"{d}/out", run_ts=RUN_TS, pattern="part-*")
    return f"{d}/out"


def _with_rejects(spark, sf) -> DataFrame:
    """Alerts of an incremental run in which every feed file is cut short, with
    the number of rows and of files that were set aside."""
    d = new_scratch_dir(spark, "rejects")
    rows = raw(spark, sf)
    _feed_files(rows.where(CUT), f"{d}/raw/feed", cut=True)
    files = spark.read.text(f"{d}/raw/feed", wholetext=True)
    sinks.land_snapshot(rows.where(f"symbol IS NULL OR NOT {CUT}"), f"{d}/raw", NEWER_STAMP)
    stream_snapshots(spark, f"{d}/raw", f"{d}/out", run_ts=RUN_TS, pattern="part-*")
    missing = files.select(F.col("_metadata.file_path").alias("file")).join(
        rejected_files(spark, f"{d}/out"), "file", "left_anti")
    n = missing.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return (serving.read_collection(spark, f"{d}/out", "processed_data")
            .select("symbol", "overall_anomaly_score", "critical_alert")
            .withColumn("files_not_rejected", n))


register("stream_mixed_layouts", "SELECT * FROM a_all")(
    lambda spark, sf: serving.read_collection(spark, _mixed_layouts(spark, sf), "processed_data")
    .drop(TS))
register("stream_rejects",
         f"SELECT symbol, overall_anomaly_score, critical_alert, 0::BIGINT AS files_not_rejected "
         f"FROM a_all WHERE NOT {CUT}")(_with_rejects)


# ----------------------------------------------------------------- sinks
def _readback(spark, path):
    return spark.read.parquet(path)


def _snk_land(spark, sf):
    d = new_scratch_dir(spark, "land")
    rows = raw(spark, sf)
    sinks.land_snapshot(rows, d, NEWER_STAMP, "errorifexists")
    sinks.land_snapshot(rows, d, NEWER_STAMP, "overwrite")   # replaces, no duplicates
    return cast_rows(S.read_all_snapshots(spark, d))


def _snk_raw_append(spark, sf):
    t = new_scratch_dir(spark, "ticker_24h")
    sinks.append_raw(spark, raw(spark, sf), t)
    sinks.append_raw(spark, raw(spark, sf), t)
    return cast_rows(S.read_ticker(spark, table=t))


def _snk_replace(spark, sf):
    t = new_scratch_dir(spark, "processed")
    for _ in range(2):
        sinks.write_processed(b_rows(spark, sf), t, "overwrite")
    return _readback(spark, t)


def _snk_append(spark, sf):
    t = new_scratch_dir(spark, "processed")
    for _ in range(2):
        sinks.write_processed(a_rows(spark, sf), t, "append", batch_size=100)
    return _readback(spark, t)


def _snk_alerts(spark, sf):
    t = new_scratch_dir(spark, "alerts")
    sinks.write_alerts(D.alerts_a(a_rows(spark, sf), RUN_TS), t, "append")
    return _readback(spark, t).drop("timestamp")


def _snk_metrics(spark, sf):
    t = new_scratch_dir(spark, "metrics")
    sinks.write_metrics(D.summary_a(a_rows(spark, sf), RUN_TS), t, "append")
    return D.flatten_summary(_readback(spark, t))


register("snk_land_snapshot", CAST_A)(_snk_land)
register("snk_raw_append", f"{CAST_A} UNION ALL {CAST_A}")(_snk_raw_append)
register("snk_processed_replace", "SELECT * FROM b_all")(_snk_replace)
register("snk_processed_append", "SELECT * FROM a_all UNION ALL SELECT * FROM a_all")(_snk_append)
register("snk_alerts", "SELECT * FROM a_alerts")(_snk_alerts)
register("snk_metrics", O.summary_a())(_snk_metrics)
register("snk_list_snapshots",
         f"SELECT '{SNAPSHOT_PREFIX}{OLDER_STAMP}.json' AS snapshot, count(*) AS records FROM raw "
         f"WHERE symbol NOT LIKE '%USDT' UNION ALL "
         f"SELECT '{SNAPSHOT_PREFIX}{NEWER_STAMP}.json', count(*) FROM raw")(
    lambda spark, sf: sinks.list_snapshots(spark, _two_snapshots(spark, sf, True)))


# ------------------------------------------------------------------ jobs
def _job_a(spark, sf) -> str:
    """Output of profile A after a batch run and an incremental one."""
    out = new_scratch_dir(spark, "etl")
    jobs.run_absolute(spark, raw(spark, sf), out, run_ts=RUN_TS)
    stream_snapshots(spark, _landed_dir(spark, sf), out, run_ts=LATER_TS)
    return out


def _job_b(spark, sf) -> str:
    """Output of profile B after a run that a second one replaced."""
    out = new_scratch_dir(spark, "analytics")
    jobs.run_relative(spark, raw(spark, sf).where("symbol LIKE '%7USDT'"), out, run_ts=RUN_TS)
    jobs.run_relative(spark, raw(spark, sf), out, run_ts=LATER_TS)
    return out


def _calm_b(spark, sf) -> str:
    """Profile B, then a run without alerts: prices that do not move."""
    out = new_scratch_dir(spark, "calm")
    rows = raw(spark, sf)
    jobs.run_relative(spark, rows, out, run_ts=RUN_TS)
    still = rows.where("symbol LIKE '%USDT'").withColumns({
        "priceChangePercent": F.lit("0"), "volume": F.lit("20000"), "lastPrice": F.lit("100"),
        "bidPrice": F.lit("99.99"), "askPrice": F.lit("100.01")})
    jobs.run_relative(spark, still, out, run_ts=LATER_TS)
    return out


def _stored_rows(make, name: str, ts: str):
    return lambda spark, sf: with_stamp_text(
        serving.read_collection(spark, make(spark, sf), name), ts)


def _stored_summary(make):
    return lambda spark, sf: D.flatten_summary(
        serving.read_collection(spark, make(spark, sf), "market_metrics"))


def _replay(spark, sf):
    out = new_scratch_dir(spark, "replay")
    jobs.replay_latest(spark, _two_snapshots(spark, sf, older_subset=True), out,
                       run_ts=RUN_TS)
    return out


def _at(tail: str, text: str, ts: str = TS) -> str:
    return f"SELECT *, '{text}' AS {ts} FROM {tail}"


register("pipeline_a", _twice("a_all"))(_stored_rows(_job_a, "processed_data", TS))
register("pipeline_a_alerts", _twice("a_alerts", "timestamp"))(
    _stored_rows(_job_a, "critical_alerts", "timestamp"))
register("pipeline_a_summary", f"SELECT * FROM ({O.summary_a()}) UNION ALL "
                               f"SELECT * FROM ({O.summary_a()})")(_stored_summary(_job_a))
register("pipeline_b", _at("b_all", LATER_TEXT))(_stored_rows(_job_b, "processed_data", TS))
register("pipeline_b_alerts", _at("b_alerts", LATER_TEXT, "timestamp"))(
    _stored_rows(_job_b, "critical_alerts", "timestamp"))
register("pipeline_b_summary", O.summary_b())(_stored_summary(_job_b))
register("pipeline_b_no_alerts",
         "SELECT count(*) AS total_symbols, 0::BIGINT AS critical_alerts, 0::BIGINT AS alert_rows "
         "FROM raw WHERE symbol LIKE '%USDT'")(
    lambda spark, sf: (lambda out: serving.read_collection(spark, out, "market_metrics")
                       .select("total_symbols", "critical_alerts").withColumn(
        "alert_rows", serving.read_collection(spark, out, "critical_alerts")
        .agg(F.count(F.lit(1)).alias("n")).select("n").scalar()))(_calm_b(spark, sf)))
register("replay_latest", _at("b_all", RUN_TEXT))(_stored_rows(_replay, "processed_data", TS))


def _compacted(spark, sf) -> str:
    """Three small runs, rewritten as one."""
    out = new_scratch_dir(spark, "compact")
    rows = raw(spark, sf)
    for i in range(3):
        jobs.run_absolute(spark, rows.where(F.pmod(F.crc32("symbol"), F.lit(3)) == i), out,
                          run_ts=RUN_TS + _dt.timedelta(microseconds=i))
    jobs.compact_runs(spark, out, "a", largest=1 << 62)
    if len(serving.run_log(spark, out)) != 1:
        raise RuntimeError("the runs were not compacted")
    return out


register("snk_compacted_runs", _at("a_all", RUN_TEXT))(
    _stored_rows(_compacted, "processed_data", TS))


def _cli(spark, sf) -> str:
    """Profile B as a user runs it: a folder, its preview, replaced results."""
    out = new_scratch_dir(spark, "cli")
    args = ["--profile", "b", "--input", _two_snapshots(spark, sf, older_subset=True),
            "--output", out]
    for mode in ("all", "latest"):
        if jobs.main([*args, "--mode", mode]) != 0:
            raise RuntimeError(f"the job failed with --mode {mode}")
    return out


register("job_cli", "SELECT * FROM b_all")(
    lambda spark, sf: serving.read_collection(spark, _cli(spark, sf), "processed_data").drop(TS))


# --------------------------------------------------------------- serving
_STORED: dict[tuple[str, str], str] = {}


def stored_run(spark, sf) -> str:
    """Output folder of one profile A run (shared by the serving queries)."""
    key = (app_id(spark), sf)
    if key not in _STORED:
        out = new_scratch_dir(spark, "store")
        jobs.run_absolute(spark, raw(spark, sf), out, run_ts=RUN_TS)
        _STORED[key] = out
    return _STORED[key]


def _several_runs(spark, sf) -> str:
    """A whole run, then a later one over a part of the symbols."""
    out = new_scratch_dir(spark, "runs")
    rows = raw(spark, sf)
    jobs.run_absolute(spark, rows, out, run_ts=RUN_TS)
    jobs.run_absolute(spark, rows.where("symbol LIKE '%7USDT'"), out, run_ts=LATER_TS)
    return out


# the lists of newest rows are limited; totals and tables are over whole runs
LATEST_A = "(SELECT * FROM a_all ORDER BY symbol LIMIT 1000)"
LATEST_ALERTS = "(SELECT * FROM a_alerts ORDER BY symbol LIMIT 100)"
DISPLAY = ("symbol, last_price, price_change_percent, volume_usd, risk_category, "
           "trading_signal, anomaly_level, recommendation")

register("serve_latest_over_runs",
         f"SELECT * FROM (SELECT *, '{RUN_TEXT}' AS {TS} FROM a_all UNION ALL "
         f"SELECT *, '{LATER_TEXT}' FROM a_all WHERE symbol LIKE '%7USDT') "
         f"ORDER BY {TS} DESC, symbol LIMIT 700")(
    lambda spark, sf: with_stamp_text(
        serving.latest_processed(spark, _several_runs(spark, sf), n=700)))
register("serve_latest_processed", f"SELECT * FROM {LATEST_A}")(
    lambda spark, sf: serving.latest_processed(spark, stored_run(spark, sf)).drop(TS))
register("serve_latest_alerts", f"SELECT * FROM {LATEST_ALERTS}")(
    lambda spark, sf: serving.latest_alerts(spark, stored_run(spark, sf)).drop("timestamp"))
register("serve_latest_metrics", O.summary_a())(
    lambda spark, sf: D.flatten_summary(serving.latest_metrics(spark, stored_run(spark, sf))))
register("serve_recent_alerts",
         f"SELECT symbol, alert_message FROM {LATEST_ALERTS} ORDER BY symbol LIMIT 5")(
    lambda spark, sf: serving.recent_alert_messages(
        serving.read_collection(spark, stored_run(spark, sf), "critical_alerts")))
register("serve_overview",
         f"SELECT count(*) AS total_rows, round(sum(volume_usd), 0) AS total_volume_usd, "
         f"round(COALESCE(avg(price_change_percent), 0e0), 6) AS average_change, "
         f"(SELECT count(*) FROM a_alerts) AS alert_count FROM a_all")(
    lambda spark, sf: serving.overview(
        serving.newest_run(spark, stored_run(spark, sf), "processed_data"),
        serving.newest_run(spark, stored_run(spark, sf), "critical_alerts")))
register("serve_distributions",
         O.label_counts("a_all", ["risk_category", "trading_signal",
                                  "recommendation", "anomaly_level"]))(
    lambda spark, sf: serving.distributions(
        serving.newest_run(spark, stored_run(spark, sf), "processed_data")))
register("serve_table",
         f"SELECT {DISPLAY} FROM a_all WHERE risk_category = 'MEDIUM' "
         f"AND anomaly_level = 'MODERATE' ORDER BY symbol LIMIT 100")(
    lambda spark, sf: serving.detail_table(
        serving.newest_run(spark, stored_run(spark, sf), "processed_data"),
        risk="MEDIUM", anomaly="MODERATE"))


def _mixed(spark, sf):
    out = new_scratch_dir(spark, "mixed")
    jobs.run_absolute(spark, raw(spark, sf), out, run_ts=RUN_TS)
    jobs.run_relative(spark, raw(spark, sf), out, run_ts=LATER_TS, replace=False)
    both = serving.read_collection(spark, out, "processed_data")
    return both.select("symbol", "risk_category", "trading_signal", "anomaly_level",
                       "recommendation", "volume_usd", "price_change_percent",
                       "priceChangePercent", "overall_anomaly_score", "anomaly_score")


register("serve_mixed_profiles",
         "SELECT symbol, risk_category, trading_signal, anomaly_level, recommendation, "
         "volume_usd, price_change_percent, NULL::DOUBLE AS priceChangePercent, "
         "overall_anomaly_score, NULL::DOUBLE AS anomaly_score FROM a_all UNION ALL "
         "SELECT symbol, risk_category, trading_signal, anomaly_level, recommendation, "
         "volume_usd, NULL::DOUBLE, priceChangePercent, NULL::DOUBLE, anomaly_score FROM b_all")(
    _mixed)


def queries() -> dict[str, Query]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in REGISTRY.items() if s is not None}
