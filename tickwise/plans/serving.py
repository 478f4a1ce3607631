"""Read-side queries over the stored collections (dashboard data).

Totals, distributions and the detail table are over whole runs; only the lists
of newest rows and messages are limited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.sums import exact_avg, exact_sum
from tickwise.operators.aggregates import label_counts
from tickwise.schema import DISPLAY_COLUMNS
from tickwise.sources import runs


def _empty(spark: SparkSession, name: str) -> DataFrame:
    """A collection without rows, for output that holds no run yet."""
    schemas = {"processed_data": "symbol string, processing_timestamp timestamp",
               "critical_alerts": "symbol string, alert_message string, timestamp timestamp",
               "market_metrics": "timestamp timestamp, data_source string, "
                                 "total_symbols bigint, critical_alerts bigint"}
    return spark.createDataFrame([], schemas[name])


def _rows_of(spark: SparkSession, output: str, name: str, state: dict,
             entries: Sequence[dict]) -> DataFrame:
    found = runs.read(spark, output, name, state, list(entries))
    return _empty(spark, name) if found is None else found


def _newest_first(state: dict) -> list[dict]:
    return sorted(state["runs"], key=lambda r: (r["timestamp"], r["run_id"]), reverse=True)


def read_runs(spark: SparkSession, output: str, name: str, ids: Sequence[str]) -> DataFrame:
    """The rows of the given current runs; only their files are opened. Runs of
    both profiles may be among them: the catalogue names their columns, so no
    file's footer is read to merge them."""
    state = runs.current(spark, output)
    return _rows_of(spark, output, name, state, [r for r in state["runs"] if r["run_id"] in ids])


def run_log(spark: SparkSession, output: str) -> list[dict]:
    """The catalogue's entries of the current runs, newest first."""
    return _newest_first(runs.current(spark, output))


def read_collection(spark: SparkSession, output: str, name: str) -> DataFrame:
    """All current runs of a collection."""
    state = runs.current(spark, output)
    return _rows_of(spark, output, name, state, state["runs"])


def newest_run(spark: SparkSession, output: str, name: str) -> DataFrame:
    """The whole newest run of a collection."""
    state = runs.current(spark, output)
    return _rows_of(spark, output, name, state, _newest_first(state)[:1])


def latest(df: DataFrame, ts: str, n: int, tie: str = "symbol") -> DataFrame:
    """Newest n rows; rows of one run share a stamp, so ``tie`` orders them."""
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(n)


def _latest_of_runs(spark: SparkSession, output: str, name: str, ts: str, n: int,
                    size: str, tie: str = "symbol") -> DataFrame:
    """Newest n rows from the fewest newest runs that hold n: the catalogue says
    how many rows each run has, so older runs are not opened. A compacted run
    spans stamps; runs newer than its oldest stamp are opened with it."""
    state, chosen, rows, oldest = runs.current(spark, output), [], 0, ""
    for run in _newest_first(state):
        if rows >= n and run["timestamp"] < oldest:
            break
        chosen.append(run)
        rows += run[size]
        oldest = min(oldest or run["oldest"], run["oldest"])
    return latest(_rows_of(spark, output, name, state, chosen), ts, n, tie)


def latest_processed(spark, output, n: int = 1000) -> DataFrame:
    return _latest_of_runs(spark, output, "processed_data", "processing_timestamp", n, "rows")


def latest_alerts(spark, output, n: int = 100) -> DataFrame:
    return _latest_of_runs(spark, output, "critical_alerts", "timestamp", n, "alerts")


def latest_metrics(spark, output, n: int = 10) -> DataFrame:
    return _latest_of_runs(spark, output, "market_metrics", "timestamp", n, "summaries",
                           tie="data_source")


def overview(processed: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows, total volume, alert count, mean change; absent columns give 0."""
    def col_or_zero(name: str, agg):
        return agg(name) if name in processed.columns else F.lit(0.0)

    alert_n = alerts.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return processed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.round(col_or_zero("volume_usd", exact_sum), 0).alias("total_volume_usd"),
        F.round(F.coalesce(col_or_zero("price_change_percent", exact_avg), F.lit(0.0)), 6)
        .alias("average_change"),
    ).withColumn("alert_count", alert_n)


def distributions(processed: DataFrame) -> DataFrame:
    cols = [c for c in ("risk_category", "trading_signal", "recommendation",
                        "anomaly_level") if c in processed.columns]
    return label_counts(processed, cols)


def detail_table(processed: DataFrame, risk: str = "all", signal: str = "all",
                 anomaly: str = "all", n: int = 100,
                 columns: Sequence[str] = DISPLAY_COLUMNS,
                 order: Sequence = ()) -> DataFrame:
    """Optional equality filters ("all" = none), then the first n rows in order
    (newest first, then by symbol, if none is given), present columns only."""
    df = processed
    for col, val in (("risk_category", risk), ("trading_signal", signal),
                     ("anomaly_level", anomaly)):
        if val != "all" and col in df.columns:
            df = df.where(F.col(col) == val)
    if not order:
        stamp = "processing_timestamp"
        order = [F.desc(stamp)] * (stamp in df.columns) + [F.asc("symbol")]
    df = df.orderBy(*order)
    return df.select(*[c for c in columns if c in df.columns]).limit(n)


def recent_alert_messages(alerts: DataFrame, n: int = 5) -> DataFrame:
    return latest(alerts, "timestamp", n).select("symbol", "alert_message")
