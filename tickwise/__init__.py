"""tickwise: market-ticker snapshot analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst plans it and Tungsten runs it in
whole-stage code generation; no Python UDF sits on the row path.
"""

from tickwise.operators.anomalies import add_anomalies
from tickwise.operators.cleaning import cast_feed, clean, score_absolute
from tickwise.operators.documents import alerts_a, alerts_b, summary_a, summary_b
from tickwise.operators.indicators import add_indicators
from tickwise.operators.relative import (filter_relative, relative_anomalies,
                                         relative_indicators, score_relative)
from tickwise.plans.jobs import (replay_latest, run_absolute, run_relative)
from tickwise.sources.sinks import append_raw, land_snapshot, list_snapshots
from tickwise.sources.snapshots import read_latest_snapshot, read_ticker

__version__ = "0.1.0"

__all__ = [
    "add_anomalies", "add_indicators", "alerts_a", "alerts_b", "append_raw",
    "cast_feed", "clean", "filter_relative", "land_snapshot", "list_snapshots",
    "read_latest_snapshot", "read_ticker", "relative_anomalies",
    "relative_indicators", "replay_latest", "run_absolute", "run_relative",
    "score_absolute", "score_relative", "summary_a", "summary_b",
]
