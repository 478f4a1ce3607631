"""Alert rows and the one-row market summary document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickwise.functions.stamps import stamp
from tickwise.functions.sums import exact_avg, exact_sum
from tickwise.operators.aggregates import domain_count_maps, missing_last
from tickwise.schema import LABELS_A, LABELS_B, SOURCE_TAG_A, SOURCE_TAG_B, ZERO_FILLED_B


def _examined(df: DataFrame) -> DataFrame:
    """Count the rows examined for alerts. The observed node also keeps the
    optimizer from pushing the alert filter into the scoring stage, where it
    would re-inline every label definition into one scan predicate."""
    if df.isStreaming:
        return df
    return df.observe(Observation(), F.count(F.lit(1)).alias("examined"))


# Field names and message texts of the alerts must equal those
# of the feed's other consumers.
def alerts_a(df: DataFrame, run_ts=None) -> DataFrame:
    """Alert rows of the critical profile A rows."""
    c = F.col
    return _examined(df).where(c("critical_alert")).select(
        "symbol",
        F.concat(c("anomaly_level"), F.lit("_ANOMALY")).alias("alert_type"),
        F.concat(c("symbol"), F.lit(": "), c("recommendation"), F.lit(" - "),
                 c("anomaly_level"), F.lit(" anomaly")).alias("alert_message"),
        c("overall_anomaly_score").alias("anomaly_score"),
        c("last_price").alias("price"),
        c("price_change_percent").alias("change_percent"),
        "volume_usd", "pump_dump_risk", "recommendation",
        stamp(run_ts).alias("timestamp"))


def alerts_b(df: DataFrame, run_ts=None) -> DataFrame:
    c = F.col
    return _examined(df).where(c("critical_alert")).select(
        "symbol",
        F.concat(c("anomaly_level"), F.lit("_ANOMALY")).alias("alert_type"),
        F.concat(c("symbol"), F.lit(": "), c("recommendation"), F.lit(" - "),
                 c("anomaly_level"), F.lit(" anomaly detected")).alias("alert_message"),
        c("anomaly_score").alias("anomaly_score"),
        c("lastPrice").alias("price"),
        c("priceChangePercent").alias("change_percent"),
        "volume_usd", "recommendation",
        stamp(run_ts).alias("timestamp"))


def _ranked_lists(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """Several top-k lists, each an ordered ``array<struct>``, from one read.

    Each row is offered to every list; a window limited to k rows per list
    keeps k rows a task before the shuffle, so k rows per task and list meet.
    A missing value comes after all others, ties go by symbol.
    """
    fields = list(dict.fromkeys(f for _, _, own, _ in specs.values() for f in own))
    offers = F.array(*[F.struct(
        F.lit(name).alias("list"), (missing_last(df, by) * (-1.0 if largest else 1.0)).alias("key"))
        for name, (by, _, _, largest) in specs.items()])
    most = max(k for _, k, _, _ in specs.values())
    place = Window.partitionBy("_offer.list").orderBy(F.asc_nulls_last("_offer.key"), "symbol")
    ranked = (df.select("symbol", *[f for f in fields if f != "symbol"],
                        F.explode(offers).alias("_offer"))
              .withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= most))
    return ranked.agg(*[
        F.transform(F.sort_array(F.collect_list(F.when(
            (F.col("_offer.list") == name) & (F.col("_place") <= k),
            F.struct("_place", F.struct(*own).alias("_v"))))), lambda e: e["_v"]).alias(name)
        for name, (_, k, own, _) in specs.items()])


def _summary(df: DataFrame, run_ts, tag: str, change: str,
             domains: dict, zero_filled, lists: dict[str, tuple]) -> DataFrame:
    """Totals and all four distributions in one aggregate (one read, no
    shuffle); the top-k lists in one more read, attached as a scalar."""
    maps = domain_count_maps(df, domains, zero_filled)
    names = {"risk_category": "risk_distribution",
             "trading_signal": "signal_distribution",
             "anomaly_level": "anomaly_distribution",
             "recommendation": "recommendation_distribution"}
    base = df.agg(
        F.count(F.lit(1)).alias("total_symbols"),
        exact_sum("volume_usd").alias("total_volume_usd"),
        exact_avg(change).alias("average_price_change"),
        F.count_if(F.col("critical_alert")).alias("critical_alerts"),
        *[maps[d].alias(names[d]) for d in names],
    )
    tops = _ranked_lists(df, lists)
    tops = tops.select(F.struct(*tops.columns).alias("t")).select("t").scalar()
    return base.withColumn("_tops", tops).select(
        stamp(run_ts).alias("timestamp"), F.lit(tag).alias("data_source"), *base.columns,
        *[F.col("_tops").getField(name).alias(name) for name in lists])


def summary_a(df: DataFrame, run_ts=None, k: int = 5) -> DataFrame:
    chg = "price_change_percent"
    return _summary(df, run_ts, SOURCE_TAG_A, chg, LABELS_A, (), {
        "top_gainers": (chg, k, ["symbol", chg], True),
        "top_losers": (chg, k, ["symbol", chg], False),
        "highest_volume": ("volume_usd", k, ["symbol", "volume_usd"], True),
        "most_anomalous": ("overall_anomaly_score", k,
                           ["symbol", "overall_anomaly_score", "anomaly_level"], True),
    })


def summary_b(df: DataFrame, run_ts=None, k: int = 5) -> DataFrame:
    chg = "priceChangePercent"
    return _summary(df, run_ts, SOURCE_TAG_B, chg, LABELS_B, ZERO_FILLED_B, {
        "top_gainers": (chg, k, ["symbol", chg], True),
        "top_losers": (chg, k, ["symbol", chg], False),
    })


def flatten_summary(summary: DataFrame) -> DataFrame:
    """Scalars only: maps as 'LABEL:n' lists in label order, lists as symbols."""
    def dist(c: str) -> Column:
        return F.array_join(F.transform(
            F.sort_array(F.map_entries(F.col(c))),
            lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")

    def syms(c: str) -> Column:
        return F.array_join(F.transform(F.col(c), lambda s: s["symbol"]), ",")

    cols = [F.col("data_source"), F.col("total_symbols"),
            F.round("total_volume_usd", 0).alias("total_volume_usd"),
            F.round("average_price_change", 6).alias("average_price_change"),
            F.col("critical_alerts")]
    cols += [dist(c).alias(c) for c in summary.columns if c.endswith("_distribution")]
    cols += [syms(c).alias(c) for c in ("top_gainers", "top_losers", "highest_volume",
                                        "most_anomalous") if c in summary.columns]
    return summary.select(*cols)
