"""Counts, totals, distributions and top-k lists.

Every aggregate here is a partial (map-side) + final hash aggregate, so a
label or symbol that holds a third of all rows is combined inside each
task before the shuffle. Top-k lists plan as TakeOrderedAndProject:
k rows per task, merged once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.sums import exact_avg, exact_sum
from tickwise.operators.anomalies import add_anomalies
from tickwise.operators.cleaning import cast_feed, enrich, final_rows, valid_rows
from tickwise.operators.indicators import add_indicators
from tickwise.schema import LABELS_A, LABELS_B, ZERO_FILLED_B

DIMENSIONS_A = list(LABELS_A)


def stage_counts(raw: DataFrame) -> DataFrame:
    """Rows loaded / valid / final / critical for profile A in one scan.

    All scoring expressions are row-local, so they are evaluated on every
    row and the stage predicates become conditional counts of one aggregate
    instead of one job per stage.
    """
    scored = raw.transform(cast_feed).transform(enrich).transform(add_indicators) \
        .transform(add_anomalies)
    valid = valid_rows()
    final = valid & final_rows()
    return scored.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(valid).alias("valid"),
        F.count_if(final).alias("final"),
        F.count_if(final & F.col("critical_alert")).alias("critical"),
    )


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, label, n) for several label columns: one scan, one shuffle.

    Missing labels are dropped, as a value count does.
    """
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot(
        [], list(columns), "dimension", "label")
    return (long.where(F.col("label").isNotNull())
            .groupBy("dimension", "label").agg(F.count(F.lit(1)).alias("n")))


def domain_counts(df: DataFrame, domains: dict[str, Sequence[str]],
                  zero_filled: Sequence[str] = ()) -> DataFrame:
    """(dimension, label, n) over known label domains in ONE scan.

    One global aggregate of conditional counts: each task emits a single
    partial row, so there is no shuffle by label and no skew however the
    labels are distributed. Columns in ``zero_filled`` list every label of
    their domain (as a categorical value count does); the others only
    labels that occur.
    """
    pairs = [(d, lab) for d, labels in domains.items() for lab in labels]
    row = df.agg(*[F.count_if(F.col(d) == lab).alias(f"{d}={lab}") for d, lab in pairs])
    entries = F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(lab).alias("label"),
                                 F.col(f"`{d}={lab}`").alias("n")) for d, lab in pairs])
    long = row.select(F.inline(entries))
    return long.where((F.col("n") > 0) | F.col("dimension").isin(*zero_filled)) \
        if zero_filled else long.where(F.col("n") > 0)


def domain_count_maps(df: DataFrame, domains: dict[str, Sequence[str]],
                      zero_filled: Sequence[str] = ()) -> dict[str, Column]:
    """label -> count map per dimension as aggregate expressions (one scan)."""
    out = {}
    for d, labels in domains.items():
        m = F.create_map(*[x for lab in labels
                           for x in (F.lit(lab), F.count_if(F.col(d) == lab))])
        out[d] = m if d in zero_filled else F.map_filter(m, lambda k, v: v > 0)
    return out


def distributions_a(df: DataFrame) -> DataFrame:
    return domain_counts(df, LABELS_A)


def distributions_b(df: DataFrame) -> DataFrame:
    return domain_counts(df, LABELS_B, ZERO_FILLED_B)


def totals(df: DataFrame, volume: str = "volume_usd",
           change: str = "price_change_percent", exact: bool = False) -> DataFrame:
    """Row total, summed volume, mean change (missing ignored), the same to the
    last bit for every order of the rows.

    ``exact=False`` rounds them (sum to units, mean to 6 places), for comparison
    with engines that add doubles in some order.
    """
    tv, ac = exact_sum(volume), exact_avg(change)
    if not exact:
        tv, ac = F.round(tv, 0), F.round(ac, 6)
    return df.agg(F.count(F.lit(1)).alias("total_symbols"),
                  tv.alias("total_volume_usd"), ac.alias("average_price_change"))


def alert_count(df: DataFrame, flag: str = "critical_alert") -> DataFrame:
    return df.agg(F.count_if(F.col(flag)).alias("critical_alerts"))


def filter_options(df: DataFrame, columns: Sequence[str] = ("risk_category",
                                                            "trading_signal",
                                                            "anomaly_level")) -> DataFrame:
    """Distinct labels per column (the choices offered by a filter)."""
    cols = [c for c in columns if c in df.columns]
    long = df.select(*[F.col(c).cast("string") for c in cols]).unpivot(
        [], cols, "dimension", "label")
    return long.where(F.col("label").isNotNull()).distinct()


def top_k(df: DataFrame, by: str, k: int, columns: Sequence[str | Column],
          largest: bool = True, tie: str = "symbol") -> DataFrame:
    """k rows with the largest (or smallest) ``by``; ties broken by ``tie``.

    Rows with a missing ``by`` come after all others.
    """
    key = missing_last(df, by)
    order = key.desc_nulls_last() if largest else key.asc_nulls_last()
    return df.orderBy(order, F.asc(tie)).limit(k).select(*columns)


def missing_last(df: DataFrame, by: str) -> Column:
    """``by`` with NaN as NULL, to be ordered with NULLs last."""
    value = F.col(by)
    if df.schema[by].dataType.typeName() in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value
