"""Profile B ("relative"): volume scored against the population median.

Right-closed bins, last-match-wins signal and recommendation rules, feed
(camelCase) column names, IEEE division for volatility.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickwise import rules as R
from tickwise.functions import (ieee_div, ladder, num, population_median, right_closed_bins,
                                signal_rules)
from tickwise.operators.cleaning import scored_metrics
from tickwise.schema import ANOMALY_LABELS_B, NUMERIC_FEED, RISK_LABELS_B
from tickwise.session import stored


def cast_relative(df: DataFrame) -> DataFrame:
    """Coerce the nine numeric feed fields in place (bad -> NULL)."""
    types = dict(df.dtypes)
    return df.withColumns({f: num(f, types.get(f) == "string") for f in NUMERIC_FEED})


def relative_filter_condition():
    c = F.col
    return (c("symbol").endswith(R.PAIR_SUFFIX) & (c("lastPrice") > 0)
            & (c("volume") > R.MIN_VOLUME_B) & (c("bidPrice") > 0)
            & (c("askPrice") > c("bidPrice")))


def filter_relative(df: DataFrame) -> DataFrame:
    """USDT pairs with positive prices, volume above 10,000, ask above bid.

    The suffix is tested before parsing (it reaches the scan); the parsed
    rows are observed, which keeps the numeric predicates from re-inlining
    the string parsing (see ``cast_feed``).
    """
    parsed = cast_relative(df.where(F.col("symbol").endswith(R.PAIR_SUFFIX)))
    if not parsed.isStreaming:
        parsed = parsed.observe(Observation(), F.count(F.lit(1)).alias("rows"))
    return parsed.where(relative_filter_condition())


def relative_indicators(df: DataFrame) -> DataFrame:
    c = F.col
    df = df.withColumns({
        "spread": c("askPrice") - c("bidPrice"),
        "volatility": ieee_div(c("highPrice") - c("lowPrice"), c("openPrice")),
        "volume_usd": c("volume") * c("lastPrice"),
        "momentum": c("priceChangePercent") / R.MOMENTUM_DIVISOR,
    })
    df = df.withColumn("spread_percent", F.try_divide(c("spread"), c("lastPrice")) * 100.0)
    m = c("momentum")
    w_vol, w_sp, w_mom = R.RISK_WEIGHTS_B
    df = df.withColumn("risk_score", c("volatility") * w_vol + c("spread_percent") * w_sp
                       + F.abs(m) * w_mom)
    r = c("risk_score")
    return df.withColumns({
        "risk_category": right_closed_bins(r, R.RISK_EDGES_B, RISK_LABELS_B),
        "trading_signal": ladder(signal_rules(m, r, R.SIGNAL_RULES_B), R.SIGNAL_DEFAULT,
                                 last_wins=True),
    })


def relative_anomalies(df: DataFrame, exact_median: bool = True) -> DataFrame:
    """Anomaly score uses the median volume of the rows in ``df`` itself.

    The exact median reads its one column of ``df`` in several passes and the
    scoring reads ``df`` once more, so ``df`` should come from a table, as
    ``score_relative`` provides. ``exact_median=False`` uses one sketch
    aggregate instead.
    """
    c = F.col
    med = population_median(df, "volume_usd", exact=exact_median)
    w_mom, w_vol, w_sp = R.ANOMALY_WEIGHTS_B
    df = df.withColumn(
        "anomaly_score",
        F.abs(c("momentum")) * w_mom + ieee_div(c("volume_usd"), med) * w_vol
        + c("spread_percent") * w_sp)
    df = df.withColumn("anomaly_level", right_closed_bins(c("anomaly_score"), R.ANOMALY_EDGES_B,
                                                          ANOMALY_LABELS_B))
    lvl, sig = c("anomaly_level"), c("trading_signal")
    top = ANOMALY_LABELS_B[-1]
    return df.withColumns({
        "critical_alert": F.coalesce(lvl.isin(*R.ALERT_LEVELS_B), F.lit(False)),
        "recommendation": ladder([
            (lvl == top, "AVOID"),
            (sig.isin(*R.BUY_SIGNALS) & lvl.isin(*R.CALM_LEVELS), "BUY_RECOMMENDED"),
            (sig.isin(*R.SELL_SIGNALS) & lvl.isin(*R.CALM_LEVELS), "SELL_RECOMMENDED"),
            (lvl.isin(*R.WATCH_LEVELS), "CAUTION"),
        ], "MONITOR", last_wins=True),
    })


def score_relative(raw: DataFrame, exact_median: bool = True,
                   observation: Observation | None = None) -> DataFrame:
    """Full profile B; with an ``observation`` the scored rows and critical
    alerts are counted on the way out."""
    base = relative_indicators(filter_relative(raw))
    if exact_median and not raw.isStreaming:
        # one reading of the input: the passes and the scoring use the written rows
        base = stored(base, "relative")
    scored = relative_anomalies(base, exact_median)
    if observation is None or scored.isStreaming:
        return scored
    return scored.observe(observation, *scored_metrics())
