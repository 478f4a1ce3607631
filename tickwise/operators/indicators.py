"""Profile A technical indicators (fixed thresholds, first match wins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise import rules as R
from tickwise.functions import ladder, signal_rules, steps_above, steps_below

BUY_SIGNALS = R.BUY_SIGNALS
SELL_SIGNALS = R.SELL_SIGNALS


def base_indicators(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "momentum": c("price_change_percent") / R.MOMENTUM_DIVISOR,
        "liquidity_score": F.try_divide(F.lit(1.0), c("spread_percent") + R.LIQUIDITY_EPSILON),
        "volatility_score": c("volatility") * R.VOLATILITY_SCALE,
    })


def add_indicators(df: DataFrame) -> DataFrame:
    c = F.col
    m, liq = c("momentum"), c("liquidity_score")
    w_vol, w_liq, w_mom = R.RISK_WEIGHTS_A
    df = base_indicators(df)
    df = df.withColumns({
        # positive and negative momentum both give |m| * scale
        "signal_strength": F.abs(m) * R.STRENGTH_SCALE,
        "trend_direction": ladder([(c("last_price") > c("open_price"), R.TREND_UP),
                                   (c("last_price") < c("open_price"), R.TREND_DOWN)],
                                  R.TREND_FLAT),
        "momentum_category": steps_above(m, R.MOMENTUM_STEPS, R.MOMENTUM_FLOOR),
        "liquidity_category": steps_above(liq, R.LIQUIDITY_STEPS, R.LIQUIDITY_FLOOR),
        # may go below zero: a liquidity score up to 1000 is rewarded, not clamped
        "risk_score": (c("volatility_score") * w_vol + (100.0 - liq) * w_liq
                       + F.abs(m) * 100.0 * w_mom) / 100.0,
    })
    r = c("risk_score")
    df = df.withColumns({
        "risk_category": steps_below(r, R.RISK_STEPS_A, R.RISK_CEILING_A),
        "trading_signal": ladder(signal_rules(m, r, R.SIGNAL_RULES_A), R.SIGNAL_DEFAULT),
    })
    sig, strength = c("trading_signal"), c("signal_strength")
    return df.withColumn(
        "signal_confidence",
        ladder([(sig.isin(*R.STRONG_SIGNALS), strength * (1.0 - r)),
                (sig.isin(*R.PLAIN_SIGNALS), strength * R.PLAIN_CONFIDENCE * (1.0 - r))],
               strength * R.HOLD_CONFIDENCE))
