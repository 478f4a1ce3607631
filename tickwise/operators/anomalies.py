"""Profile A anomaly scoring, manipulation patterns and recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise import rules as R
from tickwise.functions import ladder, steps_above

CALM_LEVELS = R.CALM_LEVELS


def add_anomalies(df: DataFrame) -> DataFrame:
    c = F.col
    am, vusd, sp = F.abs(c("momentum")), c("volume_usd"), c("spread_percent")
    vol_low, vol_low_score = R.VOLUME_SCORE_LOW
    sp_low, sp_low_score = R.SPREAD_SCORE_LOW
    df = df.withColumns({
        "price_anomaly_score": steps_above(am, R.PRICE_SCORE_STEPS, R.BASE_SCORE),
        "volume_anomaly_score": ladder([(vusd > t, s) for t, s in R.VOLUME_SCORE_STEPS]
                                       + [(vusd < vol_low, vol_low_score)], R.BASE_SCORE),
        "spread_anomaly_score": ladder([(sp > t, s) for t, s in R.SPREAD_SCORE_STEPS]
                                       + [(sp < sp_low, sp_low_score)], R.BASE_SCORE),
        "arbitrage_opportunity": steps_above(sp, R.ARBITRAGE_STEPS, R.ARBITRAGE_FLOOR),
    })
    ps, vs = c("price_anomaly_score"), c("volume_anomaly_score")
    w_p, w_v, w_s = R.OVERALL_WEIGHTS
    df = df.withColumns({
        "overall_anomaly_score": ps * w_p + vs * w_v + c("spread_anomaly_score") * w_s,
        "pump_dump_risk": ladder(
            [(((am > m_min) & (vs > v_min)) if v_min is not None else (am > m_min), label)
             for label, m_min, v_min in R.PUMP_RULES], R.PUMP_DEFAULT),
        "wash_trading_risk": ladder(
            [((vs > v_min) & (ps < p_max), label) for label, v_min, p_max in R.WASH_RULES],
            R.WASH_DEFAULT),
    })
    df = df.withColumn("anomaly_level", steps_above(c("overall_anomaly_score"),
                                                    R.LEVEL_STEPS_A, R.LEVEL_FLOOR_A))
    lvl, pump, wash = c("anomaly_level"), c("pump_dump_risk"), c("wash_trading_risk")
    sig = c("trading_signal")
    top_level = R.LEVEL_STEPS_A[0][1]
    top_pump = R.PUMP_RULES[0][0]
    top_wash = R.WASH_RULES[0][0]
    return df.withColumns({
        "recommendation": ladder([
            (lvl == top_level, "AVOID"),
            (pump.isin(*R.PUMP_ALERT), "EXTREME_CAUTION"),
            (wash == top_wash, "INVESTIGATE"),
            (sig.isin(*R.BUY_SIGNALS) & lvl.isin(*R.CALM_LEVELS), "BUY_RECOMMENDED"),
            (sig.isin(*R.SELL_SIGNALS) & lvl.isin(*R.CALM_LEVELS), "SELL_RECOMMENDED"),
            (c("arbitrage_opportunity").isin(*R.GOOD_ARBITRAGE), "ARBITRAGE_OPPORTUNITY"),
            (lvl.isin(*R.WATCH_LEVELS), "CAUTION"),
        ], "MONITOR"),
        "critical_alert": F.coalesce((lvl == top_level) | (pump == top_pump)
                                     | (wash == top_wash), F.lit(False)),
    })
