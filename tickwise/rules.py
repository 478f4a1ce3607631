"""Fixed values of the scoring rules.

Every threshold, weight and label here must equal the reference's for the
results to match. Rule lists are in rule order: the first matching rule
decides, except where a list says later rules overwrite earlier ones.
The operators compile these tables into CASE expressions.
"""

PAIR_SUFFIX = "USDT"

# ------------------------------------------------------------ profile A
# cleaning
MIN_VOLUME_USD_A = 10000.0
# data quality: (label, spread_percent below, volatility below); else LOW
QUALITY_RULES = [("HIGH", 5.0, 1.0), ("MEDIUM", 10.0, 2.0)]
QUALITY_DEFAULT = "LOW"

# indicators
MOMENTUM_DIVISOR = 100.0
LIQUIDITY_EPSILON = 0.001
VOLATILITY_SCALE = 100.0
STRENGTH_SCALE = 1000.0
TREND_UP, TREND_DOWN, TREND_FLAT = "BULLISH", "BEARISH", "NEUTRAL"
# momentum category: (momentum above, label); else VERY_STRONG_DOWN
MOMENTUM_STEPS = [(0.15, "VERY_STRONG_UP"), (0.05, "STRONG_UP"), (0.01, "WEAK_UP"),
                  (-0.01, "NEUTRAL"), (-0.05, "WEAK_DOWN"), (-0.15, "STRONG_DOWN")]
MOMENTUM_FLOOR = "VERY_STRONG_DOWN"
# liquidity category: (liquidity score above, label); else VERY_LOW
LIQUIDITY_STEPS = [(100.0, "VERY_HIGH"), (50.0, "HIGH"), (20.0, "MEDIUM"), (5.0, "LOW")]
LIQUIDITY_FLOOR = "VERY_LOW"
# risk score = (volatility score * w0 + (100 - liquidity score) * w1
#               + |momentum| * 100 * w2) / 100
RISK_WEIGHTS_A = (0.4, 0.3, 0.3)
# risk category: (risk below, label); else VERY_HIGH
RISK_STEPS_A = [(0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH")]
RISK_CEILING_A = "VERY_HIGH"
# trading signal: (label, momentum threshold, risk below). A positive
# threshold means momentum above it, a negative one momentum below it.
SIGNAL_RULES_A = [("STRONG_BUY", 0.1, 0.7), ("BUY", 0.03, 0.5),
                  ("STRONG_SELL", -0.1, 0.7), ("SELL", -0.03, 0.5)]
SIGNAL_DEFAULT = "HOLD"
STRONG_SIGNALS = ["STRONG_BUY", "STRONG_SELL"]
PLAIN_SIGNALS = ["BUY", "SELL"]
BUY_SIGNALS = ["STRONG_BUY", "BUY"]
SELL_SIGNALS = ["STRONG_SELL", "SELL"]
PLAIN_CONFIDENCE = 0.7      # strength * 0.7 * (1 - risk) for BUY / SELL
HOLD_CONFIDENCE = 0.3       # strength * 0.3 otherwise

# anomalies
# price score: (|momentum| above, score); else 1
PRICE_SCORE_STEPS = [(0.2, 10.0), (0.15, 8.0), (0.1, 6.0), (0.05, 4.0)]
# volume score: (volume_usd above, score), then (volume_usd below, score); else 1
VOLUME_SCORE_STEPS = [(1e9, 9.0), (5e8, 7.0), (1e8, 5.0), (1e7, 3.0)]
VOLUME_SCORE_LOW = (5e4, 6.0)
# spread score: (spread_percent above, score), then (below, score); else 1
SPREAD_SCORE_STEPS = [(5.0, 8.0), (2.0, 6.0), (1.0, 4.0)]
SPREAD_SCORE_LOW = (0.01, 7.0)
BASE_SCORE = 1.0
# overall = price * w0 + volume * w1 + spread * w2
OVERALL_WEIGHTS = (0.4, 0.35, 0.25)
# anomaly level: (overall above, label); else NORMAL
LEVEL_STEPS_A = [(8.0, "CRITICAL"), (6.0, "HIGH"), (4.0, "MODERATE"), (2.0, "LOW")]
LEVEL_FLOOR_A = "NORMAL"
# pump and dump: (label, |momentum| above, volume score above or None); else MINIMAL
PUMP_RULES = [("VERY_HIGH", 0.2, 5.0), ("HIGH", 0.15, 3.0), ("MEDIUM", 0.1, 2.0),
              ("LOW", 0.05, None)]
PUMP_DEFAULT = "MINIMAL"
# arbitrage: (spread_percent above, label); else NONE
ARBITRAGE_STEPS = [(3.0, "EXCELLENT"), (1.5, "GOOD"), (0.8, "FAIR"), (0.3, "POOR")]
ARBITRAGE_FLOOR = "NONE"
# wash trading: (label, volume score above, price score below); else MINIMAL
WASH_RULES = [("HIGH", 7.0, 3.0), ("MEDIUM", 5.0, 4.0), ("LOW", 3.0, 2.0)]
WASH_DEFAULT = "MINIMAL"
# recommendation, first match:
#   level CRITICAL -> AVOID; pump in PUMP_ALERT -> EXTREME_CAUTION;
#   wash HIGH -> INVESTIGATE; buy signal and calm level -> BUY_RECOMMENDED;
#   sell signal and calm level -> SELL_RECOMMENDED; arbitrage in
#   GOOD_ARBITRAGE -> ARBITRAGE_OPPORTUNITY; level in WATCH_LEVELS -> CAUTION;
#   else MONITOR
PUMP_ALERT = ["VERY_HIGH", "HIGH"]
CALM_LEVELS = ["NORMAL", "LOW"]
GOOD_ARBITRAGE = ["EXCELLENT", "GOOD"]
WATCH_LEVELS = ["HIGH", "MODERATE"]
# critical alert: level CRITICAL or pump VERY_HIGH or wash HIGH

# ------------------------------------------------------------ profile B
MIN_VOLUME_B = 10000.0
# risk score = volatility * w0 + spread_percent * w1 + |momentum| * w2
RISK_WEIGHTS_B = (0.4, 0.3, 0.3)
RISK_EDGES_B = [0.05, 0.15, 0.3]                   # right-closed bins
# trading signal: same form as profile A, applied in order, later overwrites
SIGNAL_RULES_B = [("STRONG_BUY", 0.1, 0.2), ("BUY", 0.03, 0.15),
                  ("STRONG_SELL", -0.1, 0.2), ("SELL", -0.03, 0.15)]
# anomaly score = |momentum| * w0 + (volume_usd / median) * w1 + spread_percent * w2
ANOMALY_WEIGHTS_B = (5.0, 2.0, 3.0)
ANOMALY_EDGES_B = [2.0, 5.0, 8.0, 12.0]            # right-closed bins
ALERT_LEVELS_B = ["HIGH", "CRITICAL"]
# recommendation, applied in order, later overwrites (default MONITOR):
#   level CRITICAL -> AVOID; buy signal and calm level -> BUY_RECOMMENDED;
#   sell signal and calm level -> SELL_RECOMMENDED; level in WATCH_LEVELS -> CAUTION
