import math

from pyspark.sql import functions as F

from tickwise.operators.aggregates import distributions_b
from tickwise.operators.relative import score_relative
from tickwise.sources.snapshots import rows_frame

from conftest import feed_row


def _one(spark, rows, symbol):
    return [r for r in score_relative(rows_frame(spark, rows)).collect() if r.symbol == symbol][0]


def _filler(n=4):
    return [feed_row(symbol=f"F{i}USDT", volume=20000 + i) for i in range(n)]


def test_last_wins_conflict_gives_buy(spark):
    # momentum 0.12, risk = 0.1525*0.4 + 0.01*0.3 + 0.12*0.3 = 0.1 -> BUY overwrites STRONG_BUY
    row = feed_row(symbol="XUSDT", priceChangePercent=12, volume=20000, lastPrice=100,
                   bidPrice=100, askPrice=100.01, openPrice=100, highPrice=110, lowPrice=94.75)
    r = _one(spark, [row, *_filler()], "XUSDT")
    assert abs(r.risk_score - 0.1) < 1e-6
    assert r.trading_signal == "BUY"


def test_last_wins_survivor_strong_buy(spark):
    row = feed_row(symbol="XUSDT", priceChangePercent=12, volume=20000, lastPrice=100,
                   bidPrice=100, askPrice=100.01, openPrice=100, highPrice=110, lowPrice=77.25)
    r = _one(spark, [row, *_filler()], "XUSDT")
    assert abs(r.risk_score - 0.17) < 1e-6
    assert r.trading_signal == "STRONG_BUY"


def test_zero_open_is_infinite_volatility(spark):
    row = feed_row(symbol="ZUSDT", openPrice=0, volume=20000)
    r = _one(spark, [row, *_filler()], "ZUSDT")
    assert r.volatility == math.inf
    assert r.risk_category == "VERY_HIGH"


def test_missing_momentum_defaults(spark):
    row = feed_row(symbol="NUSDT", priceChangePercent="NaN", volume=20000)
    r = _one(spark, [row, *_filler()], "NUSDT")
    assert r.risk_score is None and r.risk_category is None
    assert r.anomaly_level is None
    assert r.trading_signal == "HOLD"
    assert r.critical_alert is False
    assert r.recommendation == "MONITOR"


def test_median_relative_score(spark):
    rows = [feed_row(symbol=f"M{i}USDT", volume=v, priceChangePercent=0,
                     bidPrice=100, askPrice=100.0001)
            for i, v in enumerate([20000, 30000, 40000, 50000])]
    out = {r.symbol: r for r in score_relative(rows_frame(spark, rows)).collect()}
    # median volume_usd = 3.5e6; score ~ (v*100/3.5e6)*2
    assert abs(out["M0USDT"].anomaly_score - (2e6 / 3.5e6) * 2 - 0.0003) < 1e-6


def test_zero_filled_distribution_lists_unseen_labels(spark):
    df = score_relative(rows_frame(spark, _filler()))
    got = {(r.dimension, r.label): r.n for r in distributions_b(df).collect()}
    assert got[("anomaly_level", "CRITICAL")] == 0
    assert got[("risk_category", "VERY_HIGH")] == 0
    assert ("trading_signal", "BUY") not in got
    assert sum(n for (d, _), n in got.items() if d == "trading_signal") == 4


def test_approximate_median_path(spark):
    rows = [feed_row(symbol=f"M{i}USDT", volume=v) for i, v in enumerate([20000, 30000, 40000])]
    df = rows_frame(spark, rows)
    exact = {r.symbol: r.anomaly_score for r in score_relative(df).collect()}
    approx = {r.symbol: r.anomaly_score for r in score_relative(df, exact_median=False).collect()}
    # odd population: the sketch returns the middle value exactly
    assert approx == exact
