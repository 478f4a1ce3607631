import datetime as dt

import pytest

from tickwise.operators.anomalies import add_anomalies
from tickwise.operators.cleaning import clean, score_absolute
from tickwise.operators.indicators import add_indicators
from tickwise.sources.snapshots import rows_frame

from conftest import feed_row

TS = dt.datetime(2024, 1, 1)


def test_cleaning_reference_row(spark):
    row = feed_row(symbol="BTCUSDT", lastPrice=45000, priceChangePercent=2.5, volume=1000,
                   bidPrice=44999, askPrice=45001, openPrice=44000, highPrice=45500,
                   lowPrice=43500, quoteVolume=45000000)
    out = clean(rows_frame(spark, [row]), TS).collect()
    assert len(out) == 1
    r = out[0]
    assert r.spread == 2.0
    assert r.spread_percent == pytest.approx(0.0044444, rel=1e-4)
    assert r.price_range == 2000.0
    assert r.volatility == pytest.approx(0.0454545, rel=1e-5)
    assert r.volume_usd == 45_000_000.0
    assert r.data_quality == "HIGH"
    assert r.processing_timestamp == TS


def test_indicators_reference_row(spark):
    df = spark.createDataFrame(
        [("BTCUSDT", 45000.0, 2.5, 1000.0, 0.1, 0.05, 44000.0)],
        "symbol string, last_price double, price_change_percent double, volume double, "
        "spread_percent double, volatility double, open_price double")
    r = add_indicators(df).collect()[0]
    assert r.momentum == 0.025
    assert r.liquidity_score == pytest.approx(9.90099, rel=1e-5)
    assert r.liquidity_category == "LOW"
    assert r.risk_score == pytest.approx(0.2978, abs=1e-4)
    assert r.risk_category == "LOW"
    assert r.trend_direction == "BULLISH"
    assert r.momentum_category == "WEAK_UP"
    assert r.trading_signal == "HOLD"
    assert r.signal_confidence == pytest.approx(7.5)


def test_anomalies_reference_row(spark):
    df = spark.createDataFrame([("TESTUSDT", 0.25, 2e9, 0.1, "STRONG_BUY")],
                               "symbol string, momentum double, volume_usd double, "
                               "spread_percent double, trading_signal string")
    r = add_anomalies(df).collect()[0]
    assert (r.price_anomaly_score, r.volume_anomaly_score, r.spread_anomaly_score) == (10, 9, 1)
    assert r.overall_anomaly_score == pytest.approx(7.4)
    assert r.anomaly_level == "HIGH"
    assert r.pump_dump_risk == "VERY_HIGH"
    assert r.arbitrage_opportunity == "NONE"
    assert r.wash_trading_risk == "MINIMAL"
    assert r.recommendation == "EXTREME_CAUTION"
    assert r.critical_alert is True


@pytest.mark.parametrize("m,expect", [(0.15, "STRONG_UP"), (0.05, "WEAK_UP"), (0.01, "NEUTRAL"),
                                      (-0.01, "WEAK_DOWN"), (-0.05, "STRONG_DOWN"),
                                      (-0.15, "VERY_STRONG_DOWN"), (0.1500001, "VERY_STRONG_UP")])
def test_momentum_thresholds_are_strict(spark, m, expect):
    df = spark.createDataFrame([("X", 1.0, m * 100, 1.0, 0.1, 0.05, 1.0)],
                               "symbol string, last_price double, price_change_percent double, "
                               "volume double, spread_percent double, volatility double, "
                               "open_price double")
    assert add_indicators(df).collect()[0].momentum_category == expect


@pytest.mark.parametrize("vusd,score", [(1e9, 7.0), (1e9 + 1, 9.0), (5e4, 1.0), (49999.0, 6.0),
                                        (1e7, 1.0)])
def test_volume_score_edges(spark, vusd, score):
    df = spark.createDataFrame([("X", 0.0, vusd, 0.5, "HOLD")],
                               "symbol string, momentum double, volume_usd double, "
                               "spread_percent double, trading_signal string")
    assert add_anomalies(df).collect()[0].volume_anomaly_score == score


def test_negative_risk_is_not_clamped(spark):
    df = spark.createDataFrame([("X", 1.0, 5.0, 1.0, 0.001, 0.01, 0.9)],
                               "symbol string, last_price double, price_change_percent double, "
                               "volume double, spread_percent double, volatility double, "
                               "open_price double")
    r = add_indicators(df).collect()[0]
    assert r.risk_score < 0
    assert r.risk_category == "LOW"
    assert r.trading_signal == "BUY"
    assert r.signal_confidence > r.signal_strength * 0.7


def test_missing_momentum_falls_through(spark):
    row = feed_row(priceChangePercent=None, volume=10_000_000)
    r = score_absolute(rows_frame(spark, [row]), TS).collect()[0]
    assert r.momentum is None and r.signal_strength is None
    assert r.momentum_category == "VERY_STRONG_DOWN"
    assert r.risk_category == "VERY_HIGH"
    assert r.trading_signal == "HOLD"
    assert r.signal_confidence is None
    assert r.price_anomaly_score == 1.0
    assert r.pump_dump_risk == "MINIMAL"


def test_invalid_rows_dropped(spark):
    rows = [feed_row(symbol="A1USDT", lastPrice="n/a"),
            feed_row(symbol="A2USDT", askPrice="99.99"),        # ask == bid
            feed_row(symbol="A3USDT", openPrice="0"),
            feed_row(symbol="A4USDT", highPrice="1", lowPrice="2"),
            feed_row(symbol="A5BTC"),
            feed_row(symbol="A6USDT", volume="1"),               # volume_usd 100 <= 10000
            feed_row(symbol="A7USDT")]
    kept = [r.symbol for r in clean(rows_frame(spark, rows), TS).collect()]
    assert kept == ["A7USDT"]


def test_no_python_udf_in_plan(spark):
    df = score_absolute(rows_frame(spark, [feed_row()]), TS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("sp,score,arb", [
    (5.0, 6.0, "EXCELLENT"), (5.0000001, 8.0, "EXCELLENT"), (3.0, 6.0, "GOOD"),
    (2.0, 4.0, "GOOD"), (1.5, 4.0, "FAIR"), (1.0, 1.0, "FAIR"), (0.8, 1.0, "POOR"),
    (0.3, 1.0, "NONE"), (0.01, 1.0, "NONE"), (0.0099, 7.0, "NONE")])
def test_spread_thresholds_exactly(spark, sp, score, arb):
    df = spark.createDataFrame([("X", 0.0, 1e6, sp, "HOLD")],
                               "symbol string, momentum double, volume_usd double, "
                               "spread_percent double, trading_signal string")
    r = add_anomalies(df).collect()[0]
    assert (r.spread_anomaly_score, r.arbitrage_opportunity) == (score, arb)


@pytest.mark.parametrize("overall_parts", [
    # (price, volume, spread) scores; overall = p*0.4 + v*0.35 + s*0.25
    (10.0, 9.0, 8.0),       # 9.15 -> CRITICAL
    (4.0, 6.0, 1.0),        # 3.95 -> LOW
    (1.0, 1.0, 1.0),        # 1.0  -> NORMAL
])
def test_anomaly_level_from_scores(spark, overall_parts):
    p, v, s = overall_parts
    mom = {10.0: 0.25, 4.0: 0.06, 1.0: 0.0}[p]
    vusd = {9.0: 2e9, 6.0: 1e4, 1.0: 1e6}[v]
    sp = {8.0: 6.0, 1.0: 0.5}[s]
    df = spark.createDataFrame([("X", mom, vusd, sp, "HOLD")],
                               "symbol string, momentum double, volume_usd double, "
                               "spread_percent double, trading_signal string")
    r = add_anomalies(df).collect()[0]
    assert (r.price_anomaly_score, r.volume_anomaly_score, r.spread_anomaly_score) == (p, v, s)
    expect = p * 0.4 + v * 0.35 + s * 0.25
    assert r.overall_anomaly_score == expect
    want = ("CRITICAL" if expect > 8 else "HIGH" if expect > 6 else "MODERATE" if expect > 4
            else "LOW" if expect > 2 else "NORMAL")
    assert r.anomaly_level == want
