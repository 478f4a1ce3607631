"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

One shared CTE chain rebuilds the ticker from ``part`` + ``lineitem`` and runs
both scoring profiles with the same evaluation order as the DataFrame code;
each query key adds a tail. Literals are written as doubles (``0.4e0``)
because a bare ``0.4`` is DECIMAL in SQL and would change the arithmetic.

Fixed values: the thresholds, weights, labels and message texts below are those
of ``rules.py`` and ``schema.py`` and must equal them.
"""

from __future__ import annotations

from tickwise.sources.fixture import SPREAD_BY_SIZE, VOLATILITY_SPECIAL, VOLUME_MULT


def _d(x: float) -> str:
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


def _lookup(key: str, values: list[float]) -> str:
    arms = " ".join(f"WHEN {i} THEN {_d(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE {key} {arms} ELSE {_d(values[-1])} END"


def _num(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '[0-9.][dDfF]\\s*$|^\\s*[+-]?0[xX]') "
            f"OR isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL "
            f"ELSE TRY_CAST({x} AS DOUBLE) END")


def _case(rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {default} END"


def _bins(x: str, edges: list[float], labels: list[str]) -> str:
    bounds = ["'-inf'::DOUBLE", *[_d(e) for e in edges], "'inf'::DOUBLE"]
    rules = [(f"{x} > {lo} AND {x} <= {hi}", f"'{lab}'")
             for lo, hi, lab in zip(bounds[:-1], bounds[1:], labels)]
    return _case(rules, "NULL")


FEED = ["lastPrice", "priceChangePercent", "volume", "bidPrice", "askPrice",
        "openPrice", "highPrice", "lowPrice", "quoteVolume"]
SNAKE = ["last_price", "price_change_percent", "volume", "bid_price", "ask_price",
         "open_price", "high_price", "low_price", "quote_volume"]

_V = VOLATILITY_SPECIAL
CTES = f"""
qty AS (SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_partkey),
fx0 AS (SELECT p.p_partkey AS k, p.p_size AS z, p.p_retailprice AS last, COALESCE(qty.q, 0) AS q
        FROM part p LEFT JOIN qty ON p.p_partkey = qty.l_partkey),
fx1 AS (SELECT k, q, last,
          CAST((q * 7 + k * 13) % 601 - 300 AS DOUBLE) / 10e0 AS pct,
          {_lookup("z % 11", SPREAD_BY_SIZE)} AS sp,
          CASE (q + k) % 10 WHEN 0 THEN {_d(_V[0])} WHEN 1 THEN {_d(_V[1])} WHEN 2 THEN {_d(_V[2])}
               ELSE CAST((q + k) % 10 AS DOUBLE) / 100e0 END AS v,
          {_lookup("k % 9", VOLUME_MULT)} AS vm
        FROM fx0),
fx2 AS (SELECT *, last / (1e0 + pct / 100e0) AS op FROM fx1),
raw AS (SELECT
          'S' || CAST(k AS VARCHAR) || CASE WHEN k % 5 = 0 THEN 'BTC' ELSE 'USDT' END AS symbol,
          CASE WHEN k % 97 = 0 THEN 'n/a' ELSE CAST(last AS VARCHAR) END AS lastPrice,
          CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(pct AS VARCHAR) END AS priceChangePercent,
          CAST(CAST(q AS DOUBLE) * vm AS VARCHAR) AS volume,
          CAST(last * (1e0 - sp / 200e0) AS VARCHAR) AS bidPrice,
          CASE WHEN k % 83 = 0 THEN CAST(last * (1e0 - sp / 200e0) AS VARCHAR)
               ELSE CAST(last * (1e0 + sp / 200e0) AS VARCHAR) END AS askPrice,
          CAST(op AS VARCHAR) AS openPrice,
          CAST(greatest(op, last) * (1e0 + v / 2e0) AS VARCHAR) AS highPrice,
          CAST(least(op, last) * (1e0 - v / 2e0) AS VARCHAR) AS lowPrice,
          CAST(CAST(q AS DOUBLE) * last AS VARCHAR) AS quoteVolume
        FROM fx2),
a_cast AS (SELECT symbol, {", ".join(f"{_num(f)} AS {s}" for f, s in zip(FEED, SNAKE))} FROM raw),
a_valid AS (SELECT * FROM a_cast WHERE last_price > 0 AND volume > 0 AND bid_price > 0
            AND ask_price > bid_price AND open_price > 0 AND high_price >= low_price),
a_e0 AS (SELECT *, ask_price - bid_price AS spread, high_price - low_price AS price_range,
                volume * last_price AS volume_usd FROM a_valid),
a_e1 AS (SELECT *, (spread / last_price) * 100e0 AS spread_percent,
                price_range / open_price AS volatility FROM a_e0),
a_enr AS (SELECT *, {_case([("spread_percent < 5e0 AND volatility < 1e0", "'HIGH'"),
                            ("spread_percent < 10e0 AND volatility < 2e0", "'MEDIUM'")], "'LOW'")}
                 AS data_quality FROM a_e1),
a_final AS (SELECT * FROM a_enr WHERE symbol LIKE '%USDT' AND data_quality IN ('HIGH', 'MEDIUM')
            AND volume_usd > 10000e0),
a_i0 AS (SELECT *, price_change_percent / 100e0 AS momentum,
                1e0 / (spread_percent + 0.001e0) AS liquidity_score,
                volatility * 100e0 AS volatility_score FROM a_final),
a_i1 AS (SELECT *, abs(momentum) * 1000e0 AS signal_strength,
          {_case([("last_price > open_price", "'BULLISH'"), ("last_price < open_price", "'BEARISH'")], "'NEUTRAL'")} AS trend_direction,
          {_case([("momentum > 0.15e0", "'VERY_STRONG_UP'"), ("momentum > 0.05e0", "'STRONG_UP'"),
                  ("momentum > 0.01e0", "'WEAK_UP'"), ("momentum > -0.01e0", "'NEUTRAL'"),
                  ("momentum > -0.05e0", "'WEAK_DOWN'"), ("momentum > -0.15e0", "'STRONG_DOWN'")],
                 "'VERY_STRONG_DOWN'")} AS momentum_category,
          {_case([("liquidity_score > 100e0", "'VERY_HIGH'"), ("liquidity_score > 50e0", "'HIGH'"),
                  ("liquidity_score > 20e0", "'MEDIUM'"), ("liquidity_score > 5e0", "'LOW'")],
                 "'VERY_LOW'")} AS liquidity_category,
          (volatility_score * 0.4e0 + (100e0 - liquidity_score) * 0.3e0
           + abs(momentum) * 100e0 * 0.3e0) / 100e0 AS risk_score
        FROM a_i0),
a_i2 AS (SELECT *,
          {_case([("risk_score < 0.3e0", "'LOW'"), ("risk_score < 0.6e0", "'MEDIUM'"),
                  ("risk_score < 0.8e0", "'HIGH'")], "'VERY_HIGH'")} AS risk_category,
          {_case([("momentum > 0.1e0 AND risk_score < 0.7e0", "'STRONG_BUY'"),
                  ("momentum > 0.03e0 AND risk_score < 0.5e0", "'BUY'"),
                  ("momentum < -0.1e0 AND risk_score < 0.7e0", "'STRONG_SELL'"),
                  ("momentum < -0.03e0 AND risk_score < 0.5e0", "'SELL'")], "'HOLD'")} AS trading_signal
        FROM a_i1),
a_ind AS (SELECT *,
          {_case([("trading_signal IN ('STRONG_BUY', 'STRONG_SELL')", "signal_strength * (1e0 - risk_score)"),
                  ("trading_signal IN ('BUY', 'SELL')", "signal_strength * 0.7e0 * (1e0 - risk_score)")],
                 "signal_strength * 0.3e0")} AS signal_confidence
        FROM a_i2),
a_n0 AS (SELECT *,
          {_case([("abs(momentum) > 0.2e0", "10e0"), ("abs(momentum) > 0.15e0", "8e0"),
                  ("abs(momentum) > 0.1e0", "6e0"), ("abs(momentum) > 0.05e0", "4e0")], "1e0")} AS price_anomaly_score,
          {_case([("volume_usd > 1e9", "9e0"), ("volume_usd > 5e8", "7e0"), ("volume_usd > 1e8", "5e0"),
                  ("volume_usd > 1e7", "3e0"), ("volume_usd < 5e4", "6e0")], "1e0")} AS volume_anomaly_score,
          {_case([("spread_percent > 5e0", "8e0"), ("spread_percent > 2e0", "6e0"),
                  ("spread_percent > 1e0", "4e0"), ("spread_percent < 0.01e0", "7e0")], "1e0")} AS spread_anomaly_score,
          {_case([("spread_percent > 3e0", "'EXCELLENT'"), ("spread_percent > 1.5e0", "'GOOD'"),
                  ("spread_percent > 0.8e0", "'FAIR'"), ("spread_percent > 0.3e0", "'POOR'")], "'NONE'")} AS arbitrage_opportunity
        FROM a_ind),
a_n1 AS (SELECT *,
          price_anomaly_score * 0.4e0 + volume_anomaly_score * 0.35e0
            + spread_anomaly_score * 0.25e0 AS overall_anomaly_score,
          {_case([("abs(momentum) > 0.2e0 AND volume_anomaly_score > 5e0", "'VERY_HIGH'"),
                  ("abs(momentum) > 0.15e0 AND volume_anomaly_score > 3e0", "'HIGH'"),
                  ("abs(momentum) > 0.1e0 AND volume_anomaly_score > 2e0", "'MEDIUM'"),
                  ("abs(momentum) > 0.05e0", "'LOW'")], "'MINIMAL'")} AS pump_dump_risk,
          {_case([("volume_anomaly_score > 7e0 AND price_anomaly_score < 3e0", "'HIGH'"),
                  ("volume_anomaly_score > 5e0 AND price_anomaly_score < 4e0", "'MEDIUM'"),
                  ("volume_anomaly_score > 3e0 AND price_anomaly_score < 2e0", "'LOW'")], "'MINIMAL'")} AS wash_trading_risk
        FROM a_n0),
a_n2 AS (SELECT *,
          {_case([("overall_anomaly_score > 8e0", "'CRITICAL'"), ("overall_anomaly_score > 6e0", "'HIGH'"),
                  ("overall_anomaly_score > 4e0", "'MODERATE'"), ("overall_anomaly_score > 2e0", "'LOW'")],
                 "'NORMAL'")} AS anomaly_level
        FROM a_n1),
a_all AS (SELECT *,
          {_case([("anomaly_level = 'CRITICAL'", "'AVOID'"),
                  ("pump_dump_risk IN ('VERY_HIGH', 'HIGH')", "'EXTREME_CAUTION'"),
                  ("wash_trading_risk = 'HIGH'", "'INVESTIGATE'"),
                  ("trading_signal IN ('STRONG_BUY', 'BUY') AND anomaly_level IN ('NORMAL', 'LOW')", "'BUY_RECOMMENDED'"),
                  ("trading_signal IN ('STRONG_SELL', 'SELL') AND anomaly_level IN ('NORMAL', 'LOW')", "'SELL_RECOMMENDED'"),
                  ("arbitrage_opportunity IN ('EXCELLENT', 'GOOD')", "'ARBITRAGE_OPPORTUNITY'"),
                  ("anomaly_level IN ('HIGH', 'MODERATE')", "'CAUTION'")], "'MONITOR'")} AS recommendation,
          COALESCE(anomaly_level = 'CRITICAL' OR pump_dump_risk = 'VERY_HIGH'
                   OR wash_trading_risk = 'HIGH', false) AS critical_alert
        FROM a_n2),
b_cast AS (SELECT symbol, {", ".join(f"{_num(f)} AS {f}" for f in FEED)} FROM raw),
b_f AS (SELECT * FROM b_cast WHERE symbol LIKE '%USDT' AND lastPrice > 0 AND volume > 10000e0
        AND bidPrice > 0 AND askPrice > bidPrice),
b_i0 AS (SELECT *, askPrice - bidPrice AS spread,
          CASE WHEN openPrice = 0 THEN CASE WHEN highPrice - lowPrice > 0 THEN 'inf'::DOUBLE
                                            WHEN highPrice - lowPrice < 0 THEN '-inf'::DOUBLE END
               ELSE (highPrice - lowPrice) / openPrice END AS volatility,
          volume * lastPrice AS volume_usd, priceChangePercent / 100e0 AS momentum
        FROM b_f),
b_i1 AS (SELECT *, (spread / lastPrice) * 100e0 AS spread_percent FROM b_i0),
b_i2 AS (SELECT *, volatility * 0.4e0 + spread_percent * 0.3e0 + abs(momentum) * 0.3e0 AS risk_score FROM b_i1),
b_ind AS (SELECT *,
          {_bins("risk_score", [0.05, 0.15, 0.3], ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"])} AS risk_category,
          {_case([("momentum < -0.03e0 AND risk_score < 0.15e0", "'SELL'"),
                  ("momentum < -0.1e0 AND risk_score < 0.2e0", "'STRONG_SELL'"),
                  ("momentum > 0.03e0 AND risk_score < 0.15e0", "'BUY'"),
                  ("momentum > 0.1e0 AND risk_score < 0.2e0", "'STRONG_BUY'")], "'HOLD'")} AS trading_signal
        FROM b_i2),
b_med AS (SELECT median(volume_usd) AS med FROM b_ind),
b_n0 AS (SELECT b_ind.*, abs(momentum) * 5e0 + (volume_usd / b_med.med) * 2e0
                + spread_percent * 3e0 AS anomaly_score FROM b_ind, b_med),
b_n1 AS (SELECT *, {_bins("anomaly_score", [2.0, 5.0, 8.0, 12.0],
                          ["NORMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"])} AS anomaly_level FROM b_n0),
b_all AS (SELECT *, COALESCE(anomaly_level IN ('HIGH', 'CRITICAL'), false) AS critical_alert,
          {_case([("anomaly_level IN ('HIGH', 'MODERATE')", "'CAUTION'"),
                  ("trading_signal IN ('STRONG_SELL', 'SELL') AND anomaly_level IN ('NORMAL', 'LOW')", "'SELL_RECOMMENDED'"),
                  ("trading_signal IN ('STRONG_BUY', 'BUY') AND anomaly_level IN ('NORMAL', 'LOW')", "'BUY_RECOMMENDED'"),
                  ("anomaly_level = 'CRITICAL'", "'AVOID'")], "'MONITOR'")} AS recommendation
        FROM b_n1),
a_alerts AS (SELECT symbol, anomaly_level || '_ANOMALY' AS alert_type,
          symbol || ': ' || recommendation || ' - ' || anomaly_level || ' anomaly' AS alert_message,
          overall_anomaly_score AS anomaly_score, last_price AS price,
          price_change_percent AS change_percent, volume_usd, pump_dump_risk, recommendation
        FROM a_all WHERE critical_alert),
b_alerts AS (SELECT symbol, anomaly_level || '_ANOMALY' AS alert_type,
          symbol || ': ' || recommendation || ' - ' || anomaly_level || ' anomaly detected' AS alert_message,
          anomaly_score, lastPrice AS price, priceChangePercent AS change_percent, volume_usd,
          recommendation
        FROM b_all WHERE critical_alert)
"""


def sql(tail: str) -> str:
    return "WITH" + CTES + tail


def dist(src: str, col: str, name: str) -> str:
    return (f"(SELECT string_agg(label || ':' || CAST(n AS VARCHAR), ',' ORDER BY label) FROM "
            f"(SELECT {col} AS label, count(*) AS n FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY 1)) AS {name}")


def dist_filled(src: str, col: str, labels: list[str], name: str) -> str:
    dom = ", ".join(f"('{lab}')" for lab in labels)
    return (f"(SELECT string_agg(d.label || ':' || CAST(COALESCE(c.n, 0) AS VARCHAR), ',' "
            f"ORDER BY d.label) FROM (VALUES {dom}) d(label) LEFT JOIN "
            f"(SELECT {col} AS label, count(*) AS n FROM {src} GROUP BY 1) c "
            f"ON c.label = d.label) AS {name}")


def top_syms(src: str, col: str, k: int, name: str, largest: bool = True) -> str:
    d = "DESC" if largest else "ASC"
    return (f"(SELECT string_agg(symbol, ',' ORDER BY {col} {d} NULLS LAST, symbol) FROM "
            f"(SELECT symbol, {col} FROM {src} "
            f"ORDER BY {col} {d} NULLS LAST, symbol LIMIT {k})) AS {name}")


def label_counts(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS dimension, {c} AS label, count(*) AS n FROM {src} "
             f"WHERE {c} IS NOT NULL GROUP BY 2" for c in cols]
    return " UNION ALL ".join(parts)


def summary_a(src: str = "a_all") -> str:
    return (f"SELECT 'spark_etl_pipeline' AS data_source, count(*) AS total_symbols, "
            f"round(sum(volume_usd), 0) AS total_volume_usd, "
            f"round(avg(price_change_percent), 6) AS average_price_change, "
            f"count(*) FILTER (WHERE critical_alert) AS critical_alerts, "
            f"{dist(src, 'risk_category', 'risk_distribution')}, "
            f"{dist(src, 'trading_signal', 'signal_distribution')}, "
            f"{dist(src, 'anomaly_level', 'anomaly_distribution')}, "
            f"{dist(src, 'recommendation', 'recommendation_distribution')}, "
            f"{top_syms(src, 'price_change_percent', 5, 'top_gainers')}, "
            f"{top_syms(src, 'price_change_percent', 5, 'top_losers', False)}, "
            f"{top_syms(src, 'volume_usd', 5, 'highest_volume')}, "
            f"{top_syms(src, 'overall_anomaly_score', 5, 'most_anomalous')} "
            f"FROM {src}")


def summary_b(src: str = "b_all") -> str:
    return (f"SELECT 'relative_profile' AS data_source, count(*) AS total_symbols, "
            f"round(sum(volume_usd), 0) AS total_volume_usd, "
            f"round(avg(priceChangePercent), 6) AS average_price_change, "
            f"count(*) FILTER (WHERE critical_alert) AS critical_alerts, "
            f"{dist_filled(src, 'risk_category', ['LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH'], 'risk_distribution')}, "
            f"{dist(src, 'trading_signal', 'signal_distribution')}, "
            f"{dist_filled(src, 'anomaly_level', ['NORMAL', 'LOW', 'MODERATE', 'HIGH', 'CRITICAL'], 'anomaly_distribution')}, "
            f"{dist(src, 'recommendation', 'recommendation_distribution')}, "
            f"{top_syms(src, 'priceChangePercent', 5, 'top_gainers')}, "
            f"{top_syms(src, 'priceChangePercent', 5, 'top_losers', False)} "
            f"FROM {src}")
