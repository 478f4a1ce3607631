"""Both profiles against a plain-Python restatement of the rules, on random
feed rows that include values exactly on the thresholds, missing values and
malformed strings."""

import math
import random
import statistics

import pytest

from tickwise.operators.cleaning import score_absolute
from tickwise.operators.relative import score_relative
from tickwise.sources.snapshots import rows_frame

EDGE_PCT = [15, 5, 1, -1, -5, -15, 10, -10, 3, -3, 20, -20, 0]


def _num(s):
    if s is None or s.strip().lower().lstrip("+-").startswith("0x"):
        return None
    try:
        x = float(s)                  # rejects "1d"; accepts blanks, "Infinity"
    except ValueError:
        return None
    return None if math.isnan(x) else x


def _gen(rng, i):
    last = rng.choice([rng.uniform(0.01, 5000), 100.0, 1.0])
    sp = rng.choice([0.005, 0.01, 0.3, 1.0, 2.0, 3.0, 5.0, 9.0, 12.0, rng.uniform(0, 15)])
    bid = last * (1 - sp / 200)
    ask = last * (1 + sp / 200)
    pct = rng.choice(EDGE_PCT + [rng.uniform(-40, 40), None, "x"])
    op = last / (1 + (pct if isinstance(pct, float) or isinstance(pct, int) else 0) / 100)
    v = rng.choice([0.0, 0.5, 1.5, 3.0, rng.uniform(0, 2)])
    vol = rng.choice([0.0, 5.0, 200.0, 20000.0, 1e6, rng.uniform(0, 1e7)])
    row = dict(symbol=f"R{i}" + rng.choice(["USDT", "USDT", "BTC"]),
               lastPrice=rng.choice([repr(last)] * 8 + ["n/a", "", "0", f" {last!r} ",
                                                        f"{last!r}d", "0x1p6", "Infinity"]),
               priceChangePercent=None if pct is None else str(pct),
               volume=repr(vol), bidPrice=repr(bid),
               askPrice=rng.choice([repr(ask)] * 9 + [repr(bid)]),
               openPrice=rng.choice([repr(op)] * 9 + ["0"]),
               highPrice=repr(max(op, last) * (1 + v / 2)),
               lowPrice=repr(min(op, last) * (1 - v / 2)), quoteVolume="1")
    return row


def _gt(a, b):
    return a is not None and a > b


def _lt(a, b):
    return a is not None and a < b


def _first(rules, default):
    for cond, label in rules:
        if cond:
            return label
    return default


def brute_a(r):
    sym = r["symbol"]
    lp, pct, vol, bid, ask, op, hi, lo = (_num(r[k]) for k in (
        "lastPrice", "priceChangePercent", "volume", "bidPrice", "askPrice",
        "openPrice", "highPrice", "lowPrice"))
    if None in (lp, vol, bid, ask, op, hi, lo):
        return None
    if not (lp > 0 and vol > 0 and bid > 0 and ask > bid and op > 0 and hi >= lo):
        return None
    sp = ((ask - bid) / lp) * 100
    vola = (hi - lo) / op
    vusd = vol * lp
    quality = _first([(sp < 5 and vola < 1, "HIGH"), (sp < 10 and vola < 2, "MEDIUM")], "LOW")
    if not (sym.endswith("USDT") and quality in ("HIGH", "MEDIUM") and vusd > 10000):
        return None
    m = None if pct is None else pct / 100
    am = None if m is None else abs(m)
    liq = 1 / (sp + 0.001)
    risk = None if m is None else (vola * 100 * 0.4 + (100 - liq) * 0.3 + am * 100 * 0.3) / 100
    signal = _first([(_gt(m, 0.1) and _lt(risk, 0.7), "STRONG_BUY"),
                     (_gt(m, 0.03) and _lt(risk, 0.5), "BUY"),
                     (_lt(m, -0.1) and _lt(risk, 0.7), "STRONG_SELL"),
                     (_lt(m, -0.03) and _lt(risk, 0.5), "SELL")], "HOLD")
    ps = _first([(_gt(am, 0.2), 10.0), (_gt(am, 0.15), 8.0), (_gt(am, 0.1), 6.0),
                 (_gt(am, 0.05), 4.0)], 1.0)
    vs = _first([(vusd > 1e9, 9.0), (vusd > 5e8, 7.0), (vusd > 1e8, 5.0), (vusd > 1e7, 3.0),
                 (vusd < 5e4, 6.0)], 1.0)
    ss = _first([(sp > 5, 8.0), (sp > 2, 6.0), (sp > 1, 4.0), (sp < 0.01, 7.0)], 1.0)
    overall = ps * 0.4 + vs * 0.35 + ss * 0.25
    level = _first([(overall > 8, "CRITICAL"), (overall > 6, "HIGH"), (overall > 4, "MODERATE"),
                    (overall > 2, "LOW")], "NORMAL")
    pump = _first([(_gt(am, 0.2) and vs > 5, "VERY_HIGH"), (_gt(am, 0.15) and vs > 3, "HIGH"),
                   (_gt(am, 0.1) and vs > 2, "MEDIUM"), (_gt(am, 0.05), "LOW")], "MINIMAL")
    wash = _first([(vs > 7 and ps < 3, "HIGH"), (vs > 5 and ps < 4, "MEDIUM"),
                   (vs > 3 and ps < 2, "LOW")], "MINIMAL")
    arb = _first([(sp > 3, "EXCELLENT"), (sp > 1.5, "GOOD"), (sp > 0.8, "FAIR"),
                  (sp > 0.3, "POOR")], "NONE")
    rec = _first([(level == "CRITICAL", "AVOID"), (pump in ("VERY_HIGH", "HIGH"), "EXTREME_CAUTION"),
                  (wash == "HIGH", "INVESTIGATE"),
                  (signal in ("STRONG_BUY", "BUY") and level in ("NORMAL", "LOW"), "BUY_RECOMMENDED"),
                  (signal in ("STRONG_SELL", "SELL") and level in ("NORMAL", "LOW"), "SELL_RECOMMENDED"),
                  (arb in ("EXCELLENT", "GOOD"), "ARBITRAGE_OPPORTUNITY"),
                  (level in ("HIGH", "MODERATE"), "CAUTION")], "MONITOR")
    return dict(risk_category=_first([(_lt(risk, 0.3), "LOW"), (_lt(risk, 0.6), "MEDIUM"),
                                      (_lt(risk, 0.8), "HIGH")], "VERY_HIGH"),
                trading_signal=signal, anomaly_level=level, pump_dump_risk=pump,
                wash_trading_risk=wash, arbitrage_opportunity=arb, recommendation=rec,
                critical_alert=level == "CRITICAL" or pump == "VERY_HIGH" or wash == "HIGH",
                overall_anomaly_score=overall, data_quality=quality)


def _bins(x, edges, labels):
    if x is None or x == -math.inf:
        return None
    for e, lab in zip(edges, labels):
        if x <= e:
            return lab
    return labels[-1]


def brute_b(rows):
    kept = []
    for r in rows:
        lp, pct, vol, bid, ask, op, hi, lo = (_num(r[k]) for k in (
            "lastPrice", "priceChangePercent", "volume", "bidPrice", "askPrice",
            "openPrice", "highPrice", "lowPrice"))
        if not (r["symbol"].endswith("USDT") and _gt(lp, 0) and _gt(vol, 10000)
                and _gt(bid, 0) and ask is not None and ask > bid):
            continue
        rng_ = None if hi is None or lo is None else hi - lo
        if op is None or rng_ is None:
            vola = None
        elif op == 0:
            vola = math.inf if rng_ > 0 else (-math.inf if rng_ < 0 else None)
        else:
            vola = rng_ / op
        sp = ((ask - bid) / lp) * 100
        m = None if pct is None else pct / 100
        risk = None if (vola is None or m is None) else vola * 0.4 + sp * 0.3 + abs(m) * 0.3
        kept.append(dict(symbol=r["symbol"], vusd=vol * lp, sp=sp, m=m, risk=risk))
    med = statistics.median([k["vusd"] for k in kept]) if kept else None
    out = {}
    for k in kept:
        m, risk = k["m"], k["risk"]
        signal = "HOLD"
        for cond, lab in [(_gt(m, 0.1) and _lt(risk, 0.2), "STRONG_BUY"),
                          (_gt(m, 0.03) and _lt(risk, 0.15), "BUY"),
                          (_lt(m, -0.1) and _lt(risk, 0.2), "STRONG_SELL"),
                          (_lt(m, -0.03) and _lt(risk, 0.15), "SELL")]:
            if cond:
                signal = lab
        score = None if m is None else abs(m) * 5 + (k["vusd"] / med) * 2 + k["sp"] * 3
        level = _bins(score, [2, 5, 8, 12], ["NORMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"])
        rec = "MONITOR"
        for cond, lab in [(level == "CRITICAL", "AVOID"),
                          (signal in ("STRONG_BUY", "BUY") and level in ("NORMAL", "LOW"), "BUY_RECOMMENDED"),
                          (signal in ("STRONG_SELL", "SELL") and level in ("NORMAL", "LOW"), "SELL_RECOMMENDED"),
                          (level in ("HIGH", "MODERATE"), "CAUTION")]:
            if cond:
                rec = lab
        out[k["symbol"]] = dict(risk_category=_bins(risk, [0.05, 0.15, 0.3],
                                                     ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]),
                                trading_signal=signal, anomaly_level=level,
                                critical_alert=level in ("HIGH", "CRITICAL"),
                                recommendation=rec)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_profiles_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [_gen(rng, i) for i in range(1500)]
    df = rows_frame(spark, rows)
    expect_a = {r["symbol"]: brute_a(r) for r in rows}
    expect_a = {k: v for k, v in expect_a.items() if v is not None}
    got_a = {r.symbol: r.asDict() for r in score_absolute(df).collect()}
    assert set(got_a) == set(expect_a)
    for sym, exp in expect_a.items():
        g = got_a[sym]
        for col, val in exp.items():
            if isinstance(val, float):
                assert g[col] == pytest.approx(val, rel=1e-12), (sym, col)
            else:
                assert g[col] == val, (sym, col, g[col], val)
    expect_b = brute_b(rows)
    got_b = {r.symbol: r.asDict() for r in score_relative(df).collect()}
    assert set(got_b) == set(expect_b)
    for sym, exp in expect_b.items():
        for col, val in exp.items():
            assert got_b[sym][col] == val, (sym, col, got_b[sym][col], val)
