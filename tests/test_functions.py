import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.functions import exact_median, ieee_div, ladder, num, right_closed_bins


def test_num_parsing(spark):
    vals = ["12.5", "n/a", "", " 1.5 ", "1d", "2.5F", "NaN", "inf", None, "-3e2", "0x1p3",
            " -0X10"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(num("s")).collect()]
    assert got[0] == 12.5
    assert got[1] is None and got[2] is None
    assert got[3] == 1.5
    assert got[4] is None and got[5] is None and got[6] is None
    assert got[7] == math.inf
    assert got[8] is None
    assert got[9] == -300.0
    assert got[10] is None and got[11] is None


def test_ieee_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 1.0)],
                               "a double, b double")
    got = [r[0] for r in df.select(ieee_div(F.col("a"), F.col("b"))).collect()]
    assert got == [math.inf, -math.inf, None, 2.0, None]


def test_ladder_first_and_last_wins(spark):
    df = spark.createDataFrame([(5,), (15,), (None,)], "x int")
    x = F.col("x")
    rules = [(x > 1, "A"), (x > 10, "B")]
    first = [r[0] for r in df.select(ladder(rules, "D")).collect()]
    last = [r[0] for r in df.select(ladder(rules, "D", last_wins=True)).collect()]
    assert first == ["A", "A", "D"]
    assert last == ["A", "B", "D"]


def test_right_closed_bins_edges(spark):
    vals = [0.05, 0.0500001, 0.15, 0.3, 0.31, -5.0, float("-inf"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(
        right_closed_bins(F.col("v"), [0.05, 0.15, 0.3], ["L", "M", "H", "V"])).collect()]
    assert got == ["L", "M", "M", "H", "V", "L", None, "V", None]


@pytest.mark.parametrize("n,mode", [(0, 0), (1, 0), (2, 1), (7, 2), (400, 0), (401, 1),
                                    (900, 3), (1000, 2)])
def test_exact_median_matches_numpy(spark, n, mode):
    rng = random.Random(n * 10 + mode)
    if mode == 0:
        xs = [rng.lognormvariate(12, 3) for _ in range(n)]
    elif mode == 1:
        xs = [float(rng.randint(-3, 3)) for _ in range(n)]
    elif mode == 2:
        xs = [rng.uniform(-1e9, 1e9) for _ in range(n)]
    else:  # one hot value holding a third of the rows
        xs = [42.0] * (n // 3) + [rng.uniform(0, 100) for _ in range(n - n // 3)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "v double")
    got = exact_median(df, "v", buckets=16).collect()[0][0]
    # tiny candidate budget: forces several refinement passes
    assert exact_median(df, "v", buckets=4, max_candidates=4).collect()[0][0] == got
    if n == 0:
        assert got is None
    else:
        s = sorted(xs)
        expect = (s[(n - 1) // 2] + s[n // 2]) / 2
        assert got == expect
        assert got == pytest.approx(float(np.median(xs)))


@pytest.mark.parametrize("xs", [[1.0, float("inf")], [float("-inf"), 2.0, 3.0],
                                [float("-inf"), float("inf")], [5.0, float("inf"), float("inf")],
                                [float("-inf")] * 3 + [1.0, 2.0]])
def test_exact_median_with_infinities(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = exact_median(df, "v").collect()[0][0]
    s = sorted(xs)
    expect = (s[(len(xs) - 1) // 2] + s[len(xs) // 2]) / 2
    assert (math.isnan(got) and math.isnan(expect)) or got == expect


def test_num_matches_oracle_parse_in_duckdb(spark):
    import duckdb

    from tickwise.plans.oracle import _num

    rng = random.Random(7)
    pool = ["inf", "-Infinity", "NaN", "nan", "", " ", "abc", "1e", "--1", "0x1p3", "1d", "2.5F",
            "+.5", "5.", "1E+308", "1e400", "-0", "007", " 42 ", "1,5", "1_0"]
    for _ in range(400):
        x = rng.choice([rng.uniform(-1e6, 1e6), rng.lognormvariate(0, 8), float(rng.randint(-99, 99))])
        form = rng.choice(["{!r}", "{:.3f}", "{:e}", " {!r} ", "{!r}d", "+{!r}"])
        pool.append(form.format(x))
    df = spark.createDataFrame([(s,) for s in pool], "s string")
    got = [r[0] for r in df.select(num("s")).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {_num('?')}".replace("?", "$1"), [s]).fetchone()[0]
            for s in pool]
    mismatch = [(s, g, w) for s, g, w in zip(pool, got, want) if g != w]
    # DuckDB alone accepts digit separators ("1_0") and doubled signs ("+-84");
    # Spark, like the feed's other consumers, treats both as malformed. Neither
    # occurs in the feed's number format.
    mismatch = [m for m in mismatch
                if m[0] != "1_0" and not m[0].lstrip().startswith(("+-", "-+"))]
    assert not mismatch, mismatch[:5]
