"""Sums that do not depend on the order of the rows; a median in two reads."""

import datetime as dt
import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from tickwise.functions import exact_avg, exact_median, exact_sum
from tickwise.operators import aggregates as A
from tickwise.operators import documents as D
from tickwise.operators.cleaning import score_absolute
from tickwise.operators.relative import score_relative
from tickwise.sources.fixture import ticker_snapshot

from conftest import SF_SMALL


def test_sum_is_the_rounded_exact_sum(spark):
    r = random.Random(3)
    xs = [r.choice([-1, 1]) * r.lognormvariate(10, 8) for _ in range(3000)] + [0.1] * 1000
    xs += [1e17, -1e17, 3.5, -7.25, 1e-9]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "v double")
    true = sum((Fraction(x) for x in xs), Fraction(0))
    got = {df.repartition(n).agg(exact_sum("v")).first()[0] for n in (1, 3, 11)}
    assert len(got) == 1
    assert abs(Fraction(got.pop()) - true) <= Fraction(len(xs), 1 << 40) + abs(true) / 2 ** 52
    mean = {df.repartition(n).agg(exact_avg("v")).first()[0] for n in (1, 3, 11)}
    assert len(mean) == 1 and math.isclose(mean.pop(), float(true / len(xs)), rel_tol=1e-12)


def test_sum_of_odd_values(spark):
    for xs, want in (([], None), ([None], None), ([float("inf"), 1.0], float("inf")),
                     ([1e300, 1.0], 1e300), ([-2.5, 2.5], 0.0)):
        df = spark.createDataFrame([(x,) for x in xs], "v double")
        assert df.agg(exact_sum("v")).first()[0] == want
    assert spark.createDataFrame([], "v double").agg(exact_avg("v")).first()[0] is None


def test_summaries_are_equal_to_the_last_bit(spark):
    raw = ticker_snapshot(spark, SF_SMALL)
    stamp = dt.datetime(2024, 6, 1)
    for rows, summary in ((score_absolute(raw, stamp), D.summary_a),
                          (score_relative(raw), D.summary_b)):
        rows = rows.persist()
        found = {(s.total_volume_usd, s.average_price_change) for s in
                 (summary(rows.repartition(n, F.rand(n)), stamp).first() for n in (1, 4, 13))}
        assert len(found) == 1
        rows.unpersist()
    rows = score_absolute(raw, stamp).persist()
    assert len({tuple(A.totals(rows.repartition(n, F.rand(n)), exact=True).first())
                for n in (1, 4, 13)}) == 1
    rows.unpersist()


def test_median_reads_the_column_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    r = random.Random(8)
    for xs in ([r.lognormvariate(9, 3) for _ in range(5001)], [7.0] * 2000 + [1.0] * 900,
               [float(i % 3) for i in range(2000)]):
        before = seen.value
        df = spark.createDataFrame([(x,) for x in xs], "v double").withColumn(
            "v", counted.asNondeterministic()("v"))
        s = sorted(xs)
        got = exact_median(df, "v", buckets=64, max_candidates=50).first()[0]
        assert got == (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
        assert seen.value - before == 2 * len(xs)
