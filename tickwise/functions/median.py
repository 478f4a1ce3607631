"""Exact population median without funnelling the values through one task.

``percentile``/``median`` merge a value->count map of every distinct value
in one final task, which does not survive a 100 TB population. This is an
exact distributed selection instead (like ``DataFrame.approxQuantile`` it
runs its own small jobs and returns a Python value). The column is read twice:

1. one aggregate: n, the infinities, and two bounds from a mergeable quantile
   sketch that enclose the middle rank(s);
2. one counting pass: rows below the bounds as one number, values between them
   with their multiplicities, written to the scratch folder (about n / 1000 rows).

That table is then narrowed by bucket counts (at most ``buckets + 2`` rows reach
the driver each time) until at most ``max_candidates`` values are left, which are
ranked: both are fixed numbers, whatever the data. A value holding a third of all
rows is one row of the table. Should the sketch's bounds not enclose the ranks,
the second pass is made again over all values: the result never depends on it.

Every pass is a deterministic job, so a lost executor just re-runs its tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.session import job_scratch

#: Accuracy of the sketch (its ranks are off by at most n / ACCURACY), and the
#: distance of its bounds from the middle, as a share of n.
ACCURACY = 10_000
MARGIN = 0.0005


def _monotone(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def exact_median_value(df: DataFrame, col: str, buckets: int = 1024,
                       max_candidates: int = 4096) -> float | None:
    """The exact median of the column's values, None without any.

    Both passes read this one column of ``df``: give rows read from a table
    (``session.stored``), or the input is computed again for the second.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    return _median_of(vals, buckets, max_candidates)


def _median_of(vals: DataFrame, buckets: int, max_candidates: int) -> float | None:
    x = F.col("v")
    finite = (x != float("inf")) & (x != float("-inf"))
    st = vals.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(x == float("-inf")).alias("neg"),
                  F.count_if(x == float("inf")).alias("pos"),
                  F.percentile_approx(F.when(finite, x), [0.5 - MARGIN, 0.5 + MARGIN],
                                      ACCURACY).alias("bounds")).first()
    n = st["n"]
    if not n:
        return None
    ranks = sorted({(n - 1) // 2, n // 2})       # 0-based middle rank(s)
    found = {}
    for r in ranks:                               # ranks among the infinities
        if r < st["neg"]:
            found[r] = float("-inf")
        elif r >= n - st["pos"]:
            found[r] = float("inf")
    rest = [r for r in ranks if r not in found]
    if rest:
        found.update(_between(vals.where(finite), rest, st["neg"], st["bounds"], buckets,
                              max_candidates))
    a, b = found[ranks[0]], found[ranks[-1]]
    middle = (a + b) / 2
    # the sum of two large values can overflow where their middle does not
    return a / 2 + b / 2 if math.isinf(middle) and math.isfinite(a) and math.isfinite(b) \
        else middle


def _between(vals: DataFrame, ranks: list[int], neg: int, bounds: list[float], buckets: int,
             max_candidates: int) -> dict[int, float]:
    """Values at the ranks, by counting the values between two bounds; ``neg``
    rows come before all of ``vals``."""
    x = F.col("v")
    # many infinities move the middle rank away from that of the finite values
    for lo, hi in (bounds, (float("-inf"), float("inf"))):
        with job_scratch(vals.sparkSession) as keep:
            counts = keep(vals.where(x <= hi).groupBy(F.when(x >= lo, x).alias("v"))
                          .agg(F.count(F.lit(1)).alias("c")), "between")
            inside = counts.where("v IS NOT NULL")
            st = counts.agg(F.sum(F.when(x.isNull(), F.col("c"))).alias("below"),
                            F.sum(F.when(x.isNotNull(), F.col("c"))).alias("inside"),
                            F.min("v").alias("lo"), F.max("v").alias("hi")).first()
            below = neg + (st["below"] or 0)
            if below <= ranks[0] and ranks[-1] < below + (st["inside"] or 0):
                return _select_ranks(inside, ranks, st["lo"], st["hi"], below, buckets,
                                     max_candidates)
    raise AssertionError("every rank lies among all values")


def _select_ranks(counts: DataFrame, ranks: list[int], lo: float, hi: float, below: int,
                  buckets: int, max_candidates: int) -> dict[int, float]:
    """Values at one or two adjacent global ranks among values ``v`` that occur
    ``c`` times; ``below`` rows precede ``lo``."""
    x = F.col("v")
    first = True
    while True:
        if lo == hi:
            return {r: lo for r in ranks}
        in_range = counts.where((x >= lo) & (x <= hi))
        key = (F.width_bucket(_monotone(x), F.lit(_mono(lo)), F.lit(_mono(hi)), F.lit(buckets))
               if first and _mono(lo) < _mono(hi)
               else F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(buckets)))
        first = False
        rows = (in_range.groupBy(key.alias("b"))
                .agg(F.sum("c").alias("c"), F.min("v").alias("lo"),
                     F.max("v").alias("hi"), F.count(F.lit(1)).alias("d"))
                .orderBy("b").collect())            # <= buckets + 2 rows
        cum, picked = below, {}
        for row in rows:
            for rank in ranks:
                if rank not in picked and cum <= rank < cum + row["c"]:
                    picked[rank] = (row, cum)
            cum += row["c"]
        (b_first, off), (b_last, _) = picked[ranks[0]], picked[ranks[-1]]
        if b_first["b"] != b_last["b"]:
            # adjacent ranks split across buckets: last of one, first of next
            return {ranks[0]: b_first["hi"], ranks[-1]: b_last["lo"]}
        lo, hi, below = b_first["lo"], b_first["hi"], off
        if lo != hi and b_first["d"] <= max_candidates:
            return _rank_candidates(counts, lo, hi, below, ranks)


def _mono(x: float) -> float:
    return math.copysign(math.log1p(abs(x)), x) if x else 0.0


def _rank_candidates(counts: DataFrame, lo: float, hi: float, below: int,
                     ranks: list[int]) -> dict[int, float]:
    x = F.col("v")
    cum, out = below, {}
    for row in counts.where((x >= lo) & (x <= hi)).orderBy("v").collect():
        for rank in ranks:
            if rank not in out and cum <= rank < cum + row["c"]:
                out[rank] = row["v"]
        cum += row["c"]
    return out


def exact_median(df: DataFrame, col: str, buckets: int = 1024,
                 max_candidates: int = 4096) -> DataFrame:
    """One-row DataFrame ``median`` holding the exact median of ``col``."""
    m = exact_median_value(df, col, buckets, max_candidates)
    return df.sparkSession.range(1).select(F.lit(m).cast("double").alias("median"))


def approx_median(df: DataFrame, col: str, accuracy: int = 100000) -> DataFrame:
    return df.agg(F.percentile_approx(col, 0.5, accuracy).cast("double").alias("median"))


def population_median(df: DataFrame, col: str, exact: bool = True,
                      accuracy: int = 100000) -> Column:
    """Median of ``col`` over ``df`` as a column: a literal for the exact
    path (computed by the passes above), a scalar subquery for the
    approximate sketch."""
    if exact:
        return F.lit(exact_median_value(df, col)).cast("double")
    return approx_median(df, col, accuracy).select("median").scalar()
