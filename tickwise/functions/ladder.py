"""Classification ladders compiled to a single CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rules: Sequence[tuple[Column, object]], default: object,
           last_wins: bool = False) -> Column:
    """Ordered (condition, label) rules plus a default.

    First match wins by default. ``last_wins=True`` models sequential
    overwrites (each later rule replaces earlier labels), which is the same
    CASE with the rule list reversed. A NULL condition never matches.
    """
    ordered = list(reversed(rules)) if last_wins else list(rules)
    expr = None
    for cond, label in ordered:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def right_closed_bins(c: Column, edges: Sequence[float],
                      labels: Sequence[str]) -> Column:
    """Bins (-inf, e1], (e1, e2], ..., (ek, +inf]; NULL outside or for NULL.

    The lowest bin is open at -inf, so -Infinity itself gets no label, while
    +Infinity falls in the top bin.
    """
    assert len(labels) == len(edges) + 1
    bounds = [float("-inf"), *edges, float("inf")]
    rules = [((c > lo) & (c <= hi), lab)
             for lo, hi, lab in zip(bounds[:-1], bounds[1:], labels)]
    return ladder(rules, F.lit(None).cast("string"))


def steps_above(c: Column, steps: Sequence[tuple[float, object]], floor: object) -> Column:
    """First step whose threshold ``c`` exceeds (strictly) wins; else ``floor``."""
    return ladder([(c > t, label) for t, label in steps], floor)


def steps_below(c: Column, steps: Sequence[tuple[float, object]], ceiling: object) -> Column:
    """First step whose threshold ``c`` is strictly below wins; else ``ceiling``."""
    return ladder([(c < t, label) for t, label in steps], ceiling)


def signal_rules(momentum: Column, risk: Column,
                 rules: Sequence[tuple[str, float, float]]) -> list[tuple[Column, str]]:
    """(label, momentum threshold, risk below) -> ladder rules; a positive
    threshold asks for momentum above it, a negative one for momentum below."""
    return [(((momentum > t) if t > 0 else (momentum < t)) & (risk < r_max), label)
            for label, t, r_max in rules]
