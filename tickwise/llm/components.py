"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs); the
    component is its smallest node.

    Each round, every node hands its larger neighbours to its smallest one,
    then its smaller neighbours and itself; all are joins and partial minima,
    so a node with most of the links is split like any skewed key. A round's
    table is written to the shared scratch folder. Rounds grow with the
    logarithm of the longest chain; a graph that needs more than ``rounds``
    raises instead of giving a wrong result.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "links")
    state = _state(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = (both.groupBy("u").agg(F.min("v").alias("m"))
               .select("u", F.least("u", "m").alias("m")))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
