"""Weighted sampling against the similarity itself, and the order of documents."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tickwise.llm import sampling as S
from tickwise.llm.common import table

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def plainly(rows):
    """doc_id -> (n_chars, edited text, next text), for different ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        out[key] = len(text), text[:len(text) - cut] + following[:cut], following
    return out


def check(got, rows):
    want, texts = plainly(rows), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        n, made, _ = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(made.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    prints = {}
    for r in got:
        text, made = texts[r.doc_id] or "", want[r.doc_id][1]
        for t, f in ((text, r.fingerprint), (made, r.edited_fingerprint)):
            assert prints.setdefault(" ".join(sorted(t.split())), f) == f
            assert (f == "") == (not t.split())
    return want


def share(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)


def test_law_of_a_sample(spark):
    """The smallest value's law: exponential, at the rate of the weight."""
    for weight in (1, 2, 7, 1000):
        packed = spark.range(60_000).select(S.sample(F.col("id"), F.lit(math.log(weight)), 3)
                                            .alias("x")).toPandas().x.to_numpy()
        a = np.exp((packed >> 23) / 2.0 ** 32 - 160) * weight
        for q in (0.001, 0.1, 0.5, 0.9):
            share_ = (a < -math.log(1 - q)).mean()
            assert abs(share_ - q) < 4 * math.sqrt(q * (1 - q) / 60_000) + 1e-4


def test_collisions_follow_the_similarity(spark):
    r = random.Random(4)
    rows = []
    for i in range(60):
        pool = [f"w{r.randrange(150)}" for _ in range(r.randint(5, 300))]
        rows += [(2 * i, " ".join(pool)),
                 (2 * i + 1, " ".join(r.choices(pool, k=len(pool) // 2)
                                      + [f"v{r.randrange(80)}" for _ in range(len(pool) // 3)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.compared(docs, 256).collect()
    want, texts, off = check(got, rows), dict(rows), []
    prints = {x.doc_id: x.fingerprint for x in got}
    for x in got:
        for near, other, print_ in ((x.near_edited, want[x.doc_id][1], x.edited_fingerprint),
                                    (x.near_next, want[x.doc_id][2],
                                     prints[(x.doc_id + 1) % len(rows)])):
            assert near == share(x.fingerprint, print_)
            true = jaccard(texts[x.doc_id], other)
            assert abs(near - true) < 5 * math.sqrt(true * (1 - true) / 256) + 0.01
            off.append(near - true)
    assert abs(np.mean(off)) < 0.01


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = S.compared(docs).collect()
    want, texts = check(got, rows), dict(rows)
    prints = {x.doc_id: x.fingerprint for x in got}
    order = sorted(texts)
    for i, key in enumerate(order):
        row = next(x for x in got if x.doc_id == key)
        assert row.near_next == share(row.fingerprint, prints[order[(i + 1) % len(order)]])
    off = [x.near_edited - jaccard(texts[x.doc_id], want[x.doc_id][1]) for x in got]
    assert abs(np.mean(off)) < 0.02


def test_order_does_not_depend_on_ranges(spark):
    r = random.Random(9)
    rows = [(k, " ".join(r.choices(["aé", "bb", "c", "\n"], k=r.randint(0, 20))))
            for k in r.sample(range(-10**15, 10**15), 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = S.compared(docs.repartition(3), 16).collect()
            check(got, rows)
            results.append(sorted(map(tuple, got)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_odd_rows(spark):
    rows = [(None, "first of all"), (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "b c d e f g"),
            (6, "Wort für Wort " * 200_000), (7, "z" * 2_000_000), (8, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"part": F.lit("clash"), "id": F.lit(1), "n_chars": F.lit(2)})
    got = {r.doc_id: r for r in S.compared(docs, 16).collect()}
    check(list(got.values()), rows)
    assert got[1].near_next == 1 and got[3].near_next == 0 and got[1].near_edited == 1
    one = S.compared(docs.where("doc_id = 5"), 16).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert S.compared(docs.limit(0)).count() == 0


def test_repeated_ids_and_rows(spark):
    rows = [(5, "a b c")] * 40 + [(5, f"t{i} a") for i in range(200)] + [(6, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.compared(docs.repartition(4), 16).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(t) for _, t in rows)
    same = [r for r in got if r.n_chars == 5 and r.near_next == 1]
    assert len(same) >= 39
