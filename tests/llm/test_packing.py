"""Packing against exhaustive subset sums; places are gapless."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np

from tickwise.llm import packing as P
from tickwise.llm.common import table
from tickwise.llm.tokens import vocabulary, word_ids

SF = "/root/testdata/sf0.001"


def test_fullest_is_the_best_subset():
    r = random.Random(1)
    for _ in range(200):
        sizes = [r.randint(1, 30) for _ in range(r.randint(0, 9))]
        room = r.randint(0, 60)
        best = max((sum(c) for n in range(len(sizes) + 1) for c in combinations(sizes, n)
                    if sum(c) <= room), default=0)
        counts = Counter(sizes)
        got = P.fullest(sorted(counts.items(), reverse=True), room)
        assert sum(k * n for k, n in got.items()) == best
        assert all(n <= counts[k] for k, n in got.items())


def test_plan_uses_all_and_is_near_the_bound():
    r = random.Random(2)
    for _ in range(20):
        histogram = Counter(r.randint(1, 100) for _ in range(r.randint(1, 400)))
        plan = P.plan_bins(dict(histogram), 100)
        used = Counter()
        for times, need in plan:
            assert times > 0 and sum(k * n for k, n in need.items()) <= 100
            for k, n in need.items():
                used[k] += times * n
        assert used == histogram
        bins, bound = sum(t for t, _ in plan), -(-sum(k * n for k, n in histogram.items()) // 100)
        assert bins <= bound * 1.1 + 1


def check(spark, docs, capacity):
    rows = P.pack(docs, capacity).collect()
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    coder, want = word_ids(vocabulary()), Counter()
    for key, text in texts:
        ids = coder.ids(text) + bytes(4)
        for n, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at:at + 4 * capacity]
            want[(key, n, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        places.sort()
        ends = np.cumsum([n for _, n in places])
        assert [o for o, _ in places] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(by), sum(r.length for r in rows)


def test_documents(spark):
    docs = table(spark, SF, "documents")
    for capacity in (2048, 64):
        bins, total = check(spark, docs, capacity)
        assert bins <= -(-total // capacity) * 1.01 + 1


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (2, ""), (None, "the one"), (3, "the of and " * 3000), (1, "x")],
        "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS piece", "'a' AS _rank")
    check(spark, docs, 2048)
    assert P.pack(docs.limit(0)).count() == 0


def test_alone_it_remembers_more_words_than_in_the_pipeline():
    import inspect

    import corpus_pipeline
    from tickwise.llm.tokens import KEEP_MANY, KEEP_WORDS

    assert inspect.signature(P.pack).parameters["keep_words"].default == KEEP_MANY
    assert corpus_pipeline.PACK_WORDS < KEEP_WORDS < KEEP_MANY
