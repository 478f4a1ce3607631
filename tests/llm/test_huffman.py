"""Exact round trips, optimal lengths, independent blocks."""

import heapq
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.llm import huffman as H
from tickwise.llm.common import table
from tickwise.llm.tokens import vocabulary, word_ids
from tickwise.session import new_scratch_dir

SF = "/root/testdata/sf0.001"


def optimal_cost(counts):
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    return cost


def test_lengths_are_optimal_and_limited():
    r = np.random.default_rng(1)
    for n in (2, 3, 10, 257, 3000):
        counts = (r.pareto(0.7, n) * 10).astype(np.int64) + 1
        free = H.code_lengths(counts, 40)
        assert (counts * free).sum() == optimal_cost(counts)
        tight = H.code_lengths(counts, 12)
        assert tight.max() <= 12 and (2.0 ** -tight.astype(float)).sum() <= 1
        codes, order = H.canonical(tight)
        shown = [format(int(codes[i]), f"0{tight[i]}b") for i in order]
        assert shown == sorted(shown) and len(set(shown)) == n
        assert not any(b.startswith(a) for a, b in zip(shown, shown[1:]))
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(300, np.int64), 8)


def test_blocks_round_trip():
    r = np.random.default_rng(2)
    for n, size in ((1, 5), (2, 1000), (700, 1), (700, 255), (700, 256), (700, 70001)):
        ids = (r.pareto(1, size) * 5).astype(np.int64) % n
        lengths = H.code_lengths(np.bincount(ids, minlength=n), 14)
        codes, _ = H.canonical(lengths)
        sizes = np.array([size // 3, 0, size - size // 3])
        block = H.encode_block(ids, [5, None, -7], sizes, codes, lengths)
        names, got, back = H.Decoder(lengths).block(block)
        assert names == [5, None, -7] and got.tolist() == sizes.tolist()
        assert (back == ids).all()


def check(spark, docs, **settings):
    path = new_scratch_dir(spark, "tokens")
    H.write_tokens(docs, path, **settings)
    got = H.read_tokens(spark, path).orderBy("start").collect()
    coder = word_ids(vocabulary())
    want = sorted(((r.doc_id is not None, r.doc_id, r.text is not None, r.text or "")
                   for r in docs.collect()), key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
    assert len(got) == len(want)
    start = 0
    for r, (_, key, _, text) in zip(got, want):
        ids = coder.ids(text.encode()) + (1).to_bytes(4, "little")
        assert (r.doc_id, r.start, r.n_tokens) == (key, start, len(ids) // 4)
        assert bytes(r.ids) == ids and r.ids_crc32 == zlib.crc32(ids)
        start += r.n_tokens
    return path


def test_files(spark):
    docs = table(spark, SF, "documents")
    check(spark, docs)
    path = check(spark, docs.repartition(7), block_tokens=500)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 50
    size = blocks.agg(F.sum(F.length("data"))).first()[0]
    assert size < 2 * blocks.agg(F.sum("n_tokens")).first()[0]


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(3, None), (1, ""), (1, ""), (None, "the one"), (2, "the of and " * 3000), (1, "x")],
        "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS part")
    check(spark, docs, block_tokens=100)
    check(spark, docs.limit(0))
