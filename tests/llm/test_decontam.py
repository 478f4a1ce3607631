"""Planted items are found, others are not; the index misses nothing in its radius."""

import random

import numpy as np

from tickwise.llm import decontam as D
from tickwise.llm.common import table
from tickwise.llm.shingles import mix64

SF = "/root/testdata/sf0.001"
WORD = ["".join(random.Random(i).choice("abcdefghij") for _ in range(5)) for i in range(4000)]


def text(seed, n):
    r = random.Random(seed)
    return [r.choice(WORD) for _ in range(n)]


def test_index_finds_all_within_the_radius():
    r = np.random.default_rng(1)
    items = D.Items([(i, " ".join(text(i, 30))) for i in range(300)])
    prints = items.prints[r.integers(0, 300, 400)].copy()
    for row in prints:
        for b in r.choice(128, r.integers(0, 45), replace=False):
            row[b // 16] ^= np.uint16(1 << (b % 16))
    window, item, far = items.near(prints)
    all_far = np.bitwise_count(prints[:, None, :] ^ items.prints[None]).sum(axis=2)
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(all_far <= D.RADIUS))))
    assert set(zip(window.tolist(), item.tolist())) == want and len(want) > 200
    assert all(all_far[w, i] == f for w, i, f in zip(window, item, far))


def test_similar_texts_are_within_the_radius():
    r = np.random.default_rng(3)
    far = []
    for _ in range(300):
        a = mix64(r.integers(0, 1 << 62, 40, dtype=np.uint64))
        b = a.copy()
        b[:4] = mix64(r.integers(0, 1 << 62, 4, dtype=np.uint64))      # similarity 36/44
        x, y = (D._pack(D.signs(s).sum(axis=0, dtype=np.int32)[None])[0] for s in (a, b))
        far.append(int(np.bitwise_count(x ^ y).sum()))
    assert np.mean(np.array(far) <= D.RADIUS) > 0.98


def brute(docs, items, least=0.8):
    out = set()
    for key, t in docs:
        w = D.plain((t or "").encode()).split()
        for item, u in items:
            v = D.plain((u or "").encode()).split()
            if not v:
                continue
            width = min(5, len(v))
            grams = lambda x: [tuple(x[i:i + width]) for i in range(len(x) - width + 1)]
            own = grams(v)
            if not set(own) & set(grams(w)):
                continue
            for s in range(max(1, len(w) - len(v) + 1)):
                found = grams(w[s:s + len(v)]) or ([tuple(w)] if w and width == 5 else [])
                both = sum(min(own.count(g), found.count(g)) for g in set(own))
                if both >= least * (len(own) + len(found) - both):
                    out.add((key, item))
                    break
    return out


def test_planted_passages(spark):
    r = random.Random(9)
    items = [(i, " ".join(text(1000 + i, r.randint(15, 60)))) for i in range(25)]
    items += [(100, "one two three"), (101, None), (102, ""), (103, "Solo")]
    docs = []
    for i in range(120):
        body = text(i, r.randint(0, 300))
        if i % 3 == 0:
            item = r.choice(items[:25])[1].split()
            for _ in range(r.choice([0, 0, 1, 1, 5])):
                item[r.randrange(len(item))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = [w.upper() + r.choice(["", ",", "!!"]) for w in item]
        docs.append((i, r.choice([" ", "\n"]).join(body)))
    docs += [(500, None), (501, ""), (502, "see ONE, two three!"), (503, items[0][1]),
             (503, items[0][1]), (None, items[1][1]), (504, " ".join(text(7, 30000)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS item_id", "0.5 AS similarity")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in D.find_leaks(frame, bench).collect()}
    assert got == brute(docs, items)
    assert (502, 100) in got and (None, 1) in got
    leaky = {x.doc_id: set(x["items"]) for x in D.leaky_documents(frame, bench).collect()}
    assert leaky == {k: {i for j, i in got if j == k} for k, _ in got}
    kept = D.without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(
        k for k, _ in docs if k is not None and k not in leaky)


def test_benchmark_in_blocks_and_empty_tables(spark, monkeypatch):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    whole = {(x.doc_id, x.item_id) for x in D.find_leaks(docs, bench).collect()}
    assert whole
    monkeypatch.setattr(D, "ITEM_BYTES", 2000)
    assert {(x.doc_id, x.item_id) for x in D.find_leaks(docs, bench).collect()} == whole
    assert D.find_leaks(docs.limit(0), bench).count() == 0
    assert D.find_leaks(docs, bench.limit(0)).count() == 0
    assert D.without_leaks(docs, bench.limit(0)).count() == docs.count()
