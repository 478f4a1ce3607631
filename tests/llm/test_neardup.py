"""Components against all pairs; nothing is lost between blocks."""

import random
import re

import numpy as np

from tickwise.llm import neardup as N
from tickwise.llm.common import table
from tickwise.llm.components import components
from tickwise.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, percent):
    rows = [(k, shingles(t)) for k, t in rows]
    up = {k: k for k, _ in rows if k is not None}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            both = len(s & t)
            if a is not None and b is not None and both \
                    and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: find(k) for k in up}, {(k, len(s)) for k, s in rows}


def variants(n, seed, words=60):
    """Texts around a few originals, with one to many words changed."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    bases = [[word() for _ in range(words)] for _ in range(4)]
    out = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 1, 1, 2, 3, 8])):
            w[r.randrange(len(w))] = word()
        out.append((i * 3 + 1, r.choice([" ", "\n", " \t "]).join(w)))
    return out


def check(spark, data, percent=85, **settings):
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = N.near_duplicates(docs, percent=percent, **settings).collect()
    comps, sizes = brute(data, percent)
    assert len(got) == len(data)
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    for r in got:
        assert r.component_id == comps.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_near_copies(spark):
    check(spark, variants(120, 1))
    check(spark, variants(120, 2), percent=80, bands=42, rows=6)


def test_small_blocks_lose_nothing(spark):
    check(spark, variants(150, 3), block=4)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "a b c d e"),
            (7, "A b\tc d e"), (8, long), (9, long + " end"), (None, "a b c d e"), (10, "É b"),
            (11, "é b"), (6, "a b c d e"), (20, "x1 x2 x3 x4 x5"), (20, "y1 y2 y3 y4 y5"),
            (21, "y1 y2 y3 y4 y5")]
    check(spark, rows[:-3])
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'clash' AS rep", "1 AS component_id", "2 AS n")
    got = {(r.doc_id, r.component_id) for r in N.near_duplicates(docs).collect()}
    assert (21, 20) in got and (20, 20) in got
    kept = N.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 10, 11, 20]
    assert N.near_duplicates(docs.limit(0)).count() == 0
    assert N.without_near_duplicates(docs.limit(0)).count() == 0


def test_signature_agreement_estimates_similarity():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 1 << 62, 400, dtype=np.uint64)) for _ in range(30)]
    for share in (0.5, 0.85):
        got = []
        for s in sets:
            cut = int(len(s) * 2 * share / (1 + share))
            other = np.unique(np.concatenate([s[:cut], r.integers(
                0, 1 << 62, len(s) - cut, dtype=np.uint64)]))
            true = len(np.intersect1d(s, other)) / len(np.union1d(s, other))
            sig = N.signatures([s, other], 256)
            got.append((sig[0] == sig[1]).mean() - true)
        assert abs(np.mean(got)) < 0.015 and np.std(got) < 0.05


def test_shingle_hashes_do_not_collide():
    texts = [f"a b c d {i} f g" for i in range(3000)]
    found = {int(x) for s in shingle_sets([t.encode() for t in texts]) for x in s}
    assert len(found) == 9000


def test_components(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [
        (r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(150)]
    got = {x.node: x.component for x in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {k: k for e in edges for k in e}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert got == {k: find(k) for k in up if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_of_each_text_of_an_id(spark):
    """An id with several texts is linked through each of them, also where it is
    a bucket's first."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    for block in (512, 4):
        rows = []
        for i in range(12):
            base = [word() for _ in range(200)]
            texts = [base, base[:185] + [word() for _ in range(15)],
                     [word() for _ in range(15)] + base[15:]]
            hub = 100 * i + (0 if i % 3 else 50)
            for k, text in enumerate(texts):
                near = list(text)
                near[60 * k + 5] = "other"
                rows += [(hub, " ".join(text)), (100 * i + 10 + k, " ".join(near))]
        r.shuffle(rows)
        check(spark, rows, block=block)


def test_sql_form_gives_the_same_rows(spark):
    import duckdb

    from tickwise.llm.catalog import op9_minhash_near_duplicates
    from tickwise.llm.neardup import NEAR_SQL

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = op9_minhash_near_duplicates(spark, sf)
    assert sorted(con.execute(NEAR_SQL).fetchall()) == sorted(map(tuple, got.collect()))
