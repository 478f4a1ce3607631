"""Recall against all pairs; ties, odd rows, skew."""

import numpy as np

from tickwise.llm import ann as A
from tickwise.llm.common import table

SF = "/root/testdata/sf0.1"


def exact(ids, x, q, k):
    s = (x * x[q]).sum(1)
    s[ids == ids[q]] = -np.inf
    order = np.lexsort((ids, -s))[:k]
    return [(int(ids[i]), s[i]) for i in order if np.isfinite(s[i])]


def recall(rows, ids, x, every, k):
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    share = []
    for q in np.flatnonzero(ids % every == 0):
        want, mine = exact(ids, x, q, k), got[int(ids[q])]
        assert len(mine) == len(want)
        at = {int(v): i for i, v in enumerate(ids)}
        for (v, s), after in zip(mine, mine[1:] + [(None, -np.inf)]):
            assert abs(s - float(x[q] @ x[at[v]])) < 1e-12 and s >= after[1]
            assert s > after[1] or v < after[0]
        share.append(len({v for v, _ in want} & {v for v, _ in mine}) / max(1, len(want)))
    return np.array(share)


def test_embeddings(spark):
    t = table(spark, SF, "embeddings")
    rows = t.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    share = recall(A.search(t).collect(), ids, x, 20, 20)
    assert share.mean() > 0.95 and share.min() >= 0.5


def test_few_lists_and_a_hot_vector(spark, monkeypatch):
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 16)) * r.uniform(0.2, 3, size=(1500, 1))
    x[400:900] = x[400]
    x = x.astype(np.float32).astype(float)
    ids = r.permutation(1500)
    monkeypatch.setattr(A, "LEAST", 8)
    monkeypatch.setattr(A, "BLOCK", 64)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)],
                               "vec_id long, embedding array<float>")
    share = recall(A.search(df, probes=12).collect(), ids, x, 20, 20)
    assert share.mean() > 0.9
    hot = [q for q in np.flatnonzero(ids % 20 == 0) if 400 <= q < 900]
    got = {(r.query_id, r["rank"]): r.vec_id for r in A.search(df, probes=12).collect()}
    for q in hot[:5]:
        assert [got[(int(ids[q]), i + 1)] for i in range(20)] == [
            v for v, _ in exact(ids, x, q, 20)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]),
            (20, [nan, 1.0]), (40, [inf, 1.0]), (60, [None, 1.0]), (None, [1.0, 1.0]),
            (80, [-1.0, 0.0]), (2, [2.0, 1.0]), (100, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS rank", "2 AS list", "3 AS score")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in A.search(df).collect())
    assert got == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 80, -1.0),
                   (80, 1, 0, -1.0), (80, 2, 1, -1.0), (80, 3, 2, -2.0)]
    assert A.search(df.limit(0)).count() == 0


def test_centroid_search_is_near_exact():
    r = np.random.default_rng(2)
    c = A.Centroids(r.normal(size=(200, 24)), 1.0)
    x = r.normal(size=(100, 24)).astype(np.float32)
    at, far = c.nearest(x)
    true = np.argsort(A._distances(x, c.points), axis=1)
    assert np.mean([len(set(a[:16]) & set(b[:16])) / 16 for a, b in zip(at, true)]) > 0.97
    assert (np.diff(far, axis=1) >= 0).all()


def test_lists_are_balanced():
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(900, 8)) * 0.05, r.normal(size=(300, 8)) + 5])
    c = A.balanced_centroids(x, 30)
    size = np.bincount(A._distances(x, c).argmin(1), minlength=len(c))
    assert size.max() <= 3 * A.SPLIT * len(x) / 30
    assert len(A.balanced_centroids(np.ones((50, 4)), 10)) == 1


def share_and_recall(x, every=20, k=20):
    """Part of all pairs that a search compares, and each query's recall."""
    sample = x[np.random.default_rng(0).permutation(len(x))[:A.SAMPLE]]
    c = A.fit(sample, len(x), float((x * x).sum(1).max()), k)
    row, to = np.concatenate([np.stack(c.posts(x[a:a + 256])) + [[a], [0]]
                              for a in range(0, len(x), 256)], axis=1)
    q = np.arange(0, len(x), every)
    take = np.concatenate([c.asks(x[q[a:a + 256]]) for a in range(0, len(q), 256)])
    size = np.bincount(to, minlength=len(c.points))
    on = np.zeros((len(x), len(c.points)), bool)
    on[row, to] = True
    score = x[q] @ x.T
    score[np.arange(len(q)), q] = -np.inf
    true = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return (take @ size).mean() / len(x), np.array(
        [(on[t] & take[i]).any(1).mean() for i, t in enumerate(true)])


def test_clustered_vectors_are_pruned():
    r = np.random.default_rng(5)
    centres = r.normal(size=(400, 64))
    x = centres[r.integers(0, 400, 12_000)] + 0.5 * r.normal(size=(12_000, 64))
    share, recall = share_and_recall(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert share <= 0.15 and recall.mean() >= 0.95 and recall.min() >= 0.8


def test_without_clusters_the_ratio_keeps_the_recall():
    r = np.random.default_rng(6)
    x = r.normal(size=(4000, 32))
    share, recall = share_and_recall(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert share < 0.9 and recall.mean() >= 0.94 and recall.min() >= 0.5


def test_rows_of_one_id_are_one_query_and_one_candidate(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 0.5]), (1, [0.1, 2.0]),
            (1, [3.0, 0.5]), (2, [0.0, 2.5]), (3, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, A.search(df, every=20, k=3).collect()))
    assert got == [(0, 1, 1, 3.0), (0, 2, 2, 2.5), (0, 3, 3, -1.0)]


def test_shelves_hold_lists_in_a_row(monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 10)
    assert A.shelves([(0, 4), (1, 5), (2, 25), (4, 3)], 5).tolist() == [0, 0, 1, 2, 2]


def test_rows_found_do_not_grow_with_the_shelves(spark, monkeypatch):
    r = np.random.default_rng(7)
    x = r.normal(size=(3000, 24))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    sent, keep = [], A.stored

    def stored(rows, label):
        kept = keep(rows, label)
        if label.startswith("found"):
            sent.append(kept.count())
        return kept

    monkeypatch.setattr(A, "BLOCK", 48)                 # over 60 shelves
    monkeypatch.setattr(A, "stored", stored)
    share = recall(A.search(df).collect(), np.arange(3000), x, 20, 20)
    assert share.mean() >= 0.95
    assert sum(sent) <= 150 * 20 * 15                   # for 150 queries of 20
