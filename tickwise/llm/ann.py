"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample and split until none holds much more
than its share of it. Every vector is posted to its nearest centroid's list,
and a boundary vector also to further lists whose centroids are almost as near.
A search walks a graph of the centroids in memory, keeps the lists whose
centroids are within a distance ratio of the nearest one, and compares the
query with every vector on those lists, exactly. The ratio is the smallest that
finds the wanted share of the sample's own neighbours: clustered vectors need few
lists, vectors without clusters need many, and no cap hides that.

Largest inner product becomes nearest distance by one more coordinate that
gives all vectors the same length (queries get 0 there). Lists that lie close
stand on one shelf, and a query goes once to each shelf that holds any of its
lists; shelf and queries meet in blocks of bounded size, so a list that holds a
third of all vectors is split over tasks. A query's few nearest lists are searched
first: from the others, only vectors not below the k-th best of those are sent on,
so that the rows found follow the queries and not the shelves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import hashed_sample, lean, mix31, ship, stored

SAMPLE = 20_000          # vectors that the centroids are fitted on
LIST = 48                # vectors on a list, about, before replication
FIT = 10                 # sampled vectors for each centroid, at least
SPLIT = 2.0              # a list over this share of the mean is split
REPLICAS = 4             # lists a boundary vector is posted to, at most
BOUNDARY = 1.03         # ratio of distances within which it is posted
RECALL = 0.97            # of the sample's neighbours, found by the ratio of distances
JUDGED = 512             # sampled vectors whose neighbours set the ratio
LEAST = 8                # lists that a query searches in any case
FIRST = 3                # of them, those searched first, for a bound on the others
DEGREE, BEAM = 24, 96    # of the centroid graph and of its search
POST_BEAM = 16           # of the search for a vector's lists
STEP = 8                 # centroids that a walk expands at once, at most
BLOCK = 4096             # vectors, and queries, that meet in one task at a time


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return np.maximum(d, 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Number of each row's nearest centroid."""
    return np.concatenate([_distances(x[a:a + 2048], c).argmin(1)
                           for a in range(0, len(x), 2048)])


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        order = np.argsort(own, kind="stable")
        used, first = np.unique(own[order], return_index=True)
        n = np.diff(np.append(first, len(own)))
        c[used] = np.add.reduceat(x[order], first, axis=0) / n[:, None]
    return c, _nearest(x, c)


def balanced_centroids(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Centroids of ``x``; a cluster of more than SPLIT times the mean size is
    split again, unless its vectors are all alike."""
    if not len(x):
        return x
    most = max(2.0, SPLIT * len(x) / k)
    out, work = [], [(x, k)]
    while work:
        part, n = work.pop()
        n = min(n, len(np.unique(part, axis=0)))
        if n <= 1:
            out.append(part.mean(0))
            continue
        c, own = _kmeans(part, n, seed)
        for i in range(n):
            mine = part[own == i]
            if len(mine) > most and len(mine) < len(part):
                work.append((mine, int(np.ceil(len(mine) / most))))
            elif len(mine):
                out.append(c[i])
    return np.array(out)


class Centroids:
    """Centroids with a neighbour graph, searched by a beam from an entry. They
    lie on the sphere of the vectors: else the shorter mean of a loose cluster
    would be near to every query. Centroids that lie close have close numbers."""

    def __init__(self, points: np.ndarray, radius2: float):
        length = np.linalg.norm(points, axis=1, keepdims=True)
        points = points / np.where(length > 0, length, 1) * np.sqrt(radius2)
        if len(points) > 2:
            part = _kmeans(points, int(np.sqrt(len(points))), 1)[1]
            points = points[np.argsort(part, kind="stable")]
        self.points, self.radius2 = points.astype(np.float32), radius2
        self.norms = (self.points ** 2).sum(1)
        self.ratio, self.base2 = np.inf, 0.0
        d = _distances(self.points, self.points)
        near = np.argsort(d, axis=1, kind="stable")[:, :DEGREE + 1]
        # both directions of each edge, the nearest of them, and a chain so that all
        # connect; padded
        edges: list[set[int]] = [set(map(int, r)) for r in near]
        for i, r in enumerate(near):
            for j in r:
                edges[int(j)].add(i)
        edges = [set(sorted(e, key=lambda j, i=i: d[i, j])[:2 * DEGREE])
                 for i, e in enumerate(edges)]
        for i in range(len(points) - 1):
            edges[i].add(i + 1)
            edges[i + 1].add(i)
        width = max((len(e) for e in edges), default=1)
        self.graph = np.array([sorted(e) + [i] * (width - len(e))
                               for i, e in enumerate(edges)]).reshape(len(points), width)
        self.entry = int(_distances(self.points.mean(0)[None], self.points).argmin()) \
            if len(points) else 0

    def walk(self, x: np.ndarray, beam: int = BEAM, ratio: float = 0.0) -> np.ndarray:
        """Squared distance of each row of ``x`` to each centroid met, infinite for
        the others. All rows walk the graph in step, and go on while a centroid that is
        not expanded is among the ``beam`` nearest or within ``ratio`` of the nearest."""
        k, n = len(self.points), len(x)
        beam, step = min(beam, k), min(STEP, k)
        own = (x ** 2).sum(1)
        far = np.full((n, k), np.inf, np.float32)
        done = np.zeros((n, k), bool)
        far[:, self.entry] = own - 2 * x @ self.points[self.entry] + self.norms[self.entry]
        rows = np.arange(n)
        while len(rows):
            met = far[rows]
            limit = np.partition(met, beam - 1, axis=1)[:, beam - 1]
            if ratio:
                limit = np.maximum(limit, self.reach2(met.min(1), ratio))
            left = np.where(done[rows], np.inf, met)
            at = np.argpartition(left, step - 1, axis=1)[:, :step]
            value = np.take_along_axis(left, at, 1)
            go = np.isfinite(value) & (value <= limit[:, None])
            row, col = np.nonzero(go)
            node, row = at[row, col], rows[row]
            done[row, node] = True
            for a in range(0, len(row), 2048):          # bounded gathers
                r, to = row[a:a + 2048], self.graph[node[a:a + 2048]]
                far[r[:, None], to] = np.maximum(own[r, None] + self.norms[to] - 2 * np.matmul(
                    self.points[to], x[r][:, :, None])[:, :, 0], 0)
            rows = rows[go.any(1)]
        return far

    def nearest(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance), nearest first, of the beam's centroids
        for each row of ``x``."""
        far = self.walk(x, beam)
        order = np.argsort(far, axis=1, kind="stable")[:, :min(beam, len(self.points))]
        return order, np.take_along_axis(far, order, 1)

    def reach2(self, nearest2: np.ndarray, ratio: float) -> np.ndarray:
        """Squared distance within which lists are searched. Next to a centroid the
        ratio alone would leave only that one, so a distance below the usual one (the
        sample's median) counts as that."""
        return np.maximum(nearest2, self.base2) * ratio ** 2 + 1e-6 * self.radius2

    def sphere(self, v: np.ndarray, queries: bool = False) -> np.ndarray:
        more = np.zeros(len(v)) if queries else np.sqrt(
            np.maximum(self.radius2 - (v * v).sum(1), 0))
        return np.concatenate([v, more[:, None]], 1).astype(np.float32)

    def posts(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that vectors are posted to."""
        at, far = self.nearest(self.sphere(v), POST_BEAM)
        take = far <= far[:, :1] * BOUNDARY ** 2 + 1e-6 * self.radius2
        take[:, REPLICAS:] = False
        row, col = np.nonzero(take)
        return row, at[row, col]

    def asks(self, v: np.ndarray, probes: int | None = None) -> np.ndarray:
        """Which lists each query searches, one row of flags for each."""
        return self.asked(v, probes)[0]

    def asked(self, v: np.ndarray, probes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flags of the lists that each query searches, and of those it searches first:
        the FIRST nearest."""
        far = self.walk(self.sphere(v, True), ratio=self.ratio)
        take = far <= self.reach2(far.min(1), self.ratio)[:, None]
        place = far.argsort(1, kind="stable").argsort(1, kind="stable")
        take |= (place < LEAST) & np.isfinite(far)
        if probes:
            take &= place < probes
        return take, take & (place < FIRST)

    def fit_ratio(self, x: np.ndarray, k: int, recall: float) -> None:
        """The smallest ratio by which ``recall`` of the ``k`` neighbours, among the
        sampled vectors ``x``, of JUDGED of them stand on a list that is searched."""
        q = x[:JUDGED]
        score = q @ x.T
        score[np.arange(len(q)), np.arange(len(q))] = -np.inf
        k = min(k, len(x) - 1)
        if k < 1:
            return
        true = np.argpartition(-score, k - 1, axis=1)[:, :k]
        far = _distances(self.sphere(q, True), self.points)
        self.base2 = float(np.median(far.min(1)))
        near = np.maximum(far.min(1), self.base2)
        lists = np.full((len(x), REPLICAS), -1)
        for a in range(0, len(x), 256):
            row, to = self.posts(x[a:a + 256])
            first = np.searchsorted(row, row)
            lists[a + row, np.arange(len(row)) - first] = to
        lists = np.where(lists < 0, lists[:, :1], lists)
        need = far[np.arange(len(q))[:, None, None], lists[true]].min(2) / near[:, None]
        self.ratio = max(1.0, float(np.sqrt(np.quantile(need, recall, method="higher"))))


def fit(x: np.ndarray, total: int, radius2: float, k: int, recall: float = RECALL) -> Centroids:
    """Centroids for a table of ``total`` vectors, from the sampled vectors ``x``. The
    sample's neighbours stand for the table's: as many of them as fall to it."""
    lists = max(1, min(total // LIST, len(x) // FIT))
    z = np.concatenate([x, np.sqrt(np.maximum(radius2 - (x * x).sum(1), 0))[:, None]], 1)
    c = Centroids(balanced_centroids(z, lists), radius2)
    c.fit_ratio(x, int(np.ceil(k * len(x) / total)), recall)
    return c


def shelves(sizes: list[tuple[int, int]], lists: int) -> np.ndarray:
    """Shelf of each list: lists in a row share one, up to BLOCK vectors; a longer
    list has one of its own."""
    size = np.zeros(lists, np.int64)
    for i, n in sizes:
        size[i] = n
    out, shelf, held = np.zeros(lists, np.int32), 0, 0
    for i, n in enumerate(size):
        if held and held + n > BLOCK:
            shelf, held = shelf + 1, 0
        out[i] = shelf
        held += int(n)
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    return np.array([v.values.to_numpy(zero_copy_only=False) for v in column], np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v)
                    & (F.abs(v) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          e.cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & fine
        & F.exists(e, lambda v: v != 0))


def search(vectors: DataFrame, every: int = 20, k: int = 20, sample: int = SAMPLE,
           probes: int | None = None, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by
    ``every``, the ``k`` rows found with the largest inner product, in double
    precision on the given vectors, nearest first, ties to the smaller vec_id.

    Rows whose vector is null, empty, zero or holds null or non-finite
    components take no part, nor do rows without id; vectors shorter or longer
    than most are compared only with others of their length. Rows of one id are
    one query and one candidate: two ids score the largest product of any of their
    rows, and an id is listed once. A query with fewer candidates than ``k`` on
    its lists searches all lists. ``probes``, if given, bounds the lists that a
    query searches. Other columns are ignored; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors)
    sizes = [r[0] for r in rows.groupBy(F.size("embedding").alias("d")).count()
             .orderBy("d").collect()]                     # one row for each length
    out = None
    for d in sizes:
        part = _search(rows.where(F.size("embedding") == d), every, k, sample, probes, recall)
        out = part if out is None else out.union(part)
    return out if out is not None else rows.select(
        F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
        F.lit(0.0).alias("score"))


def _search(rows: DataFrame, every: int, k: int, sample: int, probes: int | None,
            recall: float) -> DataFrame:
    spark = rows.sparkSession
    longest = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v * v)
    total, radius2 = rows.agg(F.count(F.lit(1)), F.max(longest)).first()
    # the sample: rows with the smallest hashes, for any size of the table
    chosen = hashed_sample(rows, "vec_id", sample, total)
    x = np.array([r["embedding"] for r in chosen.select("embedding").collect()], np.float64)
    centroids = fit(x, total, float(radius2), k, recall)
    shared = spark.sparkContext.broadcast(centroids)               # bounded by the sample

    @lean
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                ids, raw = batch.column(0).slice(a, 256), batch.column(1).slice(a, 256)
                row, to = shared.value.posts(_vectors(raw))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(to.astype(np.int32)),
                     raw.take(pa.array(row))], names=["vec_id", "list", "embedding"])

    posted = stored(rows.mapInArrow(post, "vec_id long, list int, embedding array<double>"),
                    "postings")
    sizes = [(r[0], r[1]) for r in posted.groupBy("list").count().collect()]
    shelf = shelves(sizes, len(centroids.points))                  # a number for each list

    def ask(everything: bool):
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    ids, raw = batch.column(0).slice(a, 256), batch.column(1).slice(a, 256)
                    if everything:
                        take = np.ones((len(ids), len(c.points)), bool)
                        near = np.zeros_like(take)
                    else:
                        take, near = c.asked(_vectors(raw), probes)
                    for first, flags in ((True, near), (False, take & ~near)):
                        row, to = np.nonzero(flags)
                        # shelves ascend with lists: one run for each query and shelf
                        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1])
                                                   | (shelf[to[1:]] != shelf[to[:-1]])]
                                             [:len(row)])
                        lists = pa.ListArray.from_arrays(
                            pa.array(np.append(new, len(row)).astype(np.int32)),
                            pa.array(to.astype(np.int32)))
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(row[new])), pa.array(shelf[to[new]]), lists,
                             raw.take(pa.array(row[new])), pa.array([first] * len(new), pa.bool_())],
                            names=["vec_id", "shelf", "lists", "embedding", "first"])
        return run

    schema = "vec_id long, shelf int, lists array<int>, embedding array<double>, first boolean"
    queries = rows.where(F.col("vec_id") % every == 0)
    where = F.broadcast(spark.createDataFrame(
        list(enumerate(shelf.tolist())), "list int, shelf int"))
    posted = posted.join(where, "list")
    asked = stored(queries.mapInArrow(ask(False), schema), "probes")
    # the k-th best of the first lists bounds what the others have to send: a vector
    # below it is none of the k nearest
    no_bound = F.lit(float("-inf"))
    near = stored(_compare(posted, asked.where("first").withColumn("bound", no_bound), k),
                  "found_first")
    worst = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = (near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
              .withColumn("n", F.row_number().over(worst)).where(F.col("n") == k)
              .select(F.col("query_id").alias("vec_id"), F.col("score").alias("_bound")))
    others = (asked.where("not first").join(bounds, "vec_id", "left")
              .withColumn("bound", F.coalesce("_bound", no_bound)).drop("_bound"))
    found = near.union(stored(_compare(posted, others, k), "found"))
    # fewer than asked for: search every list (few queries, or a small table)
    some = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n"))
    short = queries.join(some.where(F.col("n") >= min(k, total - 1)),
                         F.col("vec_id") == F.col("query_id"), "left_anti")
    every_list = stored(short.mapInArrow(ask(True), schema), "short")
    rest = _compare(posted, every_list.withColumn("bound", no_bound), k)
    every_one = found.union(rest).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every_one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def _compare(posted: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Each query's best ``k``, of those not below its bound, within each block of a
    shelf it searches."""
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int")
                                       .alias(name))

    def split(n: str, salt: int) -> Column:
        return F.pmod(mix31(F.col("vec_id") + F.lit(salt)), F.col(n)).cast("int")

    # two numbers for each shelf; there are no more shelves than lists
    sizes = blocks(posted, "vb").join(blocks(asked, "qb"), "shelf")
    left = (posted.join(F.broadcast(sizes), "shelf")
            .withColumn("v", split("vb", 3))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))))
    right = (asked.join(F.broadcast(sizes), "shelf")
             .withColumn("q", split("qb", 5))
             .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("vb") - 1))))

    def meet(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out_q, out_v, out_s = [], [], []
        if not vectors.empty and not queries.empty:
            order = np.argsort(vectors["list"].to_numpy(), kind="stable")
            lists, ids = (vectors[c].to_numpy()[order] for c in ("list", "vec_id"))
            x = np.stack(vectors["embedding"].to_numpy()[order])
            names, start = np.unique(lists, return_index=True)
            stop = np.append(start[1:], len(lists))
            # an id may stand on several lists, or on several rows
            by_id = np.argsort(ids, kind="stable")
            own, first = np.unique(ids[by_id], return_index=True)
            last = np.append(first[1:], len(ids))
            asked_ids = queries["vec_id"].to_numpy()
            y, wanted = np.stack(queries["embedding"].to_numpy()), queries["lists"].to_numpy()
            bound = queries["bound"].to_numpy()
            # sums in another order differ in their last bits
            least = bound - 1e-9 * (1 + np.abs(np.where(np.isfinite(bound), bound, 0)))
        for a in range(0, len(queries) if not vectors.empty else 0, 256):
            part = wanted[a:a + 256]
            row = np.repeat(np.arange(len(part)), [len(w) for w in part])
            flat = np.concatenate(part)
            at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
            on = names[at] == flat                      # empty lists are on no shelf
            member = np.zeros((len(part), len(names)), bool)
            member[row[on], at[on]] = True
            score = np.full((len(part), len(ids)), -np.inf)
            for j in range(len(names)):
                who = np.flatnonzero(member[:, j])
                if len(who):
                    score[who, start[j]:stop[j]] = y[a + who] @ x[start[j]:stop[j]].T
            score = np.maximum.reduceat(score[:, by_id], first, axis=1)
            score[asked_ids[a:a + 256, None] == own[None, :]] = -np.inf
            for i, s in enumerate(score):
                met = np.flatnonzero(np.isfinite(s) & (s >= least[a + i]))
                n = min(k, len(met))
                if not n:
                    continue
                cut = np.partition(s[met], len(met) - n)[len(met) - n]
                # the product's last bits depend on a row's place: all near the
                # cut are summed again, each in the same order
                some = met[s[met] >= cut - 1e-9 * (1 + abs(cut))]
                rows = np.concatenate([by_id[first[u]:last[u]] for u in some])
                each = np.append(0, np.cumsum(last[some] - first[some])[:-1])
                exact = np.maximum.reduceat((x[rows] * y[a + i]).sum(axis=1), each)
                top = np.argsort(-exact, kind="stable")[:n]   # ids ascend: ties to smaller
                top = top[exact[top] >= bound[a + i]]
                out_s.append(exact[top])
                out_q.append(np.full(len(top), asked_ids[a + i]))
                out_v.append(own[some[top]])
        return pd.DataFrame({name: np.concatenate(parts) if parts else [] for name, parts in
                             (("query_id", out_q), ("vec_id", out_v), ("score", out_s))})

    return (left.select("shelf", "v", "q", "list", "vec_id", "embedding")
            .groupBy("shelf", "v", "q")
            .cogroup(right.select("shelf", "v", "q", "lists", "vec_id", "embedding", "bound")
                     .groupBy("shelf", "v", "q"))
            .applyInPandas(meet, "query_id long, vec_id long, score double"))
