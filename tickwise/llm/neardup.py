"""Near-duplicate documents by circulant MinHash and exact verification.

Two permutations make all coordinates of a signature: shingles are first
permuted to 32-bit places, and coordinate k is the smallest value of one second
permutation shifted by k places round the circle. Coordinates are banded, equal
bands make buckets, and every pair within a bucket is verified on full shingle
sets. With 36 bands of 7, a pair at similarity 0.85 shares no band with
probability (1 - 0.85^7)^36 = 9e-7, and at 0.8 with 2e-4.

Texts with equal shingle sets are one class, with the smallest doc_id as its
representative, before any pairing. Then all members of a bucket are compared
with its first, and only buckets whose members are not joined by that with each
other, in blocks, so that no task gets a whole bucket; a task sends only links
that join texts it has not joined yet, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import if_small, lean, mix31, ship, stored, texts_of
from tickwise.llm.components import components
from tickwise.llm.shingles import WIDTH, mix64, shingle_sets

BANDS = 36
ROWS = 7
#: Members of a block; a task verifies the pairs of two blocks at a time.
BLOCK = 512


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash signatures, one row for each non-empty set."""
    place = np.concatenate([(mix64(s ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32))
                            .astype(np.uint32) for s in sets])
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), size), np.uint32)
    x, y = np.empty_like(place), np.empty_like(place)
    for k in range(size):
        np.add(place, np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF), out=x)   # shift round 2^32
        for right, by in ((16, 0x7FEB352D), (15, 0x846CA68B)):         # the permutation
            np.right_shift(x, np.uint32(right), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(by), out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    key = np.zeros((len(signature), bands), np.uint64)
    cut = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        key = mix64(key + cut[:, :, r].astype(np.uint64) + np.uint64(r + 1))
    return mix64(key + np.arange(bands, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _fingerprint(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


_SIGNED = "doc_id long, n_shingles long, class binary, bands array<long>"


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, class (fingerprint of the set) and band keys of every
    row; class and bands are null and empty for texts without words."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch.column(1)), batch.column(0)
            for a in range(0, len(texts), 256):
                sets = shingle_sets(texts[a:a + 256], width)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = np.zeros((0, bands), np.uint64)
                if full:
                    # a few texts at a time, to keep a signature's passes in cache
                    parts, held, size = [], [], 0
                    for i in full:
                        held.append(sets[i])
                        size += len(sets[i])
                        if size > 60_000:
                            parts.append(signatures(held, bands * rows))
                            held, size = [], 0
                    if held:
                        parts.append(signatures(held, bands * rows))
                    keys = band_keys(np.concatenate(parts), bands, rows)
                counts = np.zeros(len(sets), np.int32)
                counts[full] = bands
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                        pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["doc_id", "n_shingles", "class", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(lean(run), _SIGNED)


def _runs(members: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Members in order of set size, cut where no pair across the cut can reach
    the similarity."""
    order = np.lexsort((members, sizes))
    members, sizes = members[order], sizes[order]
    cut = np.flatnonzero(100 * sizes[:-1] < percent * sizes[1:]) + 1
    for run in np.split(members, cut):
        if len(run) > 1:
            yield np.sort(run)


def links_within(names: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with ``100 * intersection >= percent * union``."""
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    made = []

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            if names[i] != names[j]:
                made.append((names[i], names[j]))

    if len(sets) <= 12:
        for i in range(len(sets)):
            for j in range(i):
                if find(i) != find(j) and _similar(sets[i], sets[j], percent):
                    join(i, j)
        return made
    # counts of shared shingles for all pairs, some shingles at a time
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(at) > 1
    place = np.cumsum(shared) - 1
    keep = shared[at]
    at, owner = place[at[keep]], owner[keep]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    total = int(shared.sum())
    for a in range(0, total, 16384):
        lo, hi = np.searchsorted(at, (a, a + 16384))
        part = np.zeros((len(sets), min(16384, total - a)), np.float32)
        part[owner[lo:hi], at[lo:hi] - a] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    for i, j in np.argwhere(np.tril(100 * both >= percent * union, -1)).tolist():
        join(i, j)
    return made


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS,
                    width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked where ``100 * intersection >= percent * union`` of
    their sets; a component is named by its smallest doc_id, which is the one
    kept. Texts without words (null, empty, blank) are linked with nothing.
    Rows with one id are rows of one node; a row without id is linked with
    nothing and gets a null component and is kept. Other columns are ignored;
    an empty input gives no rows.
    """
    rows_ = stored(signed(docs, bands, rows, width), "signed")
    real = rows_.where("class is not null and doc_id is not null")
    # one row for each different set; equal sets have equal bands
    classes = stored(real.groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    found = stored(_links(docs, classes, percent, width, block), "verified")
    # rows of one id with different texts are rows of one node
    several = (real.groupBy("doc_id").agg(F.min("class").alias("c"), F.max("class").alias("d"))
               .where("c <> d").select("doc_id"))
    same_id = (real.join(several, "doc_id").select("doc_id", "class")
               .join(classes.select("class", "rep"), "class")
               .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    named = components(found.union(same_id))
    of = (classes.select("class", "rep")
          .join(named.withColumnRenamed("node", "rep"), "rep", "left")
          .select("class", F.coalesce("component", "rep").alias("_component")))
    return (rows_.join(of, "class", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                           F.lit(True))))


def _links(docs: DataFrame, classes: DataFrame, percent: int, width: int,
           block: int) -> DataFrame:
    """(a, b) verified links between representatives that connect all linked ones.
    Sets are told apart by the number of their class (``node``): an id on rows
    with different texts may represent several.

    First every member of a bucket is compared with the bucket's smallest one,
    which joins a dense group in time linear in its size. Then, in buckets that
    still hold several components, the members are compared with each other,
    without that smallest one.
    """
    member = classes.select(F.explode("bands").alias("key"), "rep", "node", "n")
    bucket = (member.groupBy("key").agg(F.count(F.lit(1)).alias("m"),
                                        F.min(F.struct("rep", "node", "n")).alias("lead"))
              .where("m > 1").select("key", "lead"))
    inside = stored(member.join(bucket, "key").where("node <> lead.node"), "buckets")
    near = (100 * F.least("n", "lead.n") >= percent * F.greatest("n", "lead.n"))
    star = stored(inside.where(near).select(F.col("lead.node").alias("lead"), "node").distinct(),
                  "stars")
    active = stored(inside.select("node").union(star.select("lead")).distinct()
                    .join(classes.select("node", "rep", "class"), "node"), "active")
    sets = stored(_full_sets(docs, if_small(active), width), "sets")

    size = star.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * block)).cast("int")
                                    .alias("parts"))
    part = F.pmod(mix31(F.col("node") + F.lit(17)), F.col("parts")).cast("int")
    spokes = star.join(size, "lead").select(
        F.xxhash64("lead", part).alias("group"), "node", F.lit(1).alias("place"))
    hubs = (size.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(F.xxhash64("lead", "part").alias("group"), F.col("lead").alias("node"),
                    F.lit(0).alias("place")))
    first = stored(_verified(spokes.union(hubs), sets, percent, _links_to_first), "first")

    named = components(first)
    rest = (inside.join(named.withColumnRenamed("node", "rep"), "rep", "left")
            .select("key", "node", "n", F.coalesce("component", "rep").alias("own")))
    crowd = F.ceil(F.col("m") / F.lit(block)).cast("int")
    several = (rest.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("own").alias("c"),
                                       F.max("own").alias("d"))
               .where("c <> d").select("key", crowd.alias("blocks")))
    placed = (rest.join(several, "key")
              .withColumn("mine", F.pmod(mix31(F.col("node") + F.lit(17)),
                                         F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("mine", "other").alias("x"),
                      F.greatest("mine", "other").alias("y"), "node", "n", "own"))
    lists = placed.groupBy("key", "x", "y").agg(
        F.collect_list("node").alias("nodes"), F.collect_list("n").alias("sizes"),
        F.collect_list("own").alias("owns"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for nodes, sizes, owns in zip(*batch.columns):
                nodes, owns = nodes.values.to_numpy(), owns.values.to_numpy()
                of = dict(zip(nodes.tolist(), owns.tolist()))
                out += [run for run in _runs(nodes, sizes.values.to_numpy(), percent)
                        if len({of[x] for x in run.tolist()}) > 1]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))],
                                             names=["nodes"])

    # most buckets of a text hold the same texts: each list is verified once
    groups = stored(lists.select("nodes", "sizes", "owns").mapInArrow(split, "nodes array<long>")
                    .distinct().select(F.xxhash64("nodes").alias("group"),
                                       F.explode("nodes").alias("node"),
                                       F.lit(0).alias("place")), "groups")
    return first.union(_verified(groups, sets, percent, links_within))


def _full_sets(docs: DataFrame, active: DataFrame, width: int) -> DataFrame:
    """node, rep, shingles: the whole sets of the active classes."""
    texts = (docs.select(F.col("doc_id").cast("long").alias("rep"),
                         F.col("text").cast("string").alias("text")).join(active, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = texts_of(batch.column("text"))
            for a in range(0, len(texts_), 256):
                # an id may stand on several rows: the one of this class counts
                hit = [(i, s) for i, s in enumerate(shingle_sets(texts_[a:a + 256], width))
                       if _fingerprint(s) == batch.column("class")[a + i].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(c)[a + i].as_py() for i, _ in hit], pa.int64())
                     for c in ("node", "rep")]
                    + [pa.array([s.tobytes() for _, s in hit], pa.binary())],
                    names=["node", "rep", "shingles"])

    return texts.select("node", "rep", "class", "text").mapInArrow(
        lean(run), "node long, rep long, shingles binary")


def _verified(groups: DataFrame, sets: DataFrame, percent: int, links) -> DataFrame:
    """Links found by ``links`` within each group (group, node, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, held = None, [], []
        for batch in batches:
            out = []
            for g, name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2)):
                if g != group:
                    out += links(names, held, percent)
                    group, names, held = g, [], []
                names.append(name)
                held.append(np.frombuffer(raw.as_py(), np.uint64))
            yield _pairs(out)
        yield _pairs(links(names, held, percent))

    return (groups.join(sets, "node").select("group", "rep", "shingles", "place")
            .repartition("group").sortWithinPartitions("group", "place")
            .select("group", "rep", "shingles").mapInArrow(run, "a long, b long").distinct())


def _links_to_first(names: list[int], sets: list[np.ndarray], percent: int) \
        -> list[tuple[int, int]]:
    """The first set's links to the others."""
    return [(names[0], name) for name, s in zip(names[1:], sets[1:])
            if name != names[0] and _similar(sets[0], s, percent)]


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                       pa.array([x[1] for x in found], pa.int64())],
                                      names=["a", "b"])


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest doc_id. Of rows that repeat the kept id, one stays, with the
    smallest text; a row without id stays."""
    found = stored(near_duplicates(docs, **settings), "near")
    # an id has one component; an id on several rows needs a choice among them
    by_id = (found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.count(F.lit(1)).alias("_rows"), F.max("kept").alias("_kept")))
    gone = if_small(stored(by_id.where("not _kept or _rows > 1").select("_id"), "gone"))
    same = docs["doc_id"].cast("long") == F.col("_id")
    once = docs.join(gone, same, "left_anti")
    several = if_small(stored(by_id.where("_kept and _rows > 1").select("_id"), "several"))
    order = Window.partitionBy("_id").orderBy(F.col("text").asc_nulls_first())
    chosen = (docs.join(several, same).withColumn("_place", F.row_number().over(order))
              .where("_place = 1").select(*[F.col(f"`{c}`") for c in docs.columns]))
    return once.union(chosen)


#: The rows of ``near_duplicates`` at 85 percent by all pairs that share a shingle.
NEAR_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' ')))) END AS held
    FROM split),
classes AS (
    SELECT min(doc_id) AS rep, held, len(held) AS n FROM sets WHERE len(held) > 0 GROUP BY held),
each AS (SELECT rep, n, unnest(held) AS h FROM classes),
links AS (
    SELECT a.rep AS a, b.rep AS b FROM each a JOIN each b ON a.h = b.h AND a.rep < b.rep
    GROUP BY a.rep, b.rep, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
    SELECT rep, rep FROM classes
    UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
named AS (SELECT node, min(root) AS component FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.held) AS BIGINT) AS n_shingles,
    coalesce(m.component, s.doc_id) AS component_id,
    s.doc_id = coalesce(m.component, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON s.held = c.held LEFT JOIN named m ON m.node = c.rep
"""
