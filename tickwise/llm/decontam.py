"""Benchmark decontamination by SimHash of item-sized windows.

An item's fingerprint is a 128-bit SimHash of its five-word shingles, weighted
by how often each occurs. Windows of a document with as many words as an item
get the same fingerprint; a window that shares no shingle with any item of its
size cannot match and is not made. The items' fingerprints are indexed in eight
16-bit blocks: two fingerprints within 31 bits agree in one block up to 3 bits,
so probing every block with all its neighbours up to 3 bits finds all items
within the radius. Candidates are verified on exact weighted shingles
(sum of smaller counts over sum of larger counts at least 0.8).

Words are compared without case, and ASCII punctuation separates them.
Benchmarks are handled in blocks of bounded size, against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_rows, lean, ship, texts_of
from tickwise.llm.shingles import WIDTH, chunks, mix64, shingles_of, words_of

BITS = 128
BLOCKS = 8
RADIUS = 31
SIMILARITY = 0.8
#: Words of a text whose windows are summed at once.
STRETCH = 1 << 14
#: Bytes of benchmark text that go to the workers at once.
ITEM_BYTES = 32 << 20

_PLAIN = bytes(c if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256))
_MASKS = np.array([sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1)
                   for bits in combinations(range(16), n)], np.uint16)


def plain(text: bytes) -> bytes:
    return text.decode().lower().encode().translate(_PLAIN)


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each shingle and bit."""
    both = np.stack([shingles, mix64(shingles ^ np.uint64(0xE7037ED1A0B428DB))], axis=1)
    bits = np.unpackbits(both.view(np.uint8).reshape(len(shingles), BITS // 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, as eight 16-bit blocks, from sums of signs."""
    return np.ascontiguousarray(np.packbits(sums > 0, axis=1)).view(np.uint16)


class Items:
    """Benchmark items with their shingle table and multi-index."""

    def __init__(self, rows: list[tuple[int, str]]):
        texts = [plain((t or "").encode()) for _, t in rows]
        words, owner, _, _ = words_of(texts) if texts else (np.zeros(0, np.uint64),) * 4
        self.ids = [i for i, _ in rows]
        self.words = np.bincount(owner.astype(np.int64), minlength=len(rows))
        self.sets: list[tuple[np.ndarray, np.ndarray]] = []
        prints = np.zeros((len(rows), BLOCKS), np.uint16)
        values, of = [], []
        for i, count in enumerate(self.words):
            a = np.searchsorted(owner, i)
            own, _ = shingles_of(words[a:a + count], np.zeros(count, np.int64), 1,
                                 min(WIDTH, max(int(count), 1)))
            self.sets.append(np.unique(own, return_counts=True))
            if len(own):
                prints[i] = _pack(signs(own).sum(axis=0, dtype=np.int32)[None])[0]
                values.append(self.sets[i][0])
                of.append(np.full(len(values[-1]), i))
        self.prints = prints
        #: shingle -> items, by width of the shingle
        self.table = {}
        for width in sorted({min(int(c), WIDTH) for c in self.words if c}):
            mine = [j for j in range(len(of)) if min(self.words[of[j][0]], WIDTH) == width]
            v = np.concatenate([values[j] for j in mine])
            o = np.concatenate([of[j] for j in mine])
            order = np.argsort(v, kind="stable")
            near = np.zeros(1 << 20, bool)
            near[(v >> np.uint64(44)).astype(np.int64)] = True
            self.table[width] = (v[order], o[order], near)
        #: block value -> items, for each block
        self.index = []
        for b in range(BLOCKS):
            order = np.argsort(prints[:, b], kind="stable")
            start = np.searchsorted(prints[order, b], np.arange(65537))
            self.index.append((order, start))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        found = []
        for b, (order, start) in enumerate(self.index):
            probe = (prints[:, b][:, None] ^ _MASKS[None, :]).astype(np.int64)
            lo, hi = start[probe], start[probe + 1]
            window, mask = np.nonzero(hi > lo)
            lo, n = lo[window, mask], (hi - lo)[window, mask]
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append(np.repeat(window, n) * len(order) + order[at])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.ids), pairs % len(self.ids)
        far = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        ok = far <= RADIUS
        return window[ok], item[ok], far[ok]

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        own, counts = self.sets[item]
        values, seen = np.unique(shingles, return_counts=True)
        _, i, j = np.intersect1d(own, values, assume_unique=True, return_indices=True)
        both = int(np.minimum(counts[i], seen[j]).sum())
        return both / (int(counts.sum()) + len(shingles) - both)

    def leaks(self, texts: list[bytes], similarity: float) -> Iterator[tuple[int, int, float]]:
        """(text, item, similarity) of every item found in every text."""
        for a, b in chunks(texts):
            words, owner, _, _ = words_of([plain(t) for t in texts[a:b]])
            for width, table in self.table.items():
                for text, item, score in self._chunk(words, owner, b - a, width, table,
                                                     similarity):
                    yield a + text, item, score

    def _chunk(self, words, owner, texts, width, table, similarity):
        values, at = shingles_of(words, owner, texts, width)
        sorted_values, of, rough = table
        hit = np.flatnonzero(rough[(values >> np.uint64(44)).astype(np.int64)])
        lo = np.searchsorted(sorted_values, values[hit])
        n = np.searchsorted(sorted_values, values[hit], "right") - lo
        if not n.sum():
            return
        item = of[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        place = np.repeat(hit, n)
        text = owner[at[place]]
        first = np.searchsorted(owner[at], np.arange(texts + 1))
        size = self.words[item]
        for key in np.unique(text * (1 << 32) + size):
            t, words_in = int(key >> 32), int(key & 0xFFFFFFFF)
            mine = (text == t) & (size == words_in)
            yield from self._windows(t, values[first[t]:first[t + 1]],
                                     np.unique(place[mine]) - first[t], words_in,
                                     words_in - width + 1, similarity)

    def _windows(self, text, shingles, hits, words_in, span, similarity):
        """Items of ``words_in`` words in one text's windows of ``span`` shingles
        that hold a hit."""
        last = max(len(shingles) - span, 0)
        # starts from ``span - 1`` before a hit to the hit itself
        change = np.zeros(last + 2, np.int32)
        np.add.at(change, np.clip(hits - span + 1, 0, last), 1)
        np.add.at(change, np.clip(hits, 0, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(change[:-1]))
        done, a = set(), 0
        while a < len(starts):
            # running sums take some hundred bytes a word: a stretch at a time
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + STRETCH)))
            yield from self._stretch(text, shingles, starts[a:b], words_in, span, similarity, done)
            a = b

    def _stretch(self, text, shingles, starts, words_in, span, similarity, done):
        low, high = starts[0], min(starts[-1] + span, len(shingles))
        total = np.zeros((high - low + 1, BITS), np.int32)
        np.cumsum(signs(shingles[low:high]), axis=0, out=total[1:])
        ends = np.minimum(starts + span, len(shingles))
        prints = _pack(total[ends - low] - total[starts - low])
        for k in range(0, len(starts), 512):
            window, item, far = self.near(prints[k:k + 512])
            for i in np.argsort(far, kind="stable").tolist():
                own = int(item[i])
                if own in done or self.words[own] != words_in:
                    continue
                s = starts[k + window[i]]
                score = self.similarity(own, shingles[s:s + span])
                if score >= similarity:
                    done.add(own)
                    yield text, own, score


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in blocks of about ITEM_BYTES bytes of text."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.col("text").cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // ITEM_BYTES
    for k in range(blocks):
        some = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield sorted({(r[0], r[1]) for r in some.collect()}, key=lambda r: (r[0] is None, r))


def find_leaks(docs: DataFrame, benchmark: DataFrame,
               similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity) of every item found in every document.

    Null and empty texts hold nothing; null and empty items are found nowhere.
    An item of fewer than five words is one shingle of its words. A document
    shorter than an item is compared as a whole. Repeated rows give repeated
    results; other columns are ignored; empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in _item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        made: list[Items] = []

        def find(batch: pa.RecordBatch, shared=shared, made=made) -> dict:
            made or made.append(Items(shared.value))
            found = list(made[0].leaks(texts_of(batch.column(1)), similarity))
            return {"doc_id": batch.column(0).take(pa.array([x[0] for x in found], pa.int64())),
                    "item_id": [made[0].ids[x[1]] for x in found],
                    "similarity": [x[2] for x in found]}

        part = arrow_rows(rows, find, "doc_id long, item_id long, similarity double")
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame,
                  similarity: float = SIMILARITY) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    ship(docs.sparkSession)
    out = docs
    for block in _item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value)
            for batch in batches:
                leaky = {x[0] for x in items.leaks(texts_of(batch.column("text")), similarity)}
                yield batch.filter(pa.array([i not in leaky for i in range(batch.num_rows)],
                                            pa.bool_()))

        out = out.mapInArrow(lean(keep), docs.schema)
    return out


def leaky_documents(docs: DataFrame, benchmark: DataFrame,
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document that holds benchmark items: doc_id, n_items,
    items (their ids, ascending) and the best similarity."""
    return (find_leaks(docs, benchmark, similarity).groupBy("doc_id")
            .agg(F.countDistinct("item_id").alias("n_items"),
                 F.sort_array(F.collect_set("item_id")).alias("items"),
                 F.max("similarity").alias("similarity")))
