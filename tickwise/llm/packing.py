"""Best-fit packing of tokenized documents by minimum bin slack.

Only lengths matter for the packing, and there are at most ``capacity`` of
them, so the corpus reaches the driver as one histogram of lengths, whatever
its size. Per bin, a bitset subset-sum over the lengths still available finds
the fullest combination that holds the longest piece left; it is then used as
often as its lengths last. Pieces are numbered within their length by a
distributed rank, and a length's numbers are dealt to the patterns' places.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_rows, gapless_rank, mix31, stored, texts_of
from tickwise.llm.tokens import KEEP_MANY, vocabulary, word_ids

CAPACITY = 2048
END_ID = 0


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           vocab: str | None = None, keep_words: int = KEEP_MANY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces: its
    ids and the end id, cut only where longer than ``capacity``. ``keep_words`` bounds
    the words that a worker remembers: memory and time, not results."""
    vocab = vocab or vocabulary()
    end = int(end_id).to_bytes(4, "little")

    def cut(batch: pa.RecordBatch) -> dict:
        coder = word_ids(vocab, keep_words)
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length",
                                                "ids_crc32")}
        for key, ids in zip(batch.column(0).to_pylist(), coder.many(texts_of(batch.column(1)))):
            ids += end
            for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                out["doc_id"].append(key)
                out["piece"].append(n)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
        return out

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_rows(rows, cut, "doc_id long, piece int, start long, length long, "
                                 "ids_crc32 long", tokenizes=True)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Lengths (with how many of each) that fill ``room`` as far as any subset
    of the available (length, count) pairs can.

    Bit s of the set is on if some subset sums to s. Counts are split into
    powers of two, so a length costs a few shifts; the walk back over the kept
    sets finds one subset with the largest sum.
    """
    full, seen = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []        # length, multiple, set before
    for length, count in available:
        if length > room:
            continue
        left, some = min(count, room // length), 1
        while left > 0:
            some = min(some, left)
            left -= some
            grown = (seen | seen << (length * some)) & full
            if grown != seen:
                steps.append((length, some, seen))
                seen = grown
            some *= 2
        if seen >> room & 1:
            break
    at, chosen = seen.bit_length() - 1, {}
    for length, some, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + some
            at -= length * some
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) \
        -> list[tuple[int, dict[int, int]]]:
    """(bins, {length: pieces in each bin}) patterns that use up the histogram.

    The longest length left is always part of the next bin; the rest of the
    bin is the fullest combination of what remains. A pattern is repeated as
    often as all its lengths last, so the number of patterns follows the
    number of lengths, not of pieces.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    order = sorted(left, reverse=True)
    plan = []
    while order:
        longest = order[0]
        rest = [(k, left[k] - (k == longest)) for k in order if left[k] - (k == longest)]
        need = fullest(rest, capacity - longest)
        need[longest] = need.get(longest, 0) + 1
        times = min(left[k] // n for k, n in need.items())
        plan.append((times, need))
        for k, n in need.items():
            left[k] -= n * times
        order = [k for k in order if left[k]]
    return plan


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The plan as segments of a length's ranks, sorted by (length, rank):
    ranks from ``low`` fill ``each`` places a bin from bin ``bin`` on, at
    ``offset`` in the bin."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for times, need in plan:
        offset = 0
        for length, each in sorted(need.items(), reverse=True):
            low = used.get(length, 0)
            rows.append((length, low, each, first, offset))
            used[length] = low + times * each
            offset += length * each
        first += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {k: table[:, i] for i, k in enumerate(("length", "low", "each", "bin", "offset"))}


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         vocab: str | None = None, keep_words: int = KEEP_MANY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, the
    sequence that holds it and its offset there (gapless from 0).

    Null or empty text is the end id alone. Repeated rows and repeated ids are
    packed row by row; extra columns are ignored; an empty input gives no rows.
    """
    cut = stored(pieces(docs, capacity, end_id, vocab, keep_words), "pieces")
    # at most ``capacity`` rows, whatever the corpus
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan_bins(histogram, capacity))
    spread = mix31(F.coalesce(F.col("doc_id"), F.lit(0).cast("long"))
                   + F.col("piece") * F.lit(7919))
    ranked = gapless_rank(cut, ["length"], ["doc_id", "piece", "start", "ids_crc32"],
                          spread, "_rank")

    def deal(batch: pa.RecordBatch) -> dict:
        got = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        length, rank = (got[n].to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
        wide = np.int64(1) << 42
        at = np.searchsorted(places["length"] * wide + places["low"],
                             length * wide + rank, "right") - 1
        n = rank - places["low"][at]
        each = places["each"][at]
        return {**{k: got[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")},
                "sequence_id": places["bin"][at] + n // each,
                "offset": places["offset"][at] + n % each * length}

    return arrow_rows(ranked, deal, "doc_id long, piece int, start long, length long, "
                                    "ids_crc32 long, sequence_id long, offset long")
