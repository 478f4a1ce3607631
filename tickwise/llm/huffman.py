"""Token-id files: canonical length-limited Huffman codes in independent blocks.

A file set is a folder with two Parquet tables: ``codebook`` (id, length: the
canonical code follows from the lengths alone) and ``blocks`` (part, block,
start, n_docs, n_tokens, data). ``data`` is one block of whole documents in
ascending doc_id order, readable without any other block:

    4 bytes  magic "TWH1"
    uint32   documents, tokens, tokens between checkpoints, checkpoints
    int64    document ids (0 where the id is null) | uint8 null marks
    uint32   tokens of each document
    uint64   bit offset of each checkpoint in the payload
    rest     payload, codes from the high bit of each byte on

all little-endian. Parts are ranges of doc_id in ascending order; ``start`` is
the number of a part's ids before the block. Checkpoints let a reader decode
all stretches between them in step, one table look-up a token, and begin
anywhere in a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_rows, lean, ship, stored, texts_of
from tickwise.llm.tokens import KEEP_MANY, vocabulary, word_ids

MAGIC = b"TWH1"
END_ID = 1
MAX_BITS = 18
BLOCK_TOKENS = 1 << 17
CHECKPOINT = 256

_BLOCKS = "part int, block int, start long, n_docs int, n_tokens long, data binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each id under ``max_bits`` (0: id does not
    occur), by package-merge on the sorted counts."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit in codes of {max_bits} bits")
    if n <= 1:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    row, marks = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        row = both[order]
        marks.append(order < n)
    depth, need = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(marks):
        own = int(leaf[:need].sum())
        depth[:own] += 1
        need = 2 * (need - own)
    lengths[used] = depth
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes by id, ids in canonical order): by length, then by id."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        size = lengths[order].astype(np.int64)
        widest = int(size[-1])
        room = np.int64(1) << (widest - size)         # leaves below each code
        codes[order] = (np.cumsum(room) - room) >> (widest - size)
    return codes, order


def encode_block(ids: np.ndarray, doc_ids: list, sizes: np.ndarray, codes: np.ndarray,
                 lengths: np.ndarray) -> bytes:
    bits = lengths[ids].astype(np.int64)
    at = np.cumsum(bits) - bits
    total = int(bits.sum())
    # a code of at most 32 bits touches two 32-bit words; codes never overlap,
    # so adding is setting, and sums below 2^32 are exact in a double
    placed = codes[ids] << (64 - bits - (at & 31)).astype(np.uint64)
    word, n_words = at >> 5, (total >> 5) + 2
    packed = (np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), n_words)
              + np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64),
                            n_words))
    payload = packed.astype(np.uint32).astype(">u4").tobytes()[: (total + 7) // 8]
    marks = at[::CHECKPOINT].astype("<u8")
    known = np.array([x or 0 for x in doc_ids], "<i8")
    null = np.array([x is None for x in doc_ids], np.uint8)
    head = np.array([len(doc_ids), len(ids), CHECKPOINT, len(marks)], "<u4")
    return b"".join([MAGIC, head.tobytes(), known.tobytes(), null.tobytes(),
                     sizes.astype("<u4").tobytes(), marks.tobytes(), payload])


class Decoder:
    """Table-driven decoder for one codebook."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max()) if len(lengths) else 0
        _, order = canonical(lengths)
        size = lengths[order].astype(np.int64)
        fill = np.int64(1) << (self.bits - size)
        self.ids = np.zeros(1 << self.bits, np.uint32)
        self.step = np.ones(1 << self.bits, np.int64)
        self.ids[: fill.sum()] = np.repeat(order.astype(np.uint32), fill)
        self.step[: fill.sum()] = np.repeat(size, fill)

    def block(self, data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
        """(doc ids, tokens of each document, all ids) of a block."""
        if data[:4] != MAGIC:
            raise ValueError("not a token block")
        docs, tokens, every, marks = np.frombuffer(data, "<u4", 4, 4).tolist()
        at = 20
        known = np.frombuffer(data, "<i8", docs, at).tolist()
        at += 8 * docs
        null = np.frombuffer(data, np.uint8, docs, at).tolist()
        at += docs
        sizes = np.frombuffer(data, "<u4", docs, at)
        at += 4 * docs
        place = np.frombuffer(data, "<u8", marks, at).astype(np.int64)
        at += 8 * marks
        # past the end, a stretch that is over reads zeros
        raw = np.concatenate([np.frombuffer(data, np.uint8, -1, at) if at < len(data)
                              else np.zeros(0, np.uint8),
                              np.zeros(every * self.bits // 8 + 16, np.uint8)]).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.empty((every, marks), np.uint32)
        shift, mask = 32 - self.bits, np.uint32((1 << self.bits) - 1)
        for i in range(min(every, tokens)):
            seen = (window[place >> 3] >> (shift - (place & 7)).astype(np.uint32)) & mask
            out[i] = self.ids[seen]
            place += self.step[seen]
        ids = out.T.reshape(-1)[:tokens]
        return [None if n else k for k, n in zip(known, null)], sizes, ids


def tokenized(docs: DataFrame, end_id: int, vocab: str) -> DataFrame:
    """doc_id, ids (of the narrowest width, with the end id), and the text's
    beginning and a hash that order rows of one id. Texts are not moved."""
    def run(batch: pa.RecordBatch) -> dict:
        coder = word_ids(vocab, KEEP_MANY)
        end, dtype = int(end_id).to_bytes(4, "little"), _dtype(coder.size, end_id)
        return {"doc_id": batch.column(0), "head": batch.column(2), "ids": [
            np.frombuffer(x + end, "<u4").astype(dtype).tobytes()
            for x in coder.many(texts_of(batch.column(1)))]}

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text, F.substring(text, 1, 64).alias("head"))
    return arrow_rows(rows, run, "doc_id long, head string, ids binary",
                      tokenizes=True).withColumn(
        "h", F.xxhash64("ids"))


def _in_blocks(tokens: DataFrame, encode, dtype: str, block_tokens: int) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order (rows of one id by the
    beginning of their texts, then by a hash), each made by ``encode``."""
    width = np.dtype(dtype).itemsize
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()),
                        ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("data", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names, held, size, block, start = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(x) // width for x in held], np.int64)
            data = encode(np.frombuffer(b"".join(held), dtype), names, sizes)
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(
                (part, block, start, len(names), size, data), schema)], schema=schema)

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py()
                names.append(name)
                held.append(ids)
                size += len(ids) // width
                if size >= block_tokens:
                    yield flush()
                    block, start = block + 1, start + size
                    names, held, size = [], [], 0
        if names:
            yield flush()

    ship(tokens.sparkSession)
    return (tokens.repartitionByRange("doc_id", "head", "h").sortWithinPartitions("doc_id", "head", "h")
            .select("doc_id", "ids").mapInArrow(lean(cut), _BLOCKS))


def _dtype(vocab_size: int, end_id: int) -> str:
    return "<u2" if max(vocab_size - 1, end_id) < 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, dtype: str) -> np.ndarray:
    """How often each id occurs in all documents. Tasks send one row for each id
    they met; the driver gets one row for each id of the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            own = np.bincount(np.frombuffer(data, dtype), minlength=len(seen))
            own[:len(seen)] += seen
            seen = own
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(seen[found])], names=["id", "n"])

    rows = (tokens.select("ids").mapInArrow(lean(count), "id int, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, vocab: str | None = None,
                 max_bits: int = MAX_BITS, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the ids of every document's whole text and ``end_id`` to ``path``,
    in ascending doc_id order (nulls first).

    Texts are tokenized once, where they are read; their ids wait in the shared
    scratch folder for the global counts and are then shuffled into order. Null or
    empty text is the end id alone; repeated rows are kept; extra columns are
    ignored; an empty input gives a file set without blocks.
    """
    spark, vocab = docs.sparkSession, vocab or vocabulary()
    tokens = stored(tokenized(docs, end_id, vocab), "ids", "zstd")
    dtype = _dtype(word_ids(vocab).size, end_id)
    lengths = code_lengths(id_counts(tokens, dtype), max_bits)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    codes, _ = canonical(lengths)

    def encode(ids: np.ndarray, names: list, sizes: np.ndarray) -> bytes:
        return encode_block(ids, names, sizes, codes, lengths)

    _in_blocks(tokens, encode, dtype, block_tokens).write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and,
    if asked for, the ids as little-endian unsigned 32-bit integers."""
    book = spark.read.parquet(f"{path}/codebook").collect()   # one row for each id
    lengths = np.zeros(max([r["id"] for r in book], default=-1) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # one row for each part, that is, for each task of the writer
    shift = (blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(
                 Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select("part", "_before"))
    made: list[Decoder] = []

    def decode(batch: pa.RecordBatch) -> Iterator[dict]:
        if not made:
            made.append(Decoder(lengths))
        got = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for part, start, data in zip(got["part"].to_pylist(), got["start"].to_pylist(),
                                     got["data"]):
            names, sizes, found = made[0].block(data.as_py())
            packed = memoryview(found.astype("<u4").tobytes())
            stops = np.cumsum(sizes, dtype=np.int64)
            spans = [packed[4 * (b - n):4 * b] for b, n in zip(stops.tolist(), sizes.tolist())]
            out = {"part": [part] * len(names), "doc_id": names,
                   "_at": stops - sizes + start, "n_tokens": sizes.astype(np.int64),
                   "ids_crc32": [zlib.crc32(x) for x in spans]}
            if ids:
                out["ids"] = [bytes(x) for x in spans]
            yield out

    rows = arrow_rows(blocks.select("part", "start", "data"), decode,
                      "part int, doc_id long, _at long, n_tokens long, ids_crc32 long"
                      + ", ids binary" * ids)
    return rows.join(shift, "part").select(
        "doc_id", (F.col("_at") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * ids)
