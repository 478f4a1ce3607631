"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.tokens import forget
from tickwise.session import new_scratch_dir, table_path

_SHIPPED: set[str] = set()

#: Hash buckets that split one key's rows for ranking (see ``gapless_rank``).
RANK_BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once for each application.

    Workers then import it as a module, so that what a worker has learnt
    (word caches) outlives one task.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="tickwise-"), "tickwise_workers.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows, written to the shared scratch folder and read back: cuts the
    lineage in a way that survives lost executors."""
    path = new_scratch_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix31(x: Column, rounds: int = 3) -> Column:
    """A 31-bit hash of a long from products that never leave 64 bits, so that
    SQL engines without a common hash function agree on it."""
    m = F.lit(2147483647)
    h = F.pmod(x, m)
    h = F.pmod(h + F.pmod(F.shiftright(x, 31), m) * F.lit(16807), m)
    for _ in range(rounds):
        h = F.pmod(h * F.lit(1583458089) + F.lit(12345), m)
        h = F.pmod(h.bitwiseXOR(F.shiftright(h, 15)) * F.lit(784588716) + F.lit(977), m)
    return h


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], spread: Column,
                 name: str, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Adds ``name``: each row's place within its key, gapless from 0.

    A key may hold most rows, so no task ever gets a whole key: rows of a key
    are split over hash buckets, ranked there, and shifted by the sizes of the
    key's earlier buckets (a running sum over at most ``buckets`` counts).
    """
    rows = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    shift = (rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .drop("_n"))
    local = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (rows.withColumn("_local", F.row_number().over(local) - 1)
            .join(shift, [*keys, "_bucket"])
            .withColumn(name, (F.col("_local") + F.col("_shift")).cast("long"))
            .drop("_local", "_shift", "_bucket"))


#: Rows of a few numbers that a join may send to every executor (a few MB).
SMALL_ROWS = 200_000


def if_small(df: DataFrame) -> DataFrame:
    """Stored rows, to be broadcast if they have been counted to be few; beyond
    that, a join shuffles both sides as usual."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def hashed_sample(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of ``key``; ``total``
    is the number of rows of ``df``. Rows beyond a multiple of the share needed are
    left in the scan, so that not every task offers ``n`` rows."""
    spread = 1 << 40
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(spread))
    if total > 8 * n:
        df = df.where(place < int(8 * n / total * spread))
    return df.orderBy(place, key).limit(n)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in pc.cast(column, pa.binary()).to_pylist()]


#: Bytes of a batch that a task works on at once.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, some at a time: about ``size`` bytes, one row at least."""
    if batch.num_rows:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, beside
    the JVM that runs the next stage."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
         tokenizes: bool = False):
    """A mapInArrow function that works on slices of its batches and gives its
    memory back at the end. Unless it ``tokenizes``, it begins by dropping the words that
    the worker remembers from tasks which did."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokenizes and forget():
            give_back()
        try:
            yield from fn(part for batch in batches for part in slices(batch))
        finally:
            give_back()

    return run


def arrow_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterable[dict]],
               schema: str, tokenizes: bool = False) -> DataFrame:
    """mapInArrow with a function that gives columns for each batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = fn(batch)
            for columns in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(lean(run, tokenizes), schema)
