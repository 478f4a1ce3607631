"""Reading landed ticker snapshots.

Two layouts exist: the feed's own files hold one JSON array each
(``layout="array"``), snapshots landed by Spark are folders of part files of JSON
lines (``layout="lines"``, splittable). ``layout="auto"``, the default of every
reader and job, tells them apart for each file: a part file inside a snapshot's
folder, and any file above ``WHOLE_BYTES``, is read as lines by the JSON source;
every other file is read once as one text and parsed as what it begins with. A
snapshot is addressed as ``<prefix><stamp>.json`` whether that names a file or a
folder.

Reads are strict, and the check is part of the one reading of the input: a
malformed document, or a file of another layout than the one given, fails the
job with the file's name instead of yielding empty or missing rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schema import RAW, SNAPSHOT_GLOB

# the path component naming a snapshot (a file, or the folder of its parts)
SNAPSHOT_NAME = r"([A-Za-z][A-Za-z0-9]*_[0-9][0-9_-]*\.json)"

LAYOUTS = ("auto", "array", "lines")


#: Files up to this size are read as one text where their layout is to be found.
WHOLE_BYTES = 256 << 20

_RECORDS = T.ArrayType(RAW)
_BLANK = " \t\r\n\ufeff"


def opens_array(text: Column) -> Column:
    return F.ltrim(text, F.lit(_BLANK)).startswith("[")


def file_records(text: Column) -> Column:
    """A whole file's records, NULL if it is malformed: one JSON array, or JSON
    lines of which each is a record (or an array of them)."""
    body = F.btrim(text, F.lit(_BLANK))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    parsed = F.transform(lines, lambda x: F.from_json(x, _RECORDS))
    return (F.when(opens_array(text), F.when(body.endswith("]"), F.from_json(body, _RECORDS)))
            .when(body == "", F.array().cast(_RECORDS))
            .when(~F.exists(parsed, lambda x: x.isNull()), F.flatten(parsed)))


def checked_layout(text: Column, file: Column, layout: str) -> Column:
    """The text, or an error where a forced layout is not the file's."""
    wrong = {"array": ~opens_array(text) & (F.btrim(text, F.lit(_BLANK)) != ""),
             "lines": opens_array(text)}.get(layout)
    if wrong is None:
        return text
    return F.when(wrong, F.raise_error(F.concat(file, F.lit(f" is not of layout {layout}")))
                  .cast("string")).otherwise(text)


def _read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(RAW).option("mode", "FAILFAST").json(list(paths))


def _read_whole(spark: SparkSession, paths: Sequence[str], layout: str,
                only: Column | None = None) -> DataFrame:
    files = spark.read.text(list(paths), wholetext=True)
    if only is not None:
        files = files.where(only)
    file = F.col("_metadata.file_path")
    records = file_records(checked_layout(F.col("value"), file, layout))
    return files.select(F.inline(F.coalesce(records, F.raise_error(
        F.concat(F.lit("malformed ticker file "), file)).cast(_RECORDS))))


def _is_lines(path: Column, length: Column) -> Column:
    """Files that are JSON lines by their place or size, told from the listing."""
    return path.rlike(r"\.json/[^/]+$") | (length > WHOLE_BYTES)


def read_snapshots(spark: SparkSession, path: str | Sequence[str],
                   layout: str = "auto") -> DataFrame:
    """Every record of every snapshot matched by ``path`` (no dedup); each file
    is read once."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    paths = [path] if isinstance(path, str) else list(path)
    if layout == "lines":
        return _read_lines(spark, paths)
    # the listing alone: the content column is pruned
    listed = (spark.read.format("binaryFile").load(paths)
              .agg(F.count_if(_is_lines(F.col("path"), F.col("length"))).alias("lines"),
                   F.count(F.lit(1)).alias("files")).first())
    if layout == "array":
        if listed["lines"]:
            raise ValueError(f"{listed['lines']} files of {paths} are landed part files or too "
                             "large for one text; read JSON lines with layout='lines'")
        return _read_whole(spark, paths, layout)
    if listed["lines"] == listed["files"]:
        return _read_lines(spark, paths)
    if not listed["lines"]:
        return _read_whole(spark, paths, layout)
    lines = _is_lines(F.col("_metadata.file_path"), F.col("_metadata.file_size"))
    return _read_lines(spark, paths).where(lines).unionByName(
        _read_whole(spark, paths, layout, ~lines))


def read_all_snapshots(spark: SparkSession, directory: str,
                       layout: str = "auto") -> DataFrame:
    return read_snapshots(spark, f"{directory.rstrip('/')}/*.json", layout)


def read_with_glob_fallback(spark: SparkSession, directory: str,
                            patterns: Sequence[str] = ("*.json", SNAPSHOT_GLOB),
                            layout: str = "auto") -> DataFrame:
    """First pattern whose read resolves; the last failure is re-raised."""
    err = None
    for pat in patterns:
        try:
            return read_snapshots(spark, f"{directory.rstrip('/')}/{pat}", layout)
        except AnalysisException as e:  # nothing matched / unreadable
            err = e
    raise err


def local_fallback(uri: str) -> str:
    """Strip a ``scheme://authority`` prefix and make the rest relative."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "", uri)
    return rest if rest.startswith("./") else "./" + rest.lstrip("/")


def read_with_path_fallback(spark: SparkSession, candidates: Sequence[str],
                            layout: str = "auto") -> DataFrame:
    """Read the first candidate location that resolves; re-raise otherwise."""
    err = None
    for path in candidates:
        try:
            return read_snapshots(spark, path, layout)
        except Exception as e:  # missing path or unknown file system
            err = e
    raise err


def read_with_local_fallback(spark: SparkSession, path: str,
                             layout: str = "auto") -> DataFrame:
    """The given location, else the same path relative to the working folder."""
    return read_with_path_fallback(spark, [path, local_fallback(path)], layout)


def snapshot_index(spark: SparkSession, directory: str,
                   pattern: str = SNAPSHOT_GLOB) -> DataFrame:
    """(snapshot, stamp) per snapshot; the file listing reads no content.

    Both stamp formats (``%Y-%m-%d_%H-%M-%S`` and ``%Y%m%d_%H%M%S``) reduce
    to the same 14 digits, so ordering by the parsed stamp is correct where
    ordering by name is not.
    """
    files = (spark.read.format("binaryFile")
             .load(f"{directory.rstrip('/')}/{pattern}").select("path"))
    name = F.regexp_extract("path", SNAPSHOT_NAME, 1)
    return (files.select(name.alias("snapshot")).where(F.col("snapshot") != "")
            .distinct()
            .withColumn("stamp", F.try_to_timestamp(
                F.regexp_replace("snapshot", "[^0-9]", ""), F.lit("yyyyMMddHHmmss"))))


def latest_snapshot_name(spark: SparkSession, directory: str,
                         pattern: str = SNAPSHOT_GLOB) -> str:
    idx = snapshot_index(spark, directory, pattern).where(F.col("stamp").isNotNull())
    row = idx.orderBy(F.desc("stamp"), F.desc("snapshot")).select("snapshot").first()
    if row is None:
        raise FileNotFoundError(f"no snapshot matching {pattern} under {directory}")
    return row[0]


def read_latest_snapshot(spark: SparkSession, directory: str,
                         pattern: str = SNAPSHOT_GLOB,
                         layout: str = "auto") -> DataFrame:
    """Only the newest snapshot is scanned (one path string reaches the driver)."""
    name = latest_snapshot_name(spark, directory, pattern)
    return read_snapshots(spark, f"{directory.rstrip('/')}/{name}", layout)


def read_single_file(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """A malformed document fails the job instead of yielding corrupt rows."""
    return read_snapshots(spark, path, layout)


def rows_frame(spark: SparkSession, rows) -> DataFrame:
    """Records held in memory (a list of dicts) as a feed-shaped DataFrame."""
    if isinstance(rows, dict):
        rows = [rows]
    fields = RAW.fieldNames()
    return spark.createDataFrame(
        [tuple(None if r.get(f) is None else str(r.get(f)) for f in fields) for r in rows], RAW)


def read_ticker(spark: SparkSession, *, file: str | None = None,
                directory: str | None = None, table: str | None = None,
                layout: str = "auto") -> DataFrame:
    """Source precedence: one snapshot file > snapshot directory > raw table."""
    if file:
        if any(ch in file for ch in "*?["):
            d, _, pat = file.rpartition("/")
            return read_latest_snapshot(spark, d or ".", pat, layout)
        return read_single_file(spark, file, layout)
    if directory:
        return read_all_snapshots(spark, directory, layout)
    if table:
        return spark.read.parquet(table).select(*RAW.fieldNames())
    raise ValueError("no ticker source given (file, directory or table)")


def first_records(df: DataFrame, n: int = 5) -> list:
    """Up to ``n`` usable records, whichever come first: reads no more of the
    input than it takes to find them. Stops if there is none."""
    found = (df.where(F.col("symbol").isNotNull())
             .select("symbol", "lastPrice", "priceChangePercent", "volume").take(max(n, 1)))
    if not found:
        raise ValueError("no ticker records loaded")
    return found[:n]


def ensure_nonempty(df: DataFrame) -> DataFrame:
    """Stop before processing when the input holds no usable record."""
    first_records(df, 1)
    return df


def load_directory(spark: SparkSession, directory: str, layout: str = "auto",
                   patterns: Sequence[str] = ("*.json", SNAPSHOT_GLOB)) -> DataFrame:
    """The job's read of a folder: the first pattern that resolves there, else
    the same folder relative to the working folder."""
    try:
        return read_with_glob_fallback(spark, directory, patterns, layout)
    except AnalysisException as err:
        try:
            return read_with_glob_fallback(spark, local_fallback(directory), patterns, layout)
        except AnalysisException:
            raise err from None


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return (df.select("symbol", "lastPrice", "priceChangePercent", "volume")
            .orderBy("symbol").limit(n))
