"""The catalogue of stored runs: which folders hold the current results.

``<output>/run_catalog/runs-<version>.json`` names every current run with its
profile, stamp, rows, alerts, bytes and schemas. A commit writes the next version
under another name and renames it, as the last step of a job: until then readers
follow the version before, afterwards the new one, and never see a run that is
half written or half removed. A read opens one small file, whatever the number
of runs; the schemas it names save the footers of the runs' files.

Folders of runs that a commit drops are deleted by the next commit, so that a
reader that has just followed the old version can finish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COLLECTIONS = ("processed_data", "critical_alerts", "market_metrics")
CATALOG = "run_catalog"
#: Versions of the catalogue that are kept for readers that are still at them.
KEEP_VERSIONS = 3

_VERSION = re.compile(r"^runs-(\d{12})\.json$")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _folder(spark, path)
    fs.delete(at, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    at, fs = _folder(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def _names(spark: SparkSession, path: str) -> list[str]:
    at, fs = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _versions(spark: SparkSession, output: str) -> list[int]:
    names = _names(spark, f"{output.rstrip('/')}/{CATALOG}")
    return sorted(int(m[1]) for m in map(_VERSION.match, names) if m)


def _file(output: str, version: int) -> str:
    return f"{output.rstrip('/')}/{CATALOG}/runs-{version:012d}.json"


def current(spark: SparkSession, output: str) -> dict:
    """The newest version: ``runs`` (entries), ``schemas`` and ``dropped``."""
    versions = _versions(spark, output)
    if not versions:
        return {"version": 0, "runs": [], "schemas": {}, "dropped": []}
    at, fs = _folder(spark, _file(output, versions[-1]))
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, output: str, state: dict) -> bool:
    """Make a version current; False if another writer has taken its number."""
    target, fs = _folder(spark, _file(output, state["version"]))
    draft, _ = _folder(spark, f"{output.rstrip('/')}/{CATALOG}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(state).encode()))
    finally:
        out.close()
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def run_folder(output: str, collection: str, folder: str) -> str:
    return f"{output.rstrip('/')}/{collection}/run_id={folder}"


def new_folder(run_id: str, profile: str) -> str:
    """A folder of its own for each try of a run."""
    return f"{run_id}-{profile}-{uuid.uuid4().hex[:8]}"


def entry(spark: SparkSession, output: str, run_id: str, folder: str, profile: str,
          timestamp: str, rows: int, alerts: int, oldest: str | None = None,
          summaries: int = 1) -> dict:
    size = sum(folder_bytes(spark, run_folder(output, c, folder)) for c in COLLECTIONS)
    return {"run_id": run_id, "folder": folder, "profile": profile, "timestamp": timestamp,
            "oldest": oldest or timestamp, "rows": rows, "alerts": alerts,
            "summaries": summaries, "bytes": size}


def commit(spark: SparkSession, output: str, add: dict, schemas: dict[str, T.StructType],
           replace: bool = False, instead: Iterable[str] = ()) -> dict:
    """Make ``add`` a current run, in place of every other run (``replace``), of
    those of its profile that ``instead`` names, and of an earlier run with its id."""
    instead = {add["run_id"], *instead}
    key = add["profile"]
    while True:
        state = current(spark, output)
        gone = [r for r in state["runs"]
                if replace or (r["profile"] == key and r["run_id"] in instead)]
        # what commits before this one dropped: no reader is expected there now
        old = state["dropped"]
        state = {"version": state["version"] + 1,
                 "runs": [r for r in state["runs"] if r not in gone] + [add],
                 "schemas": {**state["schemas"],
                             key: {c: s.json() for c, s in schemas.items()}},
                 "dropped": [r["folder"] for r in gone]}
        if _publish(spark, output, state):
            break
    for folder in old:
        for collection in COLLECTIONS:
            delete(spark, run_folder(output, collection, folder))
    for version in _versions(spark, output)[:-KEEP_VERSIONS]:
        delete(spark, _file(output, version))
    return state


def drop_failed_tries(spark: SparkSession, output: str, run_id: str, profile: str,
                      keep: str) -> None:
    """Delete what earlier tries of a run left that never became current."""
    state = current(spark, output)
    known = {r["folder"] for r in state["runs"]} | set(state["dropped"]) | {keep}
    tries = re.compile(rf"^run_id={re.escape(f'{run_id}-{profile}')}-[0-9a-f]{{8}}$")
    for collection in COLLECTIONS:
        for name in _names(spark, f"{output.rstrip('/')}/{collection}"):
            if tries.match(name) and name[len("run_id="):] not in known:
                delete(spark, f"{output.rstrip('/')}/{collection}/{name}")


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """Every column of the schemas, in order of first appearance."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def read(spark: SparkSession, output: str, name: str, state: dict,
         runs: list[dict]) -> DataFrame | None:
    """The rows of some runs, None without runs; only their files are opened."""
    if not runs:
        return None
    schema = merged(T.StructType.fromJson(json.loads(state["schemas"][p][name]))
                    for p in sorted({r["profile"] for r in runs}))
    return spark.read.schema(schema).parquet(*[run_folder(output, name, r["folder"])
                                               for r in runs])
