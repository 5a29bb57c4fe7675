"""Deliverables replaced as a whole.

A folder of deliverables holds versions and manifests.  A run writes its rows under a version of
its own, where no reader looks, and then commits a manifest that says for every deliverable which
version holds it.  Committing is the creation of one small file, numbered after the one before it
and never overwritten: readers follow the highest number, so they see a deliverable whole, as it was
or as it is, never half of it, and a run that stops before its manifest changes nothing.

A run covers some deliverables (by default those it has rows for).  A covered one without rows is no
longer listed; others keep their version.  Two runs that commit at once cannot both take a number:
the later one reads the manifest anew and takes the next.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelbeam.session import delete_path
from parcelbeam.sources.partitions import write_partitioned

class Staged(NamedTuple):
    """A written version: its name, its rows' schema, and the deliverables that it holds."""

    version: str
    schema: str
    names: list[str]


MANIFEST = re.compile(r"manifest-(\d{9})\.json$")


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and paths of the manifests of a folder, newest first."""
    root, fs = _files(spark, path)
    if not fs.exists(root):
        return []
    names = [(MANIFEST.match(s.getPath().getName()), s.getPath().toString()) for s in fs.listStatus(root)]
    return sorted(((int(m[1]), p) for m, p in names if m), reverse=True)


def _read(spark: SparkSession, file: str) -> dict | None:
    """The manifest, or None while the file is not complete."""
    rows = spark.read.text(file, wholetext=True).collect()
    try:
        found = json.loads(rows[0].value) if rows else None
        return found if found and {"deliverables", "schemas"} <= set(found) else None
    except ValueError:
        return None


def _current(spark: SparkSession, path: str) -> tuple[int, dict]:
    for number, file in _manifests(spark, path):
        found = _read(spark, file)
        if found is not None:
            return number, found
    return 0, {"deliverables": {}, "schemas": {}}


def listed(spark: SparkSession, path: str) -> dict[str, str]:
    """The current deliverables, each with the version that holds it."""
    return _current(spark, path)[1]["deliverables"]


def stage(df: DataFrame, path: str, deliverable: str, partition_cols: Sequence[str] = (),
          sort_cols: Sequence[str] | None = None, hidden: Sequence[str] = ()) -> Staged:
    """Write the rows under a version that no manifest lists yet.  ``hidden`` columns order the
    rows and are not written."""
    version = uuid.uuid4().hex
    write_partitioned(df, f"{path}/versions/{version}", [deliverable, *partition_cols],
                      list(sort_cols) if sort_cols else None, hidden=hidden)
    return Staged(version, df.drop(*hidden).schema.json(), staged_deliverables(df.sparkSession, path, version, deliverable))


def staged_deliverables(spark: SparkSession, path: str, version: str, deliverable: str) -> list[str]:
    """Names of the deliverables that a version has rows of, from its folders."""
    root, fs = _files(spark, f"{path}/versions/{version}")
    if not fs.exists(root):
        return []
    prefix = f"{deliverable}="
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(unescape(s.getPath().getName()[len(prefix):]) for s in fs.listStatus(root)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def commit(spark: SparkSession, path: str, staged: Sequence[Staged],
           covers: Callable[[str], bool] | None = None, attempts: int = 20) -> int:
    """Switch to what was staged: list its deliverables, leave out others that the run ``covers``,
    and keep the rest.  Returns the manifest's number."""
    names = {name: s.version for s in staged for name in s.names}
    for _ in range(attempts):
        before = _current(spark, path)[1]
        current = {n: v for n, v in before["deliverables"].items() if not (covers and covers(n))} | names
        schemas = before["schemas"] | {s.version: s.schema for s in staged}
        used = set(current.values()) | {s.version for s in staged[-1:]}  # one at least, for an empty list
        text = json.dumps({"deliverables": current, "schemas": {v: schemas[v] for v in sorted(used)}}, ensure_ascii=False)
        newest = max([n for n, _ in _manifests(spark, path)], default=0)
        target, fs = _files(spark, f"{path}/manifest-{newest + 1:09d}.json")
        try:
            out = fs.create(target, False)
        except Exception as e:  # another run took the number: look again
            if "exists" not in str(e).lower():
                raise
            continue
        out.write(bytearray(text.encode()))
        out.close()
        return newest + 1
    raise RuntimeError(f"no manifest number could be taken in {path} in {attempts} attempts")


def replace(df: DataFrame, path: str, deliverable: str, partition_cols: Sequence[str] = (),
            sort_cols: Sequence[str] | None = None, covers: Callable[[str], bool] | None = None) -> str:
    """Write the rows and switch to them: each deliverable (a value of that column) is replaced as a
    whole, and a covered one without rows goes."""
    commit(df.sparkSession, path, [stage(df, path, deliverable, partition_cols, sort_cols)], covers)
    return path


def read(spark: SparkSession, path: str, deliverable: str, places: bool = False) -> DataFrame:
    """The rows of all current deliverables, each from its version, under its columns' names and
    types; with ``places`` also ``_file`` and ``_row``, whose order is the order of the rows."""
    current = _current(spark, path)[1]
    schemas = {v: T.StructType.fromJson(json.loads(s)) for v, s in current["schemas"].items()}
    by_version: dict[str, list[str]] = {}
    for name, version in current["deliverables"].items():
        by_version.setdefault(version, []).append(name)
    order = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")] if places else []
    parts = [spark.read.schema(schemas[v]).parquet(f"{path}/versions/{v}")
             .filter(F.col(f"`{deliverable}`").isin(names)).select("*", *order)
             for v, names in sorted(by_version.items())]
    if not parts:
        empty = next(iter(schemas.values()), T.StructType([T.StructField(deliverable, T.StringType())]))
        none = spark.createDataFrame([], empty)
        return none.selectExpr("*", "'' AS _file", "0L AS _row") if places else none
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drop_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Delete versions and manifests that the newest manifest has replaced, once no reader of an
    older one is left.  Also deletes what runs that stopped have staged."""
    number, current = _current(spark, path)
    root, fs = _files(spark, f"{path}/versions")
    gone = [s.getPath().toString() for s in fs.listStatus(root)
            if s.getPath().getName() not in set(current["deliverables"].values())] if fs.exists(root) else []
    gone += [file for n, file in _manifests(spark, path) if n < number]
    for item in gone:
        delete_path(spark, item)
    return gone
