"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelbeam.session import ensure_checkpoint_dir

#: A word: a run without space, tab, newline, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column used inside a lambda may be inlined by the optimizer and then run once
    per array element; bound as a lambda variable it is a value."""
    return F.transform(F.array(value), body)[0]


def with_struct(df: DataFrame, value: Column, fields: dict[str, str]) -> DataFrame:
    """Append the fields of a struct column under new names (``{new name: field}``).

    The struct goes through a generator, so filters on the new columns are not pushed
    below it and the struct is computed once per row."""
    picked = let(value, lambda s: F.struct(*[s[f].alias(new) for new, f in fields.items()]))
    return df.select("*", F.inline(F.array(picked)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has (in either case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new += "_"
        taken.add(new.lower())
        out.append(new)
    return out


def held_out(doc_id: Column, folds: int) -> Column:
    """True when crc32 of the id's decimal text is 0 modulo ``folds``; a null id is training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written once to the shared ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: smaller than a checkpoint, and
    later reads take only the columns they need."""
    path = shared_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_written(spark: SparkSession, table: DataFrame) -> None:
    """Delete the files of a table made by ``written``, once nothing reads it any more."""
    for folder in {os.path.dirname(f) for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A folder (as URI or path) under the shared checkpoint folder of this application."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def hash_fraction(seed: str, key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key); null keys count as empty text."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Only the driver reads the archive; Spark sends it to the executors."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="corpus-ops-"), "package")
        root, name = os.path.split(package)
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, name))


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of Arrow batches in slices of about ``limit`` bytes in a binary column, at least one row
    each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(lengths, dtype=np.int64), 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def map_groups(df: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """``applyInPandas`` per key with the package on the workers."""
    ship_package(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(run, schema)
