"""Partitioned sinks.

One output per request file, one tab per township, one workbook per township:
each becomes a partition column of a single write, so a run writes every
deliverable in one job and files never pass through the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelbeam.functions.text import file_label
from parcelbeam.sources import versions
from parcelbeam.sources.ingest import SHEET_ROW, SOURCE
from parcelbeam.sources.partitions import write_partitioned


def workbook_name(triad: Column, year: int | None = None, suffix: str = "condo_review") -> Column:
    """'<triad, lower case, blanks as _>_<suffix>_<year>' as a column; the year
    defaults to the current one (S13, F20)."""
    yr = F.lit(str(year)) if year is not None else F.year(F.current_date()).cast("string")
    return F.concat(F.lower(file_label(triad)), F.lit(f"_{suffix}_"), yr)


def write_review_sheets(sheet: DataFrame, path: str, year: int | None = None,
                        triads: Sequence[str] | None = None) -> str:
    """Unit review sheets: one folder per workbook (triad + year) and township
    tab, rows by PIN -- every triad in one write (S11, S13).  Workbooks are
    replaced as a whole by a manifest that is switched last (S14): readers
    (``read_review_sheets``) see the old ones until then, and the workbook of a
    reviewed triad (all of the year when ``triads`` is None) that has no rows
    any more goes."""
    spark = sheet.sparkSession
    named = sheet.withColumn("workbook", workbook_name(F.col("Triad"), year))
    names = spark.createDataFrame([(t,) for t in triads or [""]], "t string").select(
        workbook_name(F.col("t"), year).alias("name")).collect()
    own = {r.name for r in names}
    if triads is None:
        ending = names[0].name
        return versions.replace(named, path, "workbook", ["Township"], ["PIN"], covers=lambda n: n.endswith(ending))
    return versions.replace(named, path, "workbook", ["Township"], ["PIN"], covers=own.__contains__)


def read_review_sheets(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """The rows of all current workbooks, with their workbook and Township."""
    return versions.read(spark, path, "workbook", places)


def write_value_change(groups: DataFrame | Sequence[DataFrame], path: str) -> str:
    """Value-change output: one deliverable per request file under the same file
    name, with the sheet's own columns and in its own row order (S10, R5).

    One frame per header layout; all of them are switched to by one manifest,
    so readers (``read_value_change``) see a file as it was or as it is."""
    frames = [groups] if isinstance(groups, DataFrame) else list(groups)
    if not frames:
        return path
    staged = []
    for df in frames:
        order = [SHEET_ROW] if SHEET_ROW in df.columns else None
        staged.append(versions.stage(df, path, SOURCE, sort_cols=order, hidden=order or ()))
    versions.commit(frames[0].sparkSession, path, staged)
    return path


def read_value_change(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """The rows of all current request files."""
    return versions.read(spark, path, SOURCE, places)


# Row order of each ratio-study table within a township (O2).
RATIO_ORDER = {
    "all_parcels": ["Pin"],
    "ratio_deciles": ["Price Decile"],
    "curve": ["price_decile", "stage"],
    "curve_axis": ["axis_break"],
    "neighborhood_medians": ["neighborhood_number", "stage_order"],
    "neighborhood_map": ["neighborhood_number", "stage_order"],
}


def write_ratio_study(outputs: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Each ratio-study table partitioned by township (blanks as underscores), in its row order."""
    written = {}
    for name, df in outputs.items():
        if name in ("unmatched", "rejected_values"):  # no township: one plain dataset
            written[name] = os.path.join(root, name)
            df.write.mode("overwrite").parquet(written[name])
            continue
        town = "Township Name" if "Township Name" in df.columns else "township_name"
        keyed = df.withColumn("township_file", file_label(F.col(f"`{town}`")))
        written[name] = write_partitioned(keyed, os.path.join(root, name), ["township_file"], RATIO_ORDER.get(name))
    return written
