"""Landing-folder ingest for the user sheets.

Sheets arrive as CSV files with a header row, each with its own columns in its
own order.  A cell may hold line breaks, so a record is more than a line; it
ends where as many quotes have been opened as closed (quotes stand in quoted cells only, doubled
there, as spreadsheets export them).  Files are read as lines,
block by block, and records found without a task reading a whole file:

1. Quotes are counted per block; a running sum over a file's blocks (a small
   table, one row per block) says whether a block begins inside a quoted cell.
2. Inside a block a running sum of quotes says the same of every line.  Lines
   that do not begin inside a cell begin a record; those that do continue one.
3. Record beginnings are counted per block, and a running sum over blocks
   numbers the records of a file in the sheet's own order.

Lines of one record are put together again, by (file, record); a record of one
line, as nearly all are, needs no shuffle for that.  Record 0 is the header.
Files are grouped by it, every group gets its own columns (verbatim, repeated
names numbered), and columns are then taken by name.  All cells are text, so
ids keep their leading zeros and dashes; ``sheet_types`` guesses types.  The
driver sees header lines and file names only.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelbeam.functions.keys import trim_unicode
from parcelbeam.functions.names import dedupe_headers
from parcelbeam.operators.attach import sized
from parcelbeam.session import written

SOURCE = "source_file"
#: The number of a row in its sheet, from 1.
SHEET_ROW = "sheet_row"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _decoded(part: Column) -> Column:
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    """The name of a file, as it is in the folder."""
    return _decoded(F.element_at(F.split(path, "/"), -1))


def folder_value(path: Column) -> Column:
    """The value of the last ``key=value`` folder on a path: the name of a sheet that lies in a
    folder of its own."""
    return _decoded(_decoded(F.regexp_extract(path, "=([^/]*)/[^/]*$", 1)))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a folder's CSV files: path, record (from 0, in file order), text.

    Blank lines between records are no records."""
    lines = (spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(folder)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), "value")
             .withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))))
    # written once, so that line numbers stay as they are
    lines = written(lines, "sheet-lines")
    in_block = Window.partitionBy("path", "block").orderBy("line")
    before_block = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)

    def blocks(df: DataFrame, of: Column, name: str) -> DataFrame:
        """Per block: the sum of ``of`` over the blocks of its file before it."""
        small = written(df.groupBy("path", "block").agg(F.sum(of).alias("own")).select(
            "path", "block", F.coalesce(F.sum("own").over(before_block), F.lit(0)).alias(name)), "blocks")
        return sized(small, small.count())

    placed = lines.join(blocks(lines, F.col("quotes"), "open"), ["path", "block"])
    opened = F.col("open") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    placed = placed.withColumn("inside", opened % 2 == 1)
    blank = F.regexp_replace("value", "[\\r\\s]+", "") == ""
    placed = placed.filter(F.col("inside") | ~blank).withColumn("starts", (~F.col("inside")).cast("long"))
    placed = placed.join(blocks(placed, F.col("starts"), "passed"), ["path", "block"])
    record = F.col("passed") + F.sum("starts").over(in_block) - 1
    placed = placed.select("path", record.alias("record"), "block", "line", "value",
                           (F.col("inside") | (F.col("quotes") % 2 == 1)).alias("part"))
    whole = placed.filter(~F.col("part")).select("path", "record", F.col("value").alias("text"))
    lines_of = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    parts = placed.filter("part").groupBy("path", "record").agg(
        F.array_join(F.transform(lines_of, lambda s: s["value"]), "\n").alias("text"))
    return whole.unionByName(parts).withColumn("text", F.regexp_replace("text", "\r$", ""))


def _cells(header: str) -> list[str]:
    return next(csv.reader(io.StringIO(header.lstrip("\ufeff"), newline="")), [])


def read_sheet_groups(spark: SparkSession, folder: str, required: Sequence[str] = (),
                      source_col: str = SOURCE, name: Callable[[Column], Column] = file_name) -> list[DataFrame]:
    """The folder's sheets, one DataFrame per distinct header, each with its own columns (verbatim,
    repeated ones numbered without regard to case), the source file and the row's number in its
    sheet.  A sheet column named like one of these two is numbered too.  A file without a
    ``required`` column is an error that names it."""
    rows = written(records(spark, folder), "sheets")
    headers = rows.filter("record = 0").groupBy("text").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("text").collect()
    out = []
    for header in headers:
        columns = dedupe_headers([source_col, SHEET_ROW, *_cells(header.text)])[2:]
        missing = [c for c in required if c not in columns]
        if missing:
            raise ValueError(f"no column {', '.join(map(repr, missing))} in {', '.join(header.paths)}")
        # positions, not names, in the parser's schema: header text may be anything
        places = ", ".join(f"c{i} string" for i in range(len(columns)))
        own = rows.join(rows.filter((F.col("record") == 0) & (F.col("text") == header.text)).select("path"), "path", "left_semi")
        parsed = F.from_csv("text", places, {"multiLine": "true", "quote": '"', "escape": '"'})
        cells = own.filter("record > 0").select("path", "record", parsed.alias("cells"))
        out.append(cells.select(*[F.col(f"cells.c{i}").alias(c) for i, c in enumerate(columns)],
                                name(F.col("path")).alias(source_col), F.col("record").alias(SHEET_ROW)))
    return out


def read_sheets(spark: SparkSession, folder: str, required: Sequence[str] = (), source_col: str = SOURCE) -> DataFrame:
    """All sheets in ``folder`` stacked by column name (a column that a sheet lacks is NULL there;
    names that differ in case only are one column)."""
    groups = read_sheet_groups(spark, folder, required, source_col)
    if not groups:
        return spark.createDataFrame([], T.StructType([*string_schema([*required, source_col]), T.StructField(SHEET_ROW, T.LongType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


# --------------------------------------------------------------------------
# Types of a sheet's columns
# --------------------------------------------------------------------------

# One bit per kind of cell.  The kinds of a column's cells are merged by OR, which
# is why any order and any split of the cells gives the same type.
KIND_BITS = {"boolean": 1, "number": 2, "date": 4, "text": 8}
#: A spreadsheet keeps this many digits of a number; longer ones, and ones with leading zeros, are ids.
DIGITS = 15
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
ID_LIKE = rf"^[+-]?0[0-9]|^[+-]?[0-9]{{{DIGITS + 1},}}$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?)?$"


def cell_kind(cell: Column) -> Column:
    """The bit of a cell's kind; 0 for a blank cell."""
    txt = trim_unicode(cell)
    number = txt.rlike(NUMBER) & ~txt.rlike(ID_LIKE)
    return (F.when(cell.isNull() | (txt == ""), 0)
            .when(F.lower(txt).isin("true", "false"), KIND_BITS["boolean"])
            .when(number, KIND_BITS["number"])
            .when(txt.rlike(DATE) & txt.try_cast("timestamp").isNotNull(), KIND_BITS["date"])
            .otherwise(KIND_BITS["text"]))


def kind_name(bits: Column) -> Column:
    """blank, boolean, number, date or text; different kinds in one column make it text."""
    out = F.when(bits == 0, "blank")
    for name, bit in KIND_BITS.items():
        out = out.when(bits == bit, name)
    return out.otherwise("text")


def sheet_types(sheets: DataFrame, source_col: str = SOURCE, as_text: Sequence[str] = ()) -> DataFrame:
    """Per sheet and column: ``source_col``, column, type -- one aggregate over all cells.  Columns
    in ``as_text`` (ids) are text whatever they hold."""
    columns = [c for c in sheets.columns if c not in (source_col, SHEET_ROW)]
    bits = [F.bit_or(cell_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)]
    merged = sheets.groupBy(source_col).agg(*bits)
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              (F.lit("text") if c in as_text else kind_name(F.col(f"k{i}"))).alias("type"))
                     for i, c in enumerate(columns)])
    return merged.select(source_col, F.inline(rows))


def typed_sheets(sheets: DataFrame, source_col: str = SOURCE, as_text: Sequence[str] = ()) -> DataFrame:
    """The stacked sheets with every column cast to the type that fits all of its cells: numbers to
    double, dates to timestamp, booleans to boolean; text and blank columns stay text."""
    columns = [c for c in sheets.columns if c not in (source_col, SHEET_ROW)]
    merged = sheets.agg(*[F.bit_or(cell_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    kinds = {bit: name for name, bit in KIND_BITS.items()}
    casts = {"number": "double", "date": "timestamp", "boolean": "boolean"}
    out = []
    for i, c in enumerate(columns):
        kind = None if c in as_text else casts.get(kinds.get(merged[f"k{i}"]))
        cell = F.col(f"`{c}`")
        out.append((F.nullif(trim_unicode(cell), F.lit("")).try_cast(kind) if kind else cell).alias(c))
    rest = [F.col(f"`{c}`") for c in sheets.columns if c in (source_col, SHEET_ROW)]
    return sheets.select(*out, *rest)
