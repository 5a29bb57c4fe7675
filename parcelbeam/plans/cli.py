"""Command-line runner for the jobs (spark-submit friendly).

    spark-submit -m parcelbeam.plans.cli value-change \\
        --requests <sheet folder> --history <table> --mail-year 2025 --out <folder>
    ... unit-review --universe ... --chars ... --permits ... --status ... --sales ...
        --addresses ... --qc <sheet folder> --min-year 2022 [--triad South] --out <folder>
    ... ratio-study --desk-review <sheet folder> --universe ... --models ... --assessments ...
        [--polygons <table>] --model-year 2025 --model-type res --universe-years 2024,2025 --out <folder>
    ... check-returned --sheets <sheet folder> --out <folder>

Warehouse tables are Parquet paths (or ``table:<name>`` for a catalog
table); user sheets are folders of CSV files with a header row, read with
every column as text.  Outputs are partitioned Parquet datasets; those of
value-change and unit-review are versions behind a manifest (read them with
``sinks.read_value_change`` and ``sinks.read_review_sheets``).
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from parcelbeam.operators.change import REQUEST_KEY
from parcelbeam.plans import jobs
from parcelbeam.session import build_session, release_written
from parcelbeam.sources import sinks
from parcelbeam.sources.ingest import read_sheet_groups, read_sheets


def load_table(spark: SparkSession, ref: str) -> DataFrame:
    return spark.table(ref[len("table:"):]) if ref.startswith("table:") else spark.read.parquet(ref)


def run_value_change(spark: SparkSession, a: argparse.Namespace) -> str:
    # one frame per distinct header: each output file keeps its own sheet's columns
    history = load_table(spark, a.history)
    return sinks.write_value_change(
        [jobs.value_change_job(sheets, history, a.mail_year, Decimal(a.factor), a.key_column)
         for sheets in read_sheet_groups(spark, a.requests, [a.key_column])], a.out)


def run_check_returned(spark: SparkSession, a: argparse.Namespace) -> str:
    jobs.returned_sheet_violations(read_sheets(spark, a.sheets, [a.key_column]), a.key_column).write.mode(
        "overwrite").parquet(a.out)
    return a.out


def run_unit_review(spark: SparkSession, a: argparse.Namespace) -> str:
    sheet = jobs.unit_review_job(
        load_table(spark, a.universe), load_table(spark, a.chars), load_table(spark, a.permits),
        load_table(spark, a.status), load_table(spark, a.sales), load_table(spark, a.addresses),
        read_sheets(spark, a.qc, ["14-Digit PIN", "Flag Comments"]), a.min_year, a.triad or None, a.map_url)
    return sinks.write_review_sheets(sheet, a.out, a.year, a.triad or None)


def run_ratio_study(spark: SparkSession, a: argparse.Namespace) -> dict[str, str]:
    polygons = load_table(spark, a.polygons) if a.polygons else None
    sheets = read_sheets(spark, a.desk_review, ["PIN", "Desk Review Value"])
    outputs = jobs.ratio_study_job(
        jobs.desk_review_values(sheets), load_table(spark, a.universe),
        load_table(spark, a.models), load_table(spark, a.assessments), polygons,
        a.model_year, a.model_type, [y.strip() for y in a.universe_years.split(",")])
    outputs["rejected_values"] = jobs.rejected_values(sheets)
    return sinks.write_ratio_study(outputs, a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parcelbeam")
    sub = p.add_subparsers(dest="job", required=True)

    v = sub.add_parser("value-change")
    v.add_argument("--requests", required=True)
    v.add_argument("--history", required=True)
    v.add_argument("--mail-year", type=int, required=True)
    v.add_argument("--factor", default="1.2")
    v.add_argument("--key-column", default=REQUEST_KEY)
    v.add_argument("--out", required=True)

    u = sub.add_parser("unit-review")
    for name in ("universe", "chars", "permits", "status", "sales", "addresses", "qc", "out"):
        u.add_argument(f"--{name}", required=True)
    u.add_argument("--min-year", required=True)
    u.add_argument("--triad", action="append", default=[])
    u.add_argument("--map-url", default=jobs.DEFAULT_MAP_URL)
    u.add_argument("--year", type=int, help="year in the workbook name (default: current year)")

    c = sub.add_parser("check-returned")
    c.add_argument("--sheets", required=True)
    c.add_argument("--key-column", default="PIN")
    c.add_argument("--out", required=True)

    r = sub.add_parser("ratio-study")
    for name in ("desk-review", "universe", "models", "assessments", "out"):
        r.add_argument(f"--{name}", required=True)
    r.add_argument("--polygons")
    r.add_argument("--model-year", required=True)
    r.add_argument("--model-type", default="res")
    r.add_argument("--universe-years", required=True)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    spark = spark or build_session(os.environ.get("PARCELBEAM_MASTER"))
    runner = {"value-change": run_value_change, "unit-review": run_unit_review,
              "check-returned": run_check_returned, "ratio-study": run_ratio_study}[a.job]
    try:
        return runner(spark, a)
    finally:  # outputs are delivered: nothing reads the run's own tables any more
        release_written(spark)


if __name__ == "__main__":
    print(main())
