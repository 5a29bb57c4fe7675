"""Driver queries: one callable per inventory group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables through the stand-in views of
``parcelbeam.sources.standins``; the only filters are the jobs' own
parameters (mail year, oldest sales/permit year, model run, universe years).
Column names equal those of the SQL in ``parcelbeam.plans.oracles``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelbeam.functions.keys import clean_pin, pretty_pin
from parcelbeam.functions.names import rename_all, title_case
from parcelbeam.functions.text import (
    address_line, alnum_words, blank_to_null, map_link, sale_entry, search_link)
from parcelbeam.operators import ratio as R
from parcelbeam.operators.attach import (
    final_model_values, keep_flagged_groups, left_join_where, most_recent_parcels, newest_per_key)
from parcelbeam.operators.reshape import curve_axis, curve_long, neighborhood_map_frame
from parcelbeam.operators.rollup import building_unit_counts, joined_row_counts
from parcelbeam.plans import jobs
from parcelbeam.session import ensure_checkpoint_dir, stable, written
from parcelbeam.sources import sinks
from parcelbeam.sources import standins as S
from parcelbeam.sources.ingest import folder_value, read_sheet_groups, read_sheets, sheet_types
from parcelbeam.sources.templates import packaged_template

# Job parameters used by the driver queries (the test mapping's counterparts
# of the reference's mail year 2025 / oldest year 2022 / universe 2024-2025).
MAIL_YEAR = 2000
MIN_YEAR = "1999"
UNIVERSE_YEARS = ("1999", "2000")

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- ratio study

def _ratio_parcels(spark: SparkSession, d: str) -> DataFrame:
    return jobs.ratio_parcels(
        jobs.desk_review_values(S.desk_review_sheets(spark, d)), S.pin_universe(spark, d),
        S.final_model(spark, d), S.assessment_pin(spark, d), S.MODEL_YEAR, S.MODEL_TYPE, UNIVERSE_YEARS)


def ratio_town_stats(spark: SparkSession, d: str) -> DataFrame:
    """Township statistics over the ranked layout (W4 by rank, medians by selection)."""
    return R.town_stats(jobs.study_layout(_ratio_parcels(spark, d)).filter(F.col("township_name").isNotNull()))


def _deciled(spark: SparkSession, d: str) -> DataFrame:
    return R.add_price_deciles(jobs.study_base(_ratio_parcels(spark, d)))


def ratio_deciles(spark: SparkSession, d: str) -> DataFrame:
    """Decile cuts and medians both by histogram selection: no row is ranked.  The deciled rows are
    scanned three times, so they are written once."""
    return R.ratio_deciles(written(_deciled(spark, d), "deciled"))


def ratio_all_parcels(spark: SparkSession, d: str) -> DataFrame:
    return jobs.all_parcels_sheet(_deciled(spark, d))


def ratio_curve_long(spark: SparkSession, d: str) -> DataFrame:
    return curve_long(ratio_deciles(spark, d))


def ratio_curve_axis(spark: SparkSession, d: str) -> DataFrame:
    return curve_axis(ratio_curve_long(spark, d))


def neighborhood_medians_long(spark: SparkSession, d: str) -> DataFrame:
    return R.neighborhood_medians(jobs.study_base(_ratio_parcels(spark, d)))


def neighborhood_map_frame_q(spark: SparkSession, d: str) -> DataFrame:
    polygons = S.neighborhood_polygons(S.pin_universe(spark, d))
    return neighborhood_map_frame(neighborhood_medians_long(spark, d), polygons)


def strict_vs_lenient_median(spark: SparkSession, d: str) -> DataFrame:
    return R.strict_and_lenient(jobs.study_base(_ratio_parcels(spark, d)))


def newest_row_per_key(spark: SparkSession, d: str) -> DataFrame:
    return most_recent_parcels(S.pin_universe(spark, d), UNIVERSE_YEARS)


def coverage_explode_join(spark: SparkSession, d: str) -> DataFrame:
    return final_model_values(S.final_model(spark, d), S.assessment_pin(spark, d), S.MODEL_YEAR, S.MODEL_TYPE)


# ------------------------------------------------------------ value change

def value_change_flags(spark: SparkSession, d: str) -> DataFrame:
    return jobs.value_change_job(S.value_requests(spark, d), S.pin_history(spark, d), MAIL_YEAR)


def clean_request_keys(spark: SparkSession, d: str) -> DataFrame:
    req = S.value_requests(spark, d)
    return req.select("source_file", F.col("`Permanent Index Number`").alias("raw_key"),
                      clean_pin(F.col("`Permanent Index Number`")).alias("pin"))


def stacked_requests(spark: SparkSession, d: str) -> DataFrame:
    """Desk-review sheets stacked by column name; the sheets of two regions carry
    an extra reviewer column that the others lack (R1, R5, S1, S4)."""
    sheets = S.desk_review_sheets(spark, d)
    base = S.parcel_base(spark, d).select(F.col("pin").alias("PIN"), "triad_name")
    labelled = sheets.join(base, "PIN", "inner")
    with_reviewer = labelled.filter(F.col("triad_name").isin("AFRICA", "ASIA")).withColumn(
        "Reviewer", F.concat(F.lit("desk-"), F.lower("triad_name"))).drop("triad_name")
    without = labelled.filter(~F.col("triad_name").isin("AFRICA", "ASIA")).drop("triad_name")
    stacked = with_reviewer.unionByName(without, allowMissingColumns=True)
    return stacked.select("source_file", clean_pin("PIN").alias("pin"),
                          F.col("`Desk Review Value`").alias("desk_review_value"), F.col("Reviewer").alias("reviewer"))


def unmatched_requests(spark: SparkSession, d: str) -> DataFrame:
    """Audit (D9): request rows whose parcel has no value row for the mail year."""
    req = S.value_requests(spark, d).withColumn("pin", clean_pin(F.col("`Permanent Index Number`")))
    hist = S.pin_history(spark, d).filter(F.col("year") == str(MAIL_YEAR)).select("pin")
    return req.join(hist, "pin", "left_anti").select("source_file", "pin")


# ------------------------------------------------------------- unit review

def _units_all_triads(spark: SparkSession, d: str) -> DataFrame:
    return S.pin_universe(spark, d).join(S.pin_condo_char(spark, d), ["pin", "year"], "inner")


def condo_join_chain(spark: SparkSession, d: str) -> DataFrame:
    """Universe x characteristics (inner) with status and address (left) on
    (pin, year), and permits / outlier sales from MIN_YEAR on (left, predicates
    on the right side only), the latter two counted per parcel instead of
    multiplied out (J2-J6, P18)."""
    units = _units_all_triads(spark, d)
    units = units.join(S.pin_status(spark, d), ["pin", "year"], "left").join(
        S.pin_address(spark, d), ["pin", "year"], "left")
    permits = jobs.permit_documents(S.pin_permit(spark, d), MIN_YEAR).select("pin", "n_permits")
    sales = jobs.sale_documents(S.pin_sale(spark, d), MIN_YEAR).select("pin", "n_sales")
    chained = left_join_where(units, permits, "pin", F.col("n_permits") > 0)
    chained = left_join_where(chained, sales, "pin", F.col("n_sales") > 0)
    return chained.select(
        "pin", "year", "triad_name", "township_name", "building_sf", "is_parking_space",
        "prop_address_full", F.coalesce("n_permits", F.lit(0)).alias("n_permits"),
        F.coalesce("n_sales", F.lit(0)).alias("n_sales"))


def building_joined_rows(spark: SparkSession, d: str) -> DataFrame:
    """Literal COUNT(*) OVER (PARTITION BY pin10) of the reference's fan-out join."""
    permits = jobs.permit_documents(S.pin_permit(spark, d), MIN_YEAR).select("pin", "n_permits")
    sales = jobs.sale_documents(S.pin_sale(spark, d), MIN_YEAR).select("pin", "n_sales")
    return joined_row_counts(_units_all_triads(spark, d), permits, sales).withColumnRenamed(
        "joined_rows", "total_number_of_units_in_building")


def building_unit_count(spark: SparkSession, d: str) -> DataFrame:
    return building_unit_counts(_units_all_triads(spark, d))


def flagged_buildings(spark: SparkSession, d: str) -> DataFrame:
    uni = S.pin_universe(spark, d).select("pin", "pin10").distinct()
    return keep_flagged_groups(uni, jobs.flagged_units(S.qc_flags(spark, d)))


def sale_document_text(spark: SparkSession, d: str) -> DataFrame:
    s = S.pin_sale(spark, d)
    return s.select("doc_no", "pin", sale_entry("doc_no", "sale_date", "sale_price").alias("sales"))


def documents_per_unit(spark: SparkSession, d: str) -> DataFrame:
    """Per parcel: sorted sale and permit strings, each side rolled up before the
    join so no sale x permit pairs form (A1, W5, D2, D3)."""
    permits = jobs.permit_documents(S.pin_permit(spark, d), MIN_YEAR)
    sales = jobs.sale_documents(S.pin_sale(spark, d), MIN_YEAR)
    units = S.pin_universe(spark, d).select("pin").distinct()
    return (units.join(sales, "pin", "left").join(permits, "pin", "left")
            .select("pin", "sales", "permits"))


def first_row_per_unit(spark: SparkSession, d: str) -> DataFrame:
    """One row per unit: its newest (pin, year) row of universe x characteristics."""
    units = newest_per_key(_units_all_triads(spark, d), "pin", "year")
    return units.select("pin", "year", "triad_name", "township_name", "building_sf", "unit_sf", "bedrooms")


def address_and_links(spark: SparkSession, d: str) -> DataFrame:
    uni = newest_per_key(S.pin_universe(spark, d), "pin", "year")
    j = uni.join(S.pin_address(spark, d), ["pin", "year"], "left")
    raw = address_line("prop_address_full", "prop_address_city_name", "prop_address_zipcode_1")
    return j.select(
        "pin", raw.alias("address_raw"), alnum_words(raw).alias("address"),
        search_link(alnum_words(raw)).alias("address_link"),
        map_link("lon", "lat", "pin10").alias("map_link"),
        pretty_pin("pin", full_length=True).alias("pin_pretty"))


def blank_to_null_q(spark: SparkSession, d: str) -> DataFrame:
    a = S.pin_address(spark, d)
    return blank_to_null(a)


def placeholder_columns(spark: SparkSession, d: str) -> DataFrame:
    c = S.pin_condo_char(spark, d)
    cols = []
    for name in ("building_sf", "unit_sf", "bedrooms", "full_baths", "half_baths"):
        cols += [name, F.lit(None).cast("string").alias(f"new_{name}")]
    return c.select("pin", "year", *cols)


def _review_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    return (S.pin_universe(spark, d), S.pin_condo_char(spark, d), S.pin_permit(spark, d), S.pin_status(spark, d),
            S.pin_sale(spark, d), S.pin_address(spark, d), S.qc_flags(spark, d))


def unit_review_sheet(spark: SparkSession, d: str) -> DataFrame:
    return jobs.unit_review_job(*_review_inputs(spark, d), MIN_YEAR)


def range_rule_violations(spark: SparkSession, d: str) -> DataFrame:
    """Returned corrections under the delivered column names, derived from the customer
    table, checked against the sheet's range rules (Q1-Q3)."""
    c = S.parcel_base(spark, d)
    k = F.col("c_custkey")
    returned = c.select(
        F.col("pin").alias("PIN"),
        F.when(k % 7 == 0, F.col("c_acctbal").cast("string")).alias("New Building SF"),
        F.when(k % 11 == 0, F.repeat(F.lit("9"), F.lit(45)))
        .when(k % 5 == 0, (k * 13 % 12001).cast("string")).alias("New Unit SF"),
        F.when(k % 3 == 0, (k % 20).cast("string")).when(k % 3 == 1, F.lit("")).alias("New Bedrooms"),
        F.when(k % 4 == 0, F.concat((k % 3).cast("string"), F.lit(".5"))).alias("New Full Baths"),
        F.when(k % 6 == 0, F.concat(F.lit(" "), (k % 17).cast("string"), F.lit(" "))).alias("New Half Baths"))
    return jobs.returned_sheet_violations(returned)


def partitioned_output_counts(spark: SparkSession, d: str) -> DataFrame:
    """Write the review sheet partitioned by triad and township under the shared
    checkpoint folder, read it back, count rows per partition (S10-S14, R4, R6)."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "review-sheets", uuid.uuid4().hex)
    sheet = unit_review_sheet(spark, d)
    sinks.write_review_sheets(sheet, path)
    back = sinks.read_review_sheets(spark, path)
    return back.groupBy("Triad", "Township").agg(F.count(F.lit(1)).alias("rows"))


def _shared(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), name, uuid.uuid4().hex)


def _write_layout(sheets: DataFrame, header: str, path: str) -> None:
    """CSV records under one header line at the top of every file, as spreadsheets export them."""
    def with_header(batches):
        yield pa.record_batch([pa.array([header])], names=["value"])
        yield from batches
    quoted = {"quote": '"', "escape": '"', "escapeQuotes": "true"}
    lines = sheets.select(F.to_csv(F.struct("*"), quoted).alias("value"))
    lines.mapInArrow(with_header, "value string").write.mode("append").text(path)


def sheet_intake_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Desk-review sheets written as CSV files in two layouts (other columns, other order) and read
    back by column name: cells with line breaks and quotes, names that differ in case only, and
    repeated names (S1, S2, S4, R1, R5)."""
    path = _shared(spark, "sheets")
    triads = S.parcel_base(spark, d).select(F.col("pin").alias("PIN"), "triad_name", "c_custkey")
    sheets = S.desk_review_sheets(spark, d).join(triads, "PIN")
    reviewed = F.col("triad_name").isin("AFRICA", "ASIA")
    k = F.col("c_custkey")
    comment = (F.when(k % 3 == 0, F.concat(F.lit('said "high",\nthen\n'), k)).when(k % 3 == 1, F.lit("one line")))
    _write_layout(sheets.filter(reviewed).select(
        "PIN", "Desk Review Value", F.concat(F.lit("desk, "), F.lower("triad_name")).alias("a"), comment.alias("b"), (k % 7).alias("c")),
        "PIN,Desk Review Value,Reviewer,Comment,pin", path)
    _write_layout(sheets.filter(~reviewed).select(
        "Desk Review Value", F.lit("x").alias("a"), "PIN", (k % 5).alias("b"), (k % 11).alias("c"), (k % 13).alias("e")),
        "Desk Review Value,source_file,PIN,Note,Note,Note_2", path)
    back = read_sheets(spark, path, ["PIN", "Desk Review Value"])
    return back.select(clean_pin("PIN").alias("pin"), F.col("`Desk Review Value`").try_cast("double").alias("desk_review_value"),
                       F.col("Reviewer").alias("reviewer"), F.col("source_file_2").alias("note"), F.col("Comment").alias("comment"),
                       F.col("pin_2"), F.col("Note").alias("note_1"), F.col("Note_3").alias("note_3"), F.col("Note_2").alias("note_2"))


def sheet_column_types(spark: SparkSession, d: str) -> DataFrame:
    """Types of the columns of each desk-review sheet, from its cells: values and reviews as numbers
    and dates, mixed cells and ids as text (S2)."""
    k = F.col("c_custkey")
    keys = S.parcel_base(spark, d).select(F.col("pin").alias("PIN"), "c_custkey")
    sheets = S.desk_review_sheets(spark, d).join(keys, "PIN").select(
        "PIN", F.col("Desk Review Value").cast("string").alias("Desk Review Value"),
        F.when(k % 4 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (k % 400).cast("int")).cast("string")).alias("Reviewed On"),
        F.when(k % 2 == 0, F.lit("TRUE")).otherwise(F.lit("false ")).alias("Checked"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise((k % 9).cast("string")).alias("Mixed"),
        F.lpad((k % 50).cast("string"), 5, "0").alias("Code"), F.lit(" ").alias("Empty"),
        F.concat((k % 90).cast("string"), F.lit("e2")).alias("Power"), "source_file")
    return sheet_types(sheets, as_text=["PIN"])


def _requests_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The request rows dealt to sheets of at most a thousand parcels, with their place there:
    neither by id nor by name."""
    r = S.value_requests(spark, d).join(
        S.parcel_base(spark, d).select(F.col("c_name").alias("Owner Name"), "c_custkey"), "Owner Name")
    k = F.col("c_custkey")
    block = F.lpad(F.floor(k / 1000).cast("string"), 6, "0")
    return r.withColumn("sheet", F.concat(F.lit("requests "), block, F.lit(".csv"))).withColumn("place", k * 7919 % 1009)


def request_sheet_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Request sheets through the value-change job to one output per sheet, read back with file name,
    columns and the sheet's own row order (S10, R5, P4, P7)."""
    path, out = _shared(spark, "requests"), _shared(spark, "values")
    rows = _requests_in_order(spark, d).select(
        "sheet", "place", "Permanent Index Number", F.concat(F.lit("line\n"), "Owner Name").alias("Sent.By"))
    # a sheet is one file: its rows, a thousand at most, go to one task
    (rows.repartition("sheet").sortWithinPartitions("sheet", "place", "Permanent Index Number").drop("place")
     .write.option("header", "true").option("escape", '"').partitionBy("sheet").csv(path))
    groups = read_sheet_groups(spark, path, ["Permanent Index Number"], name=folder_value)
    history = S.pin_history(spark, d)
    sinks.write_value_change([jobs.value_change_job(g, history, MAIL_YEAR) for g in groups], out)
    back = sinks.read_value_change(spark, out, places=True)
    names = [c for c in back.columns if c not in ("source_file", "_file", "_row")]
    return back.select("source_file", F.lit("|".join(names)).alias("columns"), clean_pin(F.col("`Permanent Index Number`")).alias("pin"),
                       F.col("`Sent By`").alias("sent_by"), F.col(f"`{MAIL_YEAR} Mailed AV`").alias("mailed"),
                       _position(["source_file"]).alias("position"))


def review_sheet_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns of each delivered review tab in their order."""
    path = _shared(spark, "workbooks")
    sinks.write_review_sheets(unit_review_sheet(spark, d), path, 2025)
    back = sinks.read_review_sheets(spark, path)
    names = [c for c in back.columns if c not in ("workbook", "Township", "Triad")]
    return back.select("workbook", "Township").distinct().select(
        "workbook", "Township", F.posexplode(F.array(*map(F.lit, names))).alias("position", "column"))


def _position(keys: list[str]) -> Column:
    """Place of a row within its tab: files in name order, rows in file order (O1, O2)."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy("_file", "_row"))


def review_workbook_rows(spark: SparkSession, d: str) -> DataFrame:
    """Review workbooks written twice, the second time without one township, and read back with
    names, tabs and row order (S11, S13, S14, P9, O1, F20)."""
    path = _shared(spark, "workbooks")
    sheet = stable(unit_review_sheet(spark, d))
    sinks.write_review_sheets(sheet, path, 2025)
    gone = sheet.agg(F.min("Township")).first()[0]
    sinks.write_review_sheets(sheet.filter(F.col("Township") != gone), path, 2025)
    back = sinks.read_review_sheets(spark, path, places=True)
    return back.select("workbook", "Township", "PIN", _position(["workbook", "Township"]).alias("position"))


def ratio_decile_sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """The decile sheets as delivered: file label, headers and row order."""
    path = sinks.write_ratio_study({"ratio_deciles": rename_all(ratio_deciles(spark, d), title_case)},
                                   _shared(spark, "ratio"))["ratio_deciles"]
    back = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return back.select("township_file", "Price Decile", "Number Of Sales",
                       _position(["township_file"]).alias("position"))


def parameterised_query(spark: SparkSession, d: str) -> DataFrame:
    """A packaged SQL template: typed values bound by name, tables passed as DataFrames (S5-S8, P3,
    P15)."""
    return packaged_template("flagged_sales.sql").run(
        spark, {"sales": S.pin_sale(spark, d), "flags": jobs.flagged_units(S.qc_flags(spark, d))}, min_year=MIN_YEAR)


def township_list(spark: SparkSession, d: str) -> DataFrame:
    return S.pin_universe(spark, d).select("triad_name", "township_name").distinct()


QUERIES: dict[str, Query] = {
    "ratio_town_stats": ratio_town_stats,
    "ratio_deciles": ratio_deciles,
    "ratio_all_parcels": ratio_all_parcels,
    "ratio_curve_long": ratio_curve_long,
    "ratio_curve_axis": ratio_curve_axis,
    "neighborhood_medians_long": neighborhood_medians_long,
    "neighborhood_map_frame": neighborhood_map_frame_q,
    "strict_vs_lenient_median": strict_vs_lenient_median,
    "newest_row_per_key": newest_row_per_key,
    "coverage_explode_join": coverage_explode_join,
    "value_change_flags": value_change_flags,
    "clean_request_keys": clean_request_keys,
    "stacked_requests": stacked_requests,
    "unmatched_requests": unmatched_requests,
    "condo_join_chain": condo_join_chain,
    "building_joined_rows": building_joined_rows,
    "building_unit_count": building_unit_count,
    "flagged_buildings": flagged_buildings,
    "sale_document_text": sale_document_text,
    "documents_per_unit": documents_per_unit,
    "first_row_per_unit": first_row_per_unit,
    "address_and_links": address_and_links,
    "blank_to_null": blank_to_null_q,
    "placeholder_columns": placeholder_columns,
    "unit_review_sheet": unit_review_sheet,
    "range_rule_violations": range_rule_violations,
    "partitioned_output_counts": partitioned_output_counts,
    "sheet_intake_roundtrip": sheet_intake_roundtrip,
    "review_workbook_rows": review_workbook_rows,
    "sheet_column_types": sheet_column_types,
    "request_sheet_outputs": request_sheet_outputs,
    "review_sheet_columns": review_sheet_columns,
    "ratio_decile_sheet_rows": ratio_decile_sheet_rows,
    "parameterised_query": parameterised_query,
    "township_list": township_list,
}
