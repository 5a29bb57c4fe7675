"""Job-level rules: value change edges, roll-ups without fan-out, attach rules,
range rules (FIXTURES section 4)."""


import pytest
from pyspark.sql import functions as F

from parcelbeam.operators.attach import explode_coverage, left_join_where, newest_per_key
from parcelbeam.operators.change import value_change
from parcelbeam.operators.rollup import joined_row_counts
from parcelbeam.operators.rules import range_violations
from parcelbeam.plans import jobs

HIST = "pin string, year string, class string, twoyr_pri_certified_tot long, oneyr_pri_certified_tot long, mailed_tot long"


def test_value_change_edges(spark):
    hist = spark.createDataFrame([
        ("00000000000001", "2025", "299", 90, 100, 120),
        ("00000000000002", "2025", "299", 90, 100, 121),
        ("00000000000003", "2025", "299", 90, None, 121),
        ("00000000000004", "2025", "299", 90, 0, 5),
        ("00000000000001", "2024", "299", 1, 1, 1000),
    ], HIST)
    req = spark.createDataFrame([
        ("00-00-000-000-0001", "a"), (" 00000000000002\t", "b"), ("00000000000003", "c"),
        ("00000000000004", "d"), ("99999999999999", "e")], "`Permanent Index Number` string, note string")
    out = {r["note"]: r for r in value_change(req, hist, 2025).collect()}
    assert out["a"]["Percent Change"] == pytest.approx(0.2) and out["a"]["Large Increase"] is False
    assert out["b"]["Large Increase"] is True
    assert out["c"]["Percent Change"] is None and out["c"]["Large Increase"] is None
    assert out["d"]["Percent Change"] is None and out["d"]["Large Increase"] is True
    assert out["e"]["2025 Mailed AV"] is None
    assert len(out) == 5
    assert "2023 BoR Certified AV" in value_change(req, hist, 2025).columns


def test_documents_rolled_up_before_join(spark):
    sales = spark.createDataFrame([
        ("00000000010001", "2023", "D2", "2023-02-01", 200, True),
        ("00000000010001", "2024", "D1", "2024-01-01", 100, True),
        ("00000000010001", "2024", "D3", "2024-01-01", None, True),
        ("00000000010001", "2020", "D0", "2020-01-01", 5, True)],
        "pin string, year string, doc_no string, sale_date string, sale_price long, sv_is_outlier boolean"
    ).withColumn("sale_date", F.to_date("sale_date"))
    permits = spark.createDataFrame([
        ("00000000010001", "2023", "P1", "2023-03-01 00:00:00", "roof"),
        ("00000000010001", "2024", "P2", "2024-03-01 00:00:00", "deck")],
        "pin string, assessment_year string, permit_number string, date_issued string, work_description string")
    s = jobs.sale_documents(sales, "2022").collect()[0]
    p = jobs.permit_documents(permits, "2022").collect()[0]
    assert s["sales"] == "[D1, 2024-01-01, $100], [D2, 2023-02-01, $200]"  # NULL price entry skipped
    assert p["permits"] == "[P1, 2023-03-01, roof], [P2, 2024-03-01, deck]"
    units = spark.createDataFrame([("00000000010001",)], "pin string")
    counts = joined_row_counts(units, jobs.permit_documents(permits, "2022").select("pin", "n_permits"),
                               spark.createDataFrame([("00000000010001", 2)], "pin string, n_sales long"))
    assert counts.collect()[0]["joined_rows"] == 4


def test_newest_year_and_coverage(spark):
    df = spark.createDataFrame([("a", "2024"), ("a", "2025"), ("b", "2024")], "pin string, year string")
    got = {r["pin"]: r["year"] for r in newest_per_key(df, "pin", "year").collect()}
    assert got == {"a": "2025", "b": "2024"}
    runs = spark.createDataFrame([("r1", ["1", "2"]), ("r2", []), ("r3", None)], "run_id string, cov array<string>")
    assert sorted(r["t"] for r in explode_coverage(runs, "cov", "t").collect()) == ["1", "2"]


def test_left_join_where_keeps_unmatched(spark):
    left = spark.createDataFrame([("a",), ("b",)], "pin string")
    right = spark.createDataFrame([("a", "2020"), ("b", "2023")], "pin string, year string")
    out = left_join_where(left, right, "pin", F.col("year") >= "2022").collect()
    assert {(r["pin"], r["year"]) for r in out} == {("a", None), ("b", "2023")}


def test_range_rules(spark):
    df = spark.createDataFrame([("1", "16"), ("2", "15"), ("3", "3.5"), ("4", ""), ("5", None)], "pin string, new_bedrooms string")
    got = {r["pin"]: r["reason"] for r in range_violations(df, "pin", {"new_bedrooms": (0, 15)}).collect()}
    assert got == {"1": "out of range", "3": "not whole"}


SHEET_COLUMNS = [
    "QC Flag", "PIN10", "PIN", "Address", "Unit", "Total Number Of Units In Building", "Building SF",
    "New Building SF", "Unit SF", "New Unit SF", "Bedrooms", "New Bedrooms", "Full Baths", "New Full Baths",
    "Half Baths", "New Half Baths", "Neighborhood Code", "Permits", "Sales", "Parking PIN", "Is Parking Space",
    "Parking Space Flag Reason", "Is Common Area", "Triad", "Township"]


def _review_inputs(spark, sf="/root/testdata/sf0.001"):
    from parcelbeam.sources import standins as S
    return [S.pin_universe(spark, sf), S.pin_condo_char(spark, sf), S.pin_permit(spark, sf), S.pin_status(spark, sf),
            S.pin_sale(spark, sf), S.pin_address(spark, sf), S.qc_flags(spark, sf)]


def test_review_sheet_column_order(spark):
    sheet = jobs.unit_review_job(*_review_inputs(spark), "1999")
    assert sheet.columns == SHEET_COLUMNS
    # one row per unit (no QC duplicates in the stand-in sheet), correction columns blank
    assert sheet.count() == sheet.select("PIN").distinct().count()
    assert sheet.filter(F.col("New Bedrooms").isNotNull()).count() == 0


def test_extra_permit_leaves_sales_unchanged(spark):
    """Metamorphic: a unit's sales string does not depend on how many permits it has."""
    inputs = _review_inputs(spark)
    base = {r["PIN"]: r["Sales"] for r in jobs.unit_review_job(*inputs, "1999").collect()}
    permits = inputs[2]
    extra = permits.limit(0).unionByName(
        permits.select("pin").distinct().select(
            "pin", F.lit("2000").alias("assessment_year"), F.concat(F.lit("X"), F.col("pin")).alias("permit_number"),
            F.lit("2000-01-01 00:00:00").alias("date_issued"), F.lit("extra").alias("work_description")))
    inputs[2] = permits.unionByName(extra)
    more = jobs.unit_review_job(*inputs, "1999").collect()
    assert {r["PIN"]: r["Sales"] for r in more} == base
    assert len(more) == len(base)


def test_clashing_request_columns_get_suffixes(spark):
    hist = spark.createDataFrame([("00000000000001", "2025", "299", 90, 100, 120)], HIST)
    req = spark.createDataFrame([("00000000000001", "mine", "p")], "`Permanent Index Number` string, Class string, pin string")
    out = value_change(req, hist, 2025)
    row = out.collect()[0].asDict()
    assert (row["Class x"], row["Class y"], row["pin"]) == ("mine", "299", "p")


def test_returned_sheet_is_checked_under_its_delivered_names(spark):
    sheet = spark.createDataFrame([("1", "99", "9" * 45), ("2", "3", "")], "PIN string, `New Bedrooms` string, `New Unit SF` string")
    got = sorted(tuple(r) for r in jobs.returned_sheet_violations(sheet).collect())
    assert got == [("1", "new_bedrooms", "99", "out of range"), ("1", "new_unit_sf", "9" * 45, "out of range")]


def test_map_frame_carries_wkb(spark):
    from parcelbeam.operators.reshape import neighborhood_map_frame
    medians = spark.createDataFrame([("T", "1-2", "Model", 1, 0.9)], "township_name string, neighborhood_number string, stage string, stage_order int, median_sale_ratio double")
    outlines = spark.createDataFrame([("T", "12", bytearray(b"\x01\x03"))], "township_name string, town_nbhd string, geometry binary")
    assert neighborhood_map_frame(medians, outlines).collect()[0]["geometry"] == bytearray(b"\x01\x03")


def test_stand_ins_keep_every_row(spark):
    from parcelbeam.sources import standins as S
    d = "/root/testdata/sf0.001"
    count = lambda name: spark.read.parquet(f"{d}/{name}.parquet").count()
    assert S.pin_permit(spark, d).count() == count("events") and S.pin_sale(spark, d).count() == count("orders")
    assert S.pin_condo_char(spark, d).count() == S.pin_status(spark, d).count() == 2 * count("customer")
    assert S.assessment_pin(spark, d).count() == count("customer")
    assert S.desk_review_sheets(spark, d).select("PIN").distinct().count() == count("customer")
