"""Ratio-study statistics on hand-computed goldens (FIXTURES section 3 and 4)."""

import math

import pytest
from pyspark.sql import functions as F

from parcelbeam.operators import ratio as R

SCHEMA = "pin string, township_name string, neighborhood_number string, sale_price double, model_value double, desk_review_value double"


def _study(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return R.rank_by_price(R.add_ratios(df))


def _golden(spark):
    return _study(spark, [
        ("1", "T", "N-1", 100.0, 80.0, 90.0),
        ("2", "T", "N-1", 200.0, 200.0, 200.0),
        ("3", "T", "N-2", 300.0, 360.0, 270.0),
        ("4", "T", "N-2", None, 150.0, 150.0),
    ])


def test_three_row_town_stats(spark):
    row = R.town_stats(_golden(spark)).collect()[0]
    assert row["model_ratio"] == pytest.approx(1.0)
    assert row["model_cod"] == pytest.approx(13.333333)
    assert row["model_prd"] == pytest.approx(0.9375)
    assert row["model_prb"] == pytest.approx(0.209723, abs=1e-6)
    assert row["model_mki"] == pytest.approx(1.3125)
    assert row["desk_review_ratio"] == pytest.approx(0.9)
    assert row["desk_review_cod"] == pytest.approx(3.703704)
    assert row["desk_review_prd"] == pytest.approx(1.0)
    assert row["desk_review_prb"] == pytest.approx(0.016140, abs=1e-6)
    assert row["desk_review_mki"] == pytest.approx(0.964286)
    assert row["price_range"] == "$100-$300"
    assert row["number_of_sales"] == 3


def test_three_row_deciles(spark):
    got = {r["pin"]: r["price_decile"] for r in _golden(spark).collect()}
    assert got == {"1": 1, "2": 2, "3": 3, "4": None}


def test_one_sale_township(spark):
    d = _study(spark, [("1", "T", "N", 100.0, 90.0, 90.0)])
    row = R.town_stats(d).collect()[0]
    assert row["model_ratio"] == pytest.approx(0.9)
    assert row["model_cod"] == 0
    assert row["model_prd"] == pytest.approx(1.0)
    assert row["model_prb"] is None
    assert row["model_mki"] is None  # G(price) = 0


def test_null_model_value_strict_vs_lenient(spark):
    d = _study(spark, [
        ("1", "T", "N", 100.0, 90.0, 90.0),
        ("2", "T", "N", 100.0, None, 100.0),
        ("3", "T", "N", 100.0, 110.0, 100.0),
    ])
    town = R.town_stats(d).collect()[0]
    assert town["model_ratio"] is None and town["model_cod"] is None and town["model_mki"] is None
    assert town["desk_review_ratio"] == pytest.approx(1.0)
    nb = {r["stage"]: r["median_sale_ratio"] for r in R.neighborhood_medians(d).collect()}
    assert nb["Model"] == pytest.approx(1.0)


def test_zero_price_gives_infinite_ratio(spark):
    d = _study(spark, [("1", "T", "N", 0.0, 90.0, 90.0), ("2", "T", "N", 100.0, 100.0, 100.0)])
    ratios = {r["pin"]: r["model_sale_ratio"] for r in d.collect()}
    assert ratios["1"] == math.inf and ratios["2"] == pytest.approx(1.0)
    nothing = R.add_ratios(spark.createDataFrame([("1", "T", "N", 0.0, 0.0, None)], SCHEMA)).collect()[0]
    assert nothing["model_sale_ratio"] is None and nothing["desk_review_sale_ratio"] is None


def test_scaling_leaves_statistics_unchanged(spark):
    rows = [(str(i), "T", "N", 1000.0 + 37 * i, 900.0 + 41 * (i % 7) + 30 * i, 950.0 + 33 * i) for i in range(40)]
    base = R.town_stats(_study(spark, rows)).collect()[0]
    k = 3.0
    scaled_rows = [(p, t, n, s * k, m * k, dr * k) for p, t, n, s, m, dr in rows]
    scaled = R.town_stats(_study(spark, scaled_rows)).collect()[0]
    for c in ("model_ratio", "model_cod", "model_prd", "model_prb", "model_mki"):
        assert scaled[c] == pytest.approx(base[c], abs=2e-6), c


def test_medians_match_spark_median(spark):
    rows = [(str(i), f"T{i % 3}", "N", 100.0 + i, 80.0 + (i * 7) % 50, 90.0) for i in range(101)]
    d = _study(spark, rows)
    long = R.stage_long(d, ["township_name", "pin"])
    ours = R.median_stats(long, ["stage", "township_name"])
    ref = long.groupBy("stage", "township_name").agg(F.median("ratio").alias("m"))
    for r in ours.join(ref, ["stage", "township_name"]).collect():
        assert math.isclose(r["median"], r["m"], rel_tol=1e-12)


def test_deciles_and_curve(spark):
    rows = [(str(i), "T", "N", 100.0 + i, 100.0 + i, 95.0 + i) for i in range(25)]
    d = _study(spark, rows)
    dec = R.ratio_deciles(d)
    sizes = sorted(r["number_of_sales"] for r in dec.collect())
    assert sizes == [2, 2, 2, 2, 2, 3, 3, 3, 3, 3]
    from parcelbeam.operators.reshape import curve_axis, curve_long
    curve = curve_long(dec)
    assert curve.count() == 20
    axis = curve_axis(curve).collect()
    assert axis[0]["y_min"] == pytest.approx(0.7) and axis[0]["y_max"] == pytest.approx(1.3)
    assert [r["axis_break"] for r in axis] == pytest.approx([0.7 + 0.1 * i for i in range(7)])


def test_unmatched_desk_review_is_reported(spark):
    from parcelbeam.plans import jobs
    universe = spark.createDataFrame(
        [("01", "2025", "T", "N-1"), ("02", "2024", "T", "N-1")],
        "pin string, year string, township_name string, nbhd_code string")
    models = spark.createDataFrame([("r", "2025", "res", ["1"])],
                                   "run_id string, year string, type string, township_code_coverage array<string>")
    assessments = spark.createDataFrame(
        [("r", "1", "01", 90.0, 100.0, None, "D1"), ("r", "1", "02", 80.0, None, None, None)],
        "run_id string, township_code string, meta_pin string, pred_pin_final_fmv_round double, "
        "sale_ratio_study_price double, sale_ratio_study_date date, sale_ratio_study_document_num string")
    desk = spark.createDataFrame([("01", 95.0), ("0-2", 85.0), ("99", 1.0)], "pin string, desk_review_value double")
    desk = desk.withColumn("pin", F.regexp_replace("pin", "-", ""))
    out = jobs.ratio_study_job(desk, universe, models, assessments, None, "2025", "res", ["2024", "2025"])
    assert [r["pin"] for r in out["unmatched"].collect()] == ["99"]
    assert out["all_parcels"].count() == 2
    town = out["town_stats"].collect()[0]
    assert town["Number Of Sales"] == 1 and town["Model Ratio"] == pytest.approx(0.9)


def test_town_stats_without_broadcast(spark):
    """Above the broadcast bound the medians are shuffle-joined; same numbers."""
    from parcelbeam.operators.attach import MAX_BROADCAST_ROWS_CONF
    rows = [(str(i), f"T{i % 3}", "N", 1000.0 + 37 * i, 900.0 + 41 * (i % 7) + 30 * i, 950.0 + 33 * i) for i in range(60)]
    base = {r["township_name"]: r for r in R.town_stats(_study(spark, rows)).collect()}
    spark.conf.set(MAX_BROADCAST_ROWS_CONF, "0")
    try:
        shuffled = {r["township_name"]: r for r in R.town_stats(_study(spark, rows)).collect()}
    finally:
        spark.conf.unset(MAX_BROADCAST_ROWS_CONF)
    assert shuffled == base


def test_zero_and_nan_prices(spark):
    rows = [(str(i), "T", "N", float(100 * i), 90.0 * i, 90.0 * i) for i in range(1, 6)]
    row = R.town_stats(_study(spark, rows + [("9", "T", "N", 0.0, 50.0, 50.0)])).collect()[0]
    assert row["model_ratio"] == pytest.approx(0.9)  # the infinite ratio ranks last
    assert row["model_cod"] is None and row["model_prd"] is None and row["model_prb"] is None
    assert row["model_mki"] is not None and row["number_of_sales"] == 6


def test_null_neighborhoods_are_a_group(spark):
    rows = [(str(i), "T", None if i % 3 == 0 else f"N{i % 2}", 100.0, 80.0 + i, 90.0 + i) for i in range(30)]
    got = {(r["neighborhood_number"], r["stage"]): r["median_sale_ratio"]
           for r in R.neighborhood_medians(R.add_ratios(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(got) == 6 and got[None, "Model"] == pytest.approx(0.935)


def test_a_parcel_on_two_sheets_gives_the_same_under_any_input_order(spark):
    rows = [("1", "T", "N", 100.0, 90.0, 50.0), ("1", "T", "N", 100.0, 90.0, 150.0), ("2", "T", "N", 100.0, 80.0, 90.0),
            ("3", "T", "N", 200.0, 190.0, 210.0), ("4", "T", "N", 300.0, 330.0, 290.0)]
    one, two = (R.town_stats(_study(spark, r)).collect() for r in (rows, rows[::-1]))
    assert one == two
