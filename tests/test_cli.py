"""The command-line jobs over warehouse tables and sheet folders written from
the stand-in views (a small end-to-end run of each job with its sink)."""

import os

from pyspark.sql import functions as F

from parcelbeam.plans import cli
from parcelbeam.sources import standins as S
from parcelbeam.sources.sinks import read_review_sheets, read_value_change

SF = "/root/testdata/sf0.001"


def _table(df, root, name):
    path = os.path.join(root, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _sheets(df, root, name, by):
    path = os.path.join(root, name)
    df.write.mode("overwrite").option("header", "true").partitionBy(by).csv(path + "_parts")
    # one CSV per value of ``by`` in a flat folder, as users drop them
    os.makedirs(path)
    for entry in os.listdir(path + "_parts"):
        if "=" not in entry:
            continue
        label = entry.split("=", 1)[1]
        for f in os.listdir(os.path.join(path + "_parts", entry)):
            if f.endswith(".csv"):
                os.link(os.path.join(path + "_parts", entry, f), os.path.join(path, f"{label}-{f[:8]}.csv"))
    return path


def test_value_change_cli(spark, tmpdir_path):
    hist = _table(S.pin_history(spark, SF), tmpdir_path, "hist")
    req = _sheets(S.value_requests(spark, SF).withColumnRenamed("source_file", "sheet"), tmpdir_path, "req", "sheet")
    out = os.path.join(tmpdir_path, "out")
    cli.main(["value-change", "--requests", req, "--history", hist, "--mail-year", "2000", "--out", out], spark)
    back = read_value_change(spark, out)
    assert back.count() == S.value_requests(spark, SF).count()
    assert "2000 Mailed AV" in back.columns and "source_file" in back.columns


def test_unit_review_cli(spark, tmpdir_path):
    paths = {n: _table(fn(spark, SF), tmpdir_path, n) for n, fn in {
        "universe": S.pin_universe, "chars": S.pin_condo_char, "permits": S.pin_permit,
        "status": S.pin_status, "sales": S.pin_sale, "addresses": S.pin_address}.items()}
    qc = _sheets(S.qc_flags(spark, SF).withColumn("batch", F.lit("flags")), tmpdir_path, "qc", "batch")
    out = os.path.join(tmpdir_path, "review")
    args = ["unit-review", "--qc", qc, "--min-year", "1999", "--out", out]
    for n, p in paths.items():
        args += [f"--{n}", p]
    cli.main(args, spark)
    back = read_review_sheets(spark, out)
    assert back.count() > 0
    assert {"Triad", "Township", "QC Flag", "PIN"} <= set(back.columns)


def test_ratio_study_cli(spark, tmpdir_path):
    paths = {n: _table(fn(spark, SF), tmpdir_path, n) for n, fn in {
        "universe": S.pin_universe, "models": S.final_model, "assessments": S.assessment_pin}.items()}
    desk = _sheets(S.desk_review_sheets(spark, SF).withColumnRenamed("source_file", "file"), tmpdir_path, "desk", "file")
    out = os.path.join(tmpdir_path, "ratio")
    args = ["ratio-study", "--desk-review", desk, "--model-year", "2000", "--universe-years", "1999,2000",
            "--out", out]
    for n, p in paths.items():
        args += [f"--{n}", p]
    written = cli.main(args, spark)
    assert set(written) >= {"all_parcels", "ratio_deciles", "town_stats", "curve", "curve_axis", "neighborhood_medians"}
    assert spark.read.parquet(written["unmatched"]).count() == 0
    towns = spark.read.parquet(written["town_stats"])
    assert towns.count() == 25
    assert towns.select("township_file").distinct().count() == 25
