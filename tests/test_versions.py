"""Deliverables switched by a manifest."""

import glob
import os

import pytest

from parcelbeam.sources import versions
from parcelbeam.sources.sinks import read_review_sheets, write_review_sheets

SCHEMA = "Triad string, Township string, PIN string"


def sheet(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, path):
    return sorted((r["workbook"], r["Township"], r["PIN"]) for r in read_review_sheets(spark, path).collect())


def test_a_run_that_stops_before_the_switch_changes_nothing(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "sheets")
    write_review_sheets(sheet(spark, [("South", "T1", "1"), ("South", "T2", "2"), ("North", "01", "3")]), path, 2025)
    old = rows(spark, path)
    assert old == [("north_condo_review_2025", "01", "3"), ("south_condo_review_2025", "T1", "1"), ("south_condo_review_2025", "T2", "2")]
    reader = read_review_sheets(spark, path)  # a reader that began before the switch

    def stop(*_, **__):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            write_review_sheets(sheet(spark, [("South", "T1", "9")]), path, 2025)
    assert rows(spark, path) == old
    write_review_sheets(sheet(spark, [("South", "T1", "9")]), path, 2025)
    assert rows(spark, path) == [("south_condo_review_2025", "T1", "9")]
    assert reader.count() == 3
    gone = versions.drop_unlisted(spark, path)
    assert len(gone) == 3  # the old version, the stopped one, the old manifest
    assert rows(spark, path) == [("south_condo_review_2025", "T1", "9")]


def test_a_covered_workbook_without_rows_goes_and_others_stay(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sheets")
    write_review_sheets(sheet(spark, [("South", "T1", "1"), ("North Side", "T2", "2")]), path, 2025)
    write_review_sheets(sheet(spark, [("South", "T1", "5")]), path, 2024)
    write_review_sheets(sheet(spark, []), path, 2025, triads=["North Side"])
    assert rows(spark, path) == [("south_condo_review_2024", "T1", "5"), ("south_condo_review_2025", "T1", "1")]
    write_review_sheets(sheet(spark, []), path, 2025)
    assert rows(spark, path) == [("south_condo_review_2024", "T1", "5")]
    write_review_sheets(sheet(spark, []), path, 2024)
    assert rows(spark, path) == [] and {"workbook", "Township"} <= set(read_review_sheets(spark, path).columns)


def test_an_unfinished_manifest_is_passed_over_and_its_number_not_reused(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sheets")
    write_review_sheets(sheet(spark, [("South", "T1", "1")]), path, 2025)
    for number, text in ((2, '{"deliverables": {"x"'), (3, "")):
        with open(os.path.join(path, f"manifest-{number:09d}.json"), "w") as f:
            f.write(text)
    assert rows(spark, path) == [("south_condo_review_2025", "T1", "1")]
    write_review_sheets(sheet(spark, [("South", "T1", "2")]), path, 2025)
    assert rows(spark, path) == [("south_condo_review_2025", "T1", "2")]
    assert os.path.exists(os.path.join(path, "manifest-000000004.json"))


def test_a_number_taken_by_another_run(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "sheets")
    write_review_sheets(sheet(spark, [("South", "T1", "1")]), path, 2025)
    first = versions.stage(sheet(spark, [("a", "T1", "2")]).withColumnRenamed("Triad", "workbook"), path, "workbook", ["Township"])
    second = versions.stage(sheet(spark, [("b", "T1", "3")]).withColumnRenamed("Triad", "workbook"), path, "workbook", ["Township"])
    look, calls = versions._manifests, []

    def late(*args):  # the other run commits between this one's look and its own commit
        found = look(*args)
        calls.append(1)
        if len(calls) == 2:
            versions.commit(spark, path, [second])
        return found
    monkeypatch.setattr(versions, "_manifests", late)
    assert versions.commit(spark, path, [first]) == 3
    assert set(versions.listed(spark, path)) == {"a", "b", "south_condo_review_2025"}
    assert len(glob.glob(os.path.join(path, "manifest-*.json"))) == 3


def test_names_and_types_come_back_as_written(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    df = spark.createDataFrame([("007", "a=b/c %1", 1), ("8", "ü", 2)], "part string, name string, v int")
    versions.replace(df, path, "name", ["part"])
    assert sorted((r["name"], r["part"], r["v"]) for r in versions.read(spark, path, "name").collect()) == [("a=b/c %1", "007", 1), ("ü", "8", 2)]
    assert versions.read(spark, os.path.join(tmpdir_path, "none"), "name").columns == ["name"]
