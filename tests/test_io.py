"""Sheet ingest with provenance, partitioned sinks."""

import os


import pytest

from parcelbeam.plans import jobs
from parcelbeam.functions.names import dedupe_headers
from parcelbeam.sources import ingest
from parcelbeam.sources.ingest import read_sheet_groups, read_sheets, sheet_types, typed_sheets
from parcelbeam.sources.sinks import (
    read_review_sheets, read_value_change, write_partitioned, write_ratio_study, write_review_sheets, write_value_change)


def _write_csv(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_sheets_with_their_own_columns_are_read_by_name(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "in")
    os.makedirs(d)
    _write_csv(os.path.join(d, "10 Town+A.csv"), ["Note", "PIN", "Desk Review Value"], [["x", "01020030040005", "100"]])
    _write_csv(os.path.join(d, "11-Töwn_B [2].csv"), ["Desk Review Value", "PIN"], [["200", "01020030040006"]])
    _write_csv(os.path.join(d, "12.csv"), ["PIN", "Desk Review Value", "Note", "Note"], [["1", "2", "a", "b"]])
    _write_csv(os.path.join(d, "13.csv"), ["PIN", "source_file", "Desk Review Value"], [["3", "own", "4"]])
    open(os.path.join(d, "empty.csv"), "w").close()
    got = {r["source_file"]: (r["PIN"], r["Desk Review Value"], r["Note"], r["Note_2"], r["source_file_2"])
           for r in read_sheets(spark, d, ["PIN", "Desk Review Value"]).collect()}
    assert got == {"10 Town+A.csv": ("01020030040005", "100", "x", None, None),
                   "11-Töwn_B [2].csv": ("01020030040006", "200", None, None, None),
                   "12.csv": ("1", "2", "a", "b", None), "13.csv": ("3", "4", None, None, "own")}
    assert dedupe_headers(["a", "a", "b"]) == ["a", "a_2", "b"]
    assert dedupe_headers(["Note", "Note", "Note_2", "PIN", "Pin"]) == ["Note", "Note_3", "Note_2", "PIN", "Pin_2"]


def test_a_sheet_without_a_required_column_is_named(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "in")
    os.makedirs(d)
    _write_csv(os.path.join(d, "good.csv"), ["PIN"], [["1"]])
    _write_csv(os.path.join(d, "bad.csv"), ["Pin"], [["1"]])
    with pytest.raises(ValueError, match="bad.csv"):
        read_sheets(spark, d, ["PIN"])
    empty = os.path.join(tmpdir_path, "none")
    os.makedirs(empty)
    assert read_sheets(spark, empty, ["PIN"]).columns == ["PIN", "source_file", "sheet_row"]


def test_partitioned_write_skips_null_key(spark, tmpdir_path):
    df = spark.createDataFrame([("A B", 1), ("A B", 2), (None, 3)], "Township string, v int")
    out = os.path.join(tmpdir_path, "out")
    write_partitioned(df, out, ["Township"], ["v"])
    back = spark.read.parquet(out)
    assert back.count() == 2


def test_review_workbook_names(spark, tmpdir_path):
    sheet = spark.createDataFrame([("MIDDLE EAST", "NATION 4", "01-02-003-004-0005", 1)],
                                  "Triad string, Township string, PIN string, v int")
    out = os.path.join(tmpdir_path, "sheets")
    write_review_sheets(sheet, out, year=2025)
    (version,) = os.listdir(os.path.join(out, "versions"))
    assert os.path.isdir(os.path.join(out, "versions", version, "workbook=middle_east_condo_review_2025", "Township=NATION 4"))
    assert read_review_sheets(spark, out).select("Triad").first()[0] == "MIDDLE EAST"


def test_decile_rows_are_written_in_order(spark, tmpdir_path):
    rows = spark.createDataFrame([("T", d) for d in (7, 3, 10, 1, 2, 9, 4, 8, 5, 6)], "`Township Name` string, `Price Decile` int")
    path = write_ratio_study({"ratio_deciles": rows}, tmpdir_path)["ratio_deciles"]
    back = spark.read.parquet(path).selectExpr("`Price Decile` AS d", "_metadata.file_name AS f", "_metadata.row_index AS i")
    assert [r["d"] for r in back.orderBy("f", "i").collect()] == list(range(1, 11))


def test_rejected_desk_review_cells_are_listed(spark):
    sheets = spark.createDataFrame([("1", "100", "a.csv"), ("2", "$1,000", "a.csv"), ("3", " ", "b.csv"), ("4", None, "b.csv"), ("5", "NaN", "b.csv")],
                                   "PIN string, `Desk Review Value` string, source_file string")
    assert {r["pin"]: r["desk_review_value"] for r in jobs.desk_review_values(sheets).collect()} == {
        "1": 100.0, "2": None, "3": None, "4": None, "5": None}
    assert [tuple(r) for r in jobs.rejected_values(sheets).collect()] == [("2", "$1,000", "a.csv")]


MESSY = [["01-02", 'two\nlines, and a ""quote""', "last"], ["3", "\n", ""], ["", "x\r\ny", "z"], ["5", "plain", "w"], ["6", "a\n\n\nb", " "]]


def _messy(path, rows, header="PIN,Note,Pin", end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\ufeff" + header + end + end)
        for r in rows:
            f.write(",".join(f'"{c}"' if set(c) & set('\n\r"') else c for c in r) + end)


@pytest.mark.parametrize("end,split", [("\n", None), ("\r\n", None), ("\n", 40)])
def test_records_with_line_breaks_in_sheet_order(spark, tmpdir_path, end, split):
    """Also when a file is read in many blocks that begin inside cells."""
    d = os.path.join(tmpdir_path, "in")
    os.makedirs(d)
    _messy(os.path.join(d, "a.csv"), MESSY * 30, end=end)
    _messy(os.path.join(d, "b.csv"), MESSY[::-1], end=end)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_sheets(spark, d).collect()
    finally:
        if split:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    clean = lambda c: c.replace('""', '"').replace("\r\n", "\n") or None
    for name, rows in (("a.csv", MESSY * 30), ("b.csv", MESSY[::-1])):
        own = sorted((r["sheet_row"], r["PIN"], r["Note"], r["Pin_2"]) for r in got if r["source_file"] == name)
        assert [r[0] for r in own] == list(range(1, len(rows) + 1))
        assert [tuple((c or "").replace("\r\n", "\n") for c in r[1:]) for r in own] == [tuple(clean(c) or "" for c in r) for r in rows]


def test_outputs_keep_file_columns_and_row_order(spark, tmpdir_path):
    d, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    os.makedirs(d)
    _write_csv(os.path.join(d, "one.csv"), ["B", "PIN"], [[str(i * 7 % 50), str(i * 13 % 50)] for i in range(50)])
    _write_csv(os.path.join(d, "two.csv"), ["PIN", "C"], [["9", "x"], ["1", "y"]])
    write_value_change(read_sheet_groups(spark, d), out)
    back = read_value_change(spark, out, places=True)
    rows = back.orderBy("_file", "_row").collect()
    assert [r["B"] for r in rows if r["source_file"] == "one.csv"] == [str(i * 7 % 50) for i in range(50)]
    assert [r["PIN"] for r in rows if r["source_file"] == "two.csv"] == ["9", "1"]
    assert "sheet_row" not in back.columns
    write_value_change(read_sheet_groups(spark, d)[:1], out)  # one of them again: the other stays
    assert read_value_change(spark, out).count() == 52


def test_column_types(spark):
    rows = [("a", "0012", "1.5", "2020-01-02", "TRUE", "x", "", "1234567890123456", "1"), ("a", "13", " -2e3 ", "2020-01-03 10:00", "false", "1", None, "1", "n/a"),
            ("b", "13", ".5", "2020-02-30", "1", "\u00a0", " ", "7", "TRUE")]
    df = spark.createDataFrame(rows, "source_file string, id string, num string, day string, yes string, txt string, none string, long string, mix string")
    got = {(r["source_file"], r["column"]): r["type"] for r in sheet_types(df, as_text=["yes"]).collect()}
    assert [got["a", c] for c in df.columns[1:]] == ["text", "number", "date", "text", "text", "blank", "text", "text"]
    assert [got["b", c] for c in df.columns[1:]] == ["number", "number", "text", "text", "blank", "blank", "number", "boolean"]
    typed = typed_sheets(df.filter("source_file = 'a'"))
    assert [t for _, t in typed.dtypes] == ["string", "double", "timestamp", "boolean", "string", "string", "string", "string", "string"]
    assert [r["num"] for r in typed.collect()] == [1.5, -2000.0]
    assert ingest.sheet_types(df.limit(0)).count() == 0
