"""Scalar helpers: id cleaning, display formats, strings (FIXTURES section 4)."""



from parcelbeam.functions import keys as K
from parcelbeam.functions import names as N
from parcelbeam.functions import text as T


def _one(spark, expr, schema, *values):
    df = spark.createDataFrame([values], schema)
    return df.select(expr.alias("x")).collect()[0]["x"]


def test_clean_pin_dressed(spark):
    raw = " 01-02-003-004-0005\t"
    assert _one(spark, K.clean_pin("s"), "s string", raw) == "01020030040005"
    assert _one(spark, K.clean_pin("s"), "s string", "　 01020030040005  ") == "01020030040005"


def test_pretty_pin(spark):
    assert _one(spark, K.pretty_pin("s", full_length=True), "s string", "01020030040005") == "01-02-003-004-0005"
    assert _one(spark, K.pretty_pin("s"), "s string", "0102003004") == "01-02-003-004"
    assert _one(spark, K.pretty_pin("s"), "s string", None) is None


def test_pin_from_number(spark):
    assert _one(spark, K.pin_from_number("k"), "k long", 1234) == "00000001230004"


def test_address_line_and_words(spark):
    assert _one(spark, T.address_line("a", "b", "c"), "a string, b string, c string", None, None, None) == ""
    assert _one(spark, T.address_line("a", "b", "c"), "a string, b string, c string", "1 Main", "CITY", "60601") == "1 Main CITY, IL 60601"
    assert _one(spark, T.address_line("a", "b", "c"), "a string, b string, c string", "1 Main", None, "60601") == "1 Main 60601"
    assert _one(spark, T.alnum_words("s"), "s string", "12 Éa-b#3") == "12 Éa b 3"


def test_entries(spark):
    schema = "d string, dt date, p long"
    import datetime as dt
    assert _one(spark, T.sale_entry("d", "dt", "p"), schema, "77", dt.date(2024, 5, 1), 1234567) == "[77, 2024-05-01, $1,234,567]"
    assert _one(spark, T.sale_entry("d", "dt", "p"), schema, "77", dt.date(2024, 5, 1), None) is None
    assert _one(spark, T.sale_entry("d", "dt", "p"), schema, None, dt.date(2024, 5, 1), 5) is None
    assert _one(spark, T.permit_entry("a", "b", "c"), "a string, b string, c string", "P1", "2024-01-02 10:00:00", "roof") == "[P1, 2024-01-02, roof]"


def test_dollar_and_numbers(spark):
    assert _one(spark, T.price_range("a", "b"), "a double, b double", 1013.7, 250000.0) == "$1,014-$250,000"
    assert _one(spark, T.dollar("a"), "a double", -5.0) == "-$5"
    assert _one(spark, T.number_text("a"), "a double", 41.0) == "41"
    assert _one(spark, T.number_text("a"), "a double", -87.623) == "-87.623"
    assert _one(spark, T.number_text("a"), "a double", None) == "NA"


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", "x", 1)], "a string, b string, c int")
    r = T.blank_to_null(df).collect()[0]
    assert r["a"] is None and r["b"] == "x" and r["c"] == 1


def test_names():
    assert N.title_case_acronyms("total_number_of_units_in_building") == "Total Number Of Units In Building"
    assert N.title_case_acronyms("new_building_sf") == "New Building SF"
    assert N.title_case_acronyms("pin10") == "PIN10"
    assert N.title_case_acronyms("parking_pin") == "Parking PIN"
    assert N.dots_to_blanks("2025.Mailed.AV") == "2025 Mailed AV"


def test_relocate(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int")
    out = N.relocate(df, first=["e"], after={"b": ["d"]})
    assert out.columns == ["e", "a", "b", "d", "c"]


def test_numbers_that_are_none_print_na(spark):
    from parcelbeam.functions.text import number_text
    df = spark.createDataFrame([(v,) for v in (float("nan"), float("inf"), None, -87.95, 41.0)], "v double")
    assert [r.t for r in df.select(number_text("v").alias("t")).collect()] == ["NA", "NA", "NA", "-87.95", "41"]


def test_range_rules_trim_all_white_space(spark):
    from parcelbeam.operators.rules import range_violations
    df = spark.createDataFrame([("a", "\t12\u00a0"), ("b", "\u00a0"), ("c", "\u200912.5"), ("d", "\t99")], "pin string, new_bedrooms string")
    got = {(r["pin"], r["reason"]) for r in range_violations(df, rules={"new_bedrooms": (0, 15)}).collect()}
    assert got == {("c", "not whole"), ("d", "out of range")}
