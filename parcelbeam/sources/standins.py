"""Warehouse views derived from the driver's TPC-H-style tables.

The jobs read nine warehouse entities (parcel universe, unit
characteristics, permits, status, sales, addresses, value history, final
model runs, per-parcel model values) plus three user sheets (value-change
requests, QC flags, desk-review values).  The test data has none of them,
so each is derived here from whole driver tables, row for row:

* parcel = ``customer``; pin = 10-digit building (custkey div 10) + 4-digit
  unit (custkey mod 10); township = nation, triad = region.
* sale = ``orders`` (price, date, document = orderkey, outlier = status 'F').
* permit = ``events``, on user_id = custkey.
* value history = per-parcel yearly sums of whole-dollar order prices.

No view leaves rows of its table out.  What is missing in real data is missing
here by value: a parcel without characteristics has them for other years only,
an unsold one has no price, some have no neighborhood, some prices are zero or
NaN, and some parcels are on two desk-review sheets.

Every view is a lazy DataFrame over the parquet scans, so filters and column
pruning reach the files.  The same definitions are written in SQL for the
DuckDB oracle (``parcelbeam.plans.oracles``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelbeam.functions import wkb
from parcelbeam.functions.keys import pin_from_number, pretty_pin, strip_dashes
from parcelbeam.functions.text import number_text

# Fixed values of the stand-in data (test mapping, not reference values).
UNIVERSE_YEARS = ("1998", "1999", "2000")
MODEL_YEAR, MODEL_TYPE = "2000", "res"
STREETS = ("N Élm St.", "W Oak-Park Ave", "S Main St #2", "E Lake Shore Dr")
CITIES = ("CHICAGO", "Évanston")
QC_COMMENTS = ("Unit SF looks low", "Bedroom count mismatch", "Check parking")
NBSP, IDEOGRAPHIC_SPACE = "\u00a0", "\u3000"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy scan.  Each (session, file) is opened once:
    opening a Parquet dataset reads its footers to learn the schema (a Spark
    job of its own), and a stand-in view is built from the same table many
    times.  The test tables are read-only, so the schema cannot go stale."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _mod(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


def _idiv(x: Column, n: int) -> Column:
    return F.floor(x / F.lit(n)).cast("long")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index] for index 0..len-1, else NULL."""
    out = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        out = F.when(index == i, F.lit(v)).otherwise(out)
    return out


def parcel_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per parcel with its township, neighborhood and triad."""
    c = table(spark, sf_dir, "customer")
    # nation x region is a fixed-size dimension (25 rows in every scale factor):
    # joined first and broadcast once, so each use costs one broadcast, not two.
    dims = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    j = c.join(F.broadcast(dims), c.c_nationkey == dims.n_nationkey)
    return j.select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        pin_from_number("c_custkey").alias("pin"),
        F.col("n_nationkey").cast("string").alias("township_code"),
        F.regexp_replace("n_name", "_", " ").alias("township_name"),
        F.when(F.col("c_custkey") % 17 != 5, F.concat(
            F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("-"), F.substring("c_mktsegment", 1, 3))).alias("nbhd_code"),
        F.col("r_name").alias("triad_name"),
        F.concat(F.lit("run-"), F.lower("r_name")).alias("run_id"))


def pin_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pin, year) rows: 1999 for every parcel, 2000 unless the account balance is
    negative, 1998 for the BUILDING segment."""
    b = parcel_base(spark, sf_dir)
    years = F.array_compact(F.array(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("1998")),
        F.lit("1999"),
        F.when(F.col("c_acctbal") >= 0, F.lit("2000"))))
    no_coords = (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 0)
    lon = F.lit(Decimal("-87.95")) + _mod("c_custkey", 997) * F.lit(Decimal("0.00050000123"))
    lat = F.lit(Decimal("41.60")) + _mod("c_custkey", 499) * F.lit(Decimal("0.00100000321"))
    return b.select(
        "pin", F.substring("pin", 1, 10).alias("pin10"), F.explode(years).alias("year"),
        F.when(F.col("c_custkey") % 331 == 3, F.lit(float("nan"))).when(~no_coords, lon.cast("double")).alias("lon"),
        F.when(~no_coords, lat.cast("double")).alias("lat"),
        "township_name", "nbhd_code", "triad_name")


def _years_unless(segment: str) -> Column:
    """1999 and 2000; ten years earlier for the parcels of one segment, whose rows so match no
    current parcel."""
    return F.explode(F.when(F.col("c_mktsegment") == segment, F.array(F.lit("1989"), F.lit("1990")))
                     .otherwise(F.array(F.lit("1999"), F.lit("2000"))))


def pin_condo_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit characteristics for two years of every parcel, old ones for HOUSEHOLD."""
    b = parcel_base(spark, sf_dir)
    k = F.col("c_custkey")
    return b.select(
        "pin", _years_unless("HOUSEHOLD").alias("year"),
        (F.lit(20000) + (_idiv(k, 10) % 50) * 1000).cast("long").alias("building_sf"),
        (F.lit(600) + (k % 37) * 25).cast("long").alias("unit_sf"),
        (k % 4 + 1).cast("long").alias("bedrooms"),
        (k % 3 + 1).cast("long").alias("full_baths"),
        (k % 2).cast("long").alias("half_baths"),
        F.when(k % 10 == 9, F.concat(F.substring("pin", 1, 10), F.lit("0000"))).alias("parking_pin"))


def pin_permit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        pin_from_number("user_id").alias("pin"),
        (F.lit(1995) + F.col("event_id") % 7).cast("string").alias("assessment_year"),
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("permit_number"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_issued"),
        F.concat(F.lit("Work "), F.col("props")).alias("work_description"))


def pin_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = parcel_base(spark, sf_dir)
    k = F.col("c_custkey")
    return b.select(
        "pin", _years_unless("MACHINERY").alias("year"),
        (k % 10 == 9).alias("is_parking_space"),
        F.when(k % 10 == 9, F.lit("deeded parking space")).alias("parking_space_flag_reason"),
        (k % 10 == 0).alias("is_common_area"))


def pin_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        pin_from_number("o_custkey").alias("pin"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.col("o_orderkey").cast("string").alias("doc_no"),
        F.to_date("o_orderdate").alias("sale_date"),
        F.round("o_totalprice", 0).cast("long").alias("sale_price"),
        (F.col("o_orderstatus") == "F").alias("sv_is_outlier"))


def pin_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses for 2000 only, so parcels without a 2000 row get none."""
    b = parcel_base(spark, sf_dir)
    k = F.col("c_custkey")
    street = _pick(k % 5, STREETS)
    return b.select(
        "pin", F.lit("2000").alias("year"),
        F.when(street.isNotNull(), F.concat((F.lit(100) + k % 900).cast("string"), F.lit(" "), street))
        .alias("prop_address_full"),
        _pick(k % 3, CITIES).alias("prop_address_city_name"),
        (F.lit(60600) + k % 50).cast("string").alias("prop_address_zipcode_1"),
        F.when(k % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("U"), (k % 10).cast("string")))
        .alias("prop_address_unit_number"))


def pin_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pin, year) value history: mailed = sum of whole-dollar prices of the year's
    orders, one- and two-year priors = the same sums one and two years before.

    Each order is exploded into the three (year, role) rows it feeds and
    aggregated once -- no self-join over years."""
    o = table(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    roles = F.array(
        F.struct(y.alias("yr"), F.lit("mailed").alias("role")),
        F.struct((y + 1).alias("yr"), F.lit("oneyr").alias("role")),
        F.struct((y + 2).alias("yr"), F.lit("twoyr").alias("role")))
    rows = o.select(pin_from_number("o_custkey").alias("pin"), "o_custkey",
                    F.round("o_totalprice", 0).cast("long").alias("v"), F.inline(roles))

    def total(role: str) -> Column:
        return F.sum(F.when(F.col("role") == role, F.col("v")))

    return rows.groupBy("pin", F.col("yr").cast("string").alias("year"), "o_custkey").agg(
        total("twoyr").alias("twoyr_pri_certified_tot"),
        total("oneyr").alias("oneyr_pri_certified_tot"),
        total("mailed").alias("mailed_tot"),
    ).select(
        "pin", "year", (F.lit(202) + F.col("o_custkey") % 98).cast("string").alias("class"),
        "twoyr_pri_certified_tot", "oneyr_pri_certified_tot", "mailed_tot")



def value_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value-change request sheets: every parcel, keyed by a dressed id (dashes,
    no-break and ideographic spaces, tabs), one sheet per market segment."""
    b = parcel_base(spark, sf_dir)
    k = F.col("c_custkey")
    pretty = pretty_pin("pin", full_length=True)
    dressed = (F.when(k % 4 == 0, pretty)
               .when(k % 4 == 1, F.concat(F.lit(NBSP), pretty, F.lit("\t")))
               .when(k % 4 == 2, F.concat(F.lit(" "), F.col("pin"), F.lit(IDEOGRAPHIC_SPACE)))
               .otherwise(F.col("pin")))
    return b.select(
        dressed.alias("Permanent Index Number"),
        F.col("c_name").alias("Owner Name"),
        F.substring("c_mktsegment", 1, 3).alias("class"),
        F.concat(F.lit("requests_"), F.lower("c_mktsegment"), F.lit(".csv")).alias("source_file"))


def qc_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The QC flag sheet: units with a negative account balance are flagged."""
    b = parcel_base(spark, sf_dir).filter(F.col("c_acctbal") < 0)
    return b.select(pretty_pin("pin", full_length=True).alias("14-Digit PIN"),
                    _pick(F.col("c_custkey") % 3, QC_COMMENTS).alias("Flag Comments"))


def _study_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per customer (ties by order key)."""
    from parcelbeam.operators.attach import newest_per_key

    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return newest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


def final_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One final residential run per region covering its nations' townships."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name").agg(
        F.array_sort(F.collect_list(F.col("n_nationkey").cast("string"))).alias("township_code_coverage")
    ).select(F.concat(F.lit("run-"), F.lower("r_name")).alias("run_id"), F.lit(MODEL_YEAR).alias("year"),
             F.lit(MODEL_TYPE).alias("type"), "township_code_coverage")


def _unsold() -> Column:
    """Parcels whose newest order does not count as a sale."""
    return F.col("o_orderkey") % 5 == 0


def _study_price() -> Column:
    return (F.when(_unsold(), F.lit(None).cast("double"))
            .when(F.col("o_orderkey") % 311 == 0, F.lit(0.0))
            .when(F.col("o_orderkey") % 313 == 0, F.lit(float("nan")))
            .otherwise(F.round("o_totalprice", 0)))


def _model_value() -> Column:
    whole_price = F.round("o_totalprice", 0).cast("long")
    modelled = _idiv(whole_price * (F.lit(80) + F.col("o_orderkey") % 41), 100).cast("double")
    unsold = (F.lit(50000) + (F.col("c_custkey") % 1000) * 150).cast("double")
    return (F.when(F.col("o_orderkey").isNull() | _unsold(), unsold)
            .when(F.col("o_orderkey") % 997 == 0, F.lit(None).cast("double"))
            .otherwise(modelled))


def assessment_pin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-parcel model value of its region's run, with the study sale if any."""
    b = parcel_base(spark, sf_dir)
    s = _study_sale(spark, sf_dir)
    j = b.join(s, b.c_custkey == s.o_custkey, "left")
    return j.select(
        "run_id", "township_code", F.col("pin").alias("meta_pin"),
        _model_value().alias("pred_pin_final_fmv_round"),
        _study_price().alias("sale_ratio_study_price"),
        F.to_date("o_orderdate").alias("sale_ratio_study_date"),
        F.col("o_orderkey").cast("string").alias("sale_ratio_study_document_num"))


def desk_review_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desk-review sheets, one per township file ('<code>-<name>.csv'): every
    parcel with a reviewed value derived from its model value, and some parcels
    again, with another value, on a second sheet."""
    b = parcel_base(spark, sf_dir)
    s = _study_sale(spark, sf_dir)
    j = b.join(s, b.c_custkey == s.o_custkey, "left")
    desk = _idiv(_model_value().cast("long") * (F.lit(90) + F.col("c_custkey") % 21), 100).cast("double")
    again = F.explode(F.when(F.col("c_custkey") % 101 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    j = j.select("*", again.alias("sheet"))
    second = F.col("sheet") == 1
    return j.select(
        F.col("pin").alias("PIN"), F.when(second, desk + 1000).otherwise(desk).alias("Desk Review Value"),
        F.concat("township_code", F.lit("-"), F.regexp_replace("township_name", " ", "_"),
                 F.when(second, F.lit(" again.csv")).otherwise(F.lit(".csv"))).alias("source_file"))


def neighborhood_polygons(parcels: DataFrame) -> DataFrame:
    """Neighborhood outlines as bounding boxes of the parcel coordinates, keyed by
    township and dash-free neighborhood number: WKB and WKT, with their SRID (4326)."""
    box = parcels.filter(F.col("lon").isNotNull() & ~F.isnan("lon") & F.col("lat").isNotNull()).groupBy(
        "township_name", strip_dashes("nbhd_code").alias("town_nbhd")).agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1"))
    ring = wkb.box(*map(F.col, ("x0", "y0", "x1", "y1")))
    points = [F.concat(number_text(x), F.lit(" "), number_text(y)) for x, y in ring]
    return box.select("township_name", "town_nbhd", wkb.polygon_wkb(ring).alias("geometry"),
                      F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *points), F.lit("))")).alias("geometry_wkt"),
                      F.lit(4326).alias("srid"))
