"""String building for the review sheets and ratio tables.

Every helper is a Column expression.  NULL handling follows the SQL the
jobs reproduce: ``concat_ws`` skips NULL parts, ``concat`` propagates them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelbeam.functions.keys import _col, pretty_pin

# Spreadsheet formula text around the search link, and the
# state suffix appended to the city.
HYPERLINK_OPEN = '=HYPERLINK("'
HYPERLINK_MID = '", "'
HYPERLINK_CLOSE = '")'
SEARCH_URL = "https://www.google.com/search?q="
STATE_SUFFIX = ", IL"

# The map viewer address is site specific; callers pass their own.  The
# default keeps the link shape (zoom/lon/lat/rotation, then the building id).
DEFAULT_MAP_URL = "https://maps.example.org/?map=19.00/"


def address_line(full: Column | str, city: Column | str, zipcode: Column | str) -> Column:
    """'<full> <city>, IL <zip>' with NULL parts skipped; all parts NULL gives ''."""
    return F.concat_ws(" ", _col(full), F.concat(_col(city), F.lit(STATE_SUFFIX)), _col(zipcode))


def alnum_words(c: Column | str) -> Column:
    """Replace every character that is not a Unicode letter or digit by a blank."""
    return F.regexp_replace(_col(c), "(?U)[^\\p{Alnum}]", " ")


def search_link(address: Column | str) -> Column:
    a = _col(address)
    return F.concat(F.lit(HYPERLINK_OPEN + SEARCH_URL), a, F.lit(HYPERLINK_MID), a, F.lit(HYPERLINK_CLOSE))


def number_text(c: Column | str) -> Column:
    """Plain decimal text of a number with all its digits, without trailing zeros
    or an exponent: -87.62345678912 -> '-87.62345678912', 41.0 -> '41'; NULL
    prints 'NA'.
    """
    txt = _col(c).cast("string").try_cast(T.DecimalType(38, 18)).cast("string")
    txt = F.regexp_replace(txt, "\\.?0+$", "")
    return F.coalesce(txt, F.lit("NA"))


def map_link(lon: Column | str, lat: Column | str, building: Column | str,
             base_url: str = DEFAULT_MAP_URL) -> Column:
    b = _col(building)
    return F.concat(
        F.lit(HYPERLINK_OPEN + base_url), number_text(lon), F.lit("/"), number_text(lat),
        F.lit("/0&pin10="), b, F.lit(HYPERLINK_MID), pretty_pin(b), F.lit(HYPERLINK_CLOSE))


def thousands(c: Column | str) -> Column:
    """Whole number with thousands separators; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%,d", c.cast("long")))


def dollar(c: Column | str) -> Column:
    """Whole-dollar label: 1234.4 -> '$1,234', -5 -> '-$5'."""
    r = F.round(_col(c), 0)
    return F.when(r < 0, F.concat(F.lit("-$"), thousands(-r))).otherwise(F.concat(F.lit("$"), thousands(r)))


def price_range(lo: Column | str, hi: Column | str) -> Column:
    return F.concat(dollar(lo), F.lit("-"), dollar(hi))


def sale_entry(doc: Column | str, sale_date: Column | str, price: Column | str) -> Column:
    """'[doc, yyyy-mm-dd, $1,234]' when the document exists; NULL if any part is NULL."""
    d = _col(doc)
    return F.when(d.isNotNull(), F.concat(
        F.lit("["), d, F.lit(", "), F.date_format(_col(sale_date), "yyyy-MM-dd"),
        F.lit(", $"), thousands(price), F.lit("]")))


def permit_entry(number: Column | str, issued: Column | str, description: Column | str) -> Column:
    """'[number, first 10 chars of issue date, description]' when the permit exists."""
    n = _col(number)
    return F.when(n.isNotNull(), F.concat(
        F.lit("["), n, F.lit(", "), F.substring(_col(issued), 1, 10), F.lit(", "),
        _col(description), F.lit("]")))


def blank_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``nullif(c, '')`` on every string column (or the given ones)."""
    targets = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in targets})


def file_label(c: Column | str) -> Column:
    """Blanks to underscores, as used in output names."""
    return F.regexp_replace(_col(c), " ", "_")
