"""Range rules for the correction columns of a returned review sheet (Q1-Q3).

The sheet's cell validations become a row check: a non-blank entry must be a
whole number inside the column's range.  Violations come back in long form,
one row per (parcel, column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.keys import trim_unicode

# Accepted whole-number range per correction column.
RANGE_RULES: dict[str, tuple[int, int]] = {
    "new_building_sf": (0, 10_000_000),
    "new_unit_sf": (0, 10_000),
    "new_bedrooms": (0, 15),
    "new_full_baths": (0, 15),
    "new_half_baths": (0, 15),
}


def range_violations(df: DataFrame, key_col: str = "pin",
                     rules: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """(key, column, value, reason) for every non-blank entry that is not a whole
    number ('not whole') or lies outside its range ('out of range')."""
    rules = rules or RANGE_RULES
    checks = []
    for col_name, (lo, hi) in rules.items():
        raw = F.col(f"`{col_name}`").cast("string")
        txt = trim_unicode(raw)
        whole = txt.rlike("^[+-]?[0-9]+$")
        number = txt.try_cast("decimal(38,0)")
        reason = (F.when(raw.isNull() | (txt == ""), F.lit(None))
                  .when(~whole, F.lit("not whole"))
                  # more digits than a decimal holds are out of every range
                  .when(number.isNull() | (number < lo) | (number > hi), F.lit("out of range")))
        checks.append(F.struct(F.lit(col_name).alias("column"), raw.alias("value"), reason.alias("reason")))
    return (df.select(key_col, F.inline(F.array(*checks)))
            .filter(F.col("reason").isNotNull()))
