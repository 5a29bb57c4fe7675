"""Per-key roll-ups for the review sheet.

The reference joins sales and permits to units in one statement, so a unit
with s sales and p permits yields s x p rows that are later collapsed.
Here each side is rolled up to one row per parcel *before* it is joined, so
no pairs are ever formed; the literal joined-row count is derived
arithmetically where it is wanted (``joined_row_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.keys import pin10


def join_strings(df: DataFrame, key: Sequence[str] | str, entry: Column, out_col: str,
                 sep: str = ", ", count_col: str | None = None) -> DataFrame:
    """One row per key with its non-NULL entries sorted and joined by ``sep``;
    a key with no entries gets NULL (A1, D3).

    ``collect_list`` aggregates partially on the map side, so each task ships
    one partial list per key instead of every row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    entries = F.array_sort(F.collect_list(entry))
    aggs = [F.nullif(F.concat_ws(sep, entries), F.lit("")).alias(out_col)]
    if count_col:
        aggs.append(F.count(entry).alias(count_col))
    return df.groupBy(*keys).agg(*aggs)


def building_unit_counts(units: DataFrame, key_col: str = "pin") -> DataFrame:
    """Distinct units per building (D1 decision)."""
    return (units.select(pin10(F.col(key_col)).alias("pin10"), key_col)
            .groupBy("pin10").agg(F.countDistinct(key_col).alias("total_number_of_units_in_building")))


def joined_row_counts(unit_years: DataFrame, permit_counts: DataFrame, sale_counts: DataFrame,
                      key_col: str = "pin") -> DataFrame:
    """The reference's literal ``COUNT(*) OVER (PARTITION BY pin10)`` after the
    unit x permit x sale join, computed without forming the join: a unit-year
    row contributes max(permits, 1) * max(sales, 1) rows (D1)."""
    rows = (unit_years.select(key_col)
            .join(permit_counts, key_col, "left").join(sale_counts, key_col, "left")
            .select(pin10(F.col(key_col)).alias("pin10"),
                    (F.greatest(F.coalesce(F.col("n_permits"), F.lit(0)), F.lit(1))
                     * F.greatest(F.coalesce(F.col("n_sales"), F.lit(0)), F.lit(1))).alias("_rows")))
    return rows.groupBy("pin10").agg(F.sum("_rows").cast("long").alias("joined_rows"))
