"""Long forms and chart/map tables of the ratio study.

The reference draws a ratio curve and a neighborhood map; what is built here
is the data behind them: the long table with labels and band flag, the axis
bounds and breaks, and the neighborhood frame with its polygon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.keys import strip_dashes

# The reference band around a ratio of 1 and the minimum axis
# range of the curve.
BAND_LOW, BAND_MID, BAND_HIGH = 0.9, 1.0, 1.1
AXIS_MIN, AXIS_MAX = 0.7, 1.3
CURVE_STAGES = {"model_ratio": "Model Ratio", "desk_review_ratio": "Desk Review Ratio"}


def curve_long(deciles: DataFrame, key_cols: tuple[str, ...] = ("township_name",)) -> DataFrame:
    """Decile ratios wide -> long (stage, sale_ratio); NULL ratios are kept.
    Adds the 2-digit label and whether the ratio lies in the 0.9-1.1 band."""
    src = deciles.select(*key_cols, "price_decile",
                         *[F.col(c).alias(lbl) for c, lbl in CURVE_STAGES.items()])
    long = src.unpivot([*key_cols, "price_decile"], list(CURVE_STAGES.values()), "stage", "sale_ratio")
    r = F.col("sale_ratio")
    return long.select(*key_cols, "price_decile", "stage", "sale_ratio",
                       # via a decimal so the 2-digit label is half-up on the printed value
                       F.round(r.cast("decimal(20,6)"), 2).cast("double").alias("label"),
                       r.between(F.lit(BAND_LOW), F.lit(BAND_HIGH)).alias("in_band"))


def curve_axis(curve: DataFrame, key_cols: tuple[str, ...] = ("township_name",)) -> DataFrame:
    """Axis bounds (min/max over the ratios and the fixed limits, NULLs skipped)
    and one row per 0.1 axis break from floor(min) to ceil(max) (A15, F23)."""
    bounds = curve.groupBy(*key_cols).agg(
        F.least(F.min("sale_ratio"), F.lit(AXIS_MIN)).alias("y_min"),
        F.greatest(F.max("sale_ratio"), F.lit(AXIS_MAX)).alias("y_max"))
    tenths = F.sequence(F.floor(F.col("y_min") * 10).cast("int"), F.ceil(F.col("y_max") * 10).cast("int"))
    return bounds.select(*key_cols, "y_min", "y_max", F.explode(tenths).alias("_tenth")).select(
        *key_cols, "y_min", "y_max", (F.col("_tenth") / F.lit(10.0)).alias("axis_break"))


def neighborhood_map_frame(nbhd_long: DataFrame, polygons: DataFrame) -> DataFrame:
    """Median ratios per neighborhood and stage with the neighborhood's outline
    attached; neighborhoods without one keep NULLs (J13, D21).  Join keys have
    different names on each side.  Whatever else the outline table has is
    carried as it is: a ``geometry`` column of WKB bytes, WKT text, an SRID."""
    geometry = [c for c in polygons.columns if c not in ("township_name", "town_nbhd")]
    left = nbhd_long.withColumn("neighborhood_number", strip_dashes("neighborhood_number"))
    cond = ((left["township_name"] == polygons["township_name"])
            & (left["neighborhood_number"] == polygons["town_nbhd"]))
    return left.join(polygons, cond, "left").select(
        left["township_name"], left["neighborhood_number"], "stage", "stage_order",
        "median_sale_ratio", *[polygons[c] for c in geometry])
