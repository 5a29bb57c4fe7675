"""The three flows, as DataFrame -> DataFrame functions.

* ``value_change_job``  -- requested parcels with prior/current values and a
  large-increase flag, one output per request file.
* ``unit_review_job``   -- unit review sheet of every building with a QC-flagged
  unit, one tab (partition) per township, for all triads at once.
* ``ratio_study_job``   -- per-parcel ratios, decile and township statistics,
  curve and map tables, for all townships at once.

No driver loops over files, triads or townships: each of those is a column,
and the sinks partition by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.keys import clean_pin, pretty_pin
from parcelbeam.functions.names import relocate, rename_all, title_case, title_case_acronyms
from parcelbeam.functions.text import (
    DEFAULT_MAP_URL, address_line, alnum_words, blank_to_null, map_link, permit_entry, sale_entry,
    search_link)
from parcelbeam.operators import ratio as R
from parcelbeam.operators.attach import (
    final_model_values, keep_flagged_groups, most_recent_parcels, nan_to_null, newest_per_key)
from parcelbeam.operators.change import DEFAULT_FACTOR, REQUEST_KEY, value_change
from parcelbeam.operators.reshape import curve_axis, curve_long, neighborhood_map_frame
from parcelbeam.operators.rollup import building_unit_counts, join_strings
from parcelbeam.operators.rules import RANGE_RULES, range_violations
from parcelbeam.session import written

# --------------------------------------------------------------------------
# Job 1: value-change check
# --------------------------------------------------------------------------

def value_change_job(requests: DataFrame, history: DataFrame, mail_year: int,
                     factor: Decimal = DEFAULT_FACTOR, key_col: str = REQUEST_KEY) -> DataFrame:
    """All request rows (with their ``source_file``) plus Class, the two prior
    certified values, the mailed value, the percent change and the flag."""
    return value_change(requests, history, mail_year, factor, key_col)


# --------------------------------------------------------------------------
# Job 2: unit review sheets
# --------------------------------------------------------------------------

def flagged_units(qc: DataFrame, pin_col: str = "14-Digit PIN", comment_col: str = "Flag Comments") -> DataFrame:
    """The QC sheet reduced to (pin, qc_flag); ids lose blanks and dashes."""
    return qc.select(clean_pin(F.col(f"`{pin_col}`")).alias("pin"), F.col(f"`{comment_col}`").alias("qc_flag"))


def sale_documents(sales: DataFrame, min_year: str) -> DataFrame:
    """Per parcel: its outlier sales from ``min_year`` on as one sorted string
    ('[doc, date, $price], ...') and their count (J5, P17, A1)."""
    recent = sales.filter((F.col("year") >= F.lit(min_year)) & F.col("sv_is_outlier"))
    return join_strings(recent, "pin", sale_entry("doc_no", "sale_date", "sale_price"), "sales",
                        count_col="n_sales")


def permit_documents(permits: DataFrame, min_year: str) -> DataFrame:
    """Per parcel: its permits from ``min_year`` on as one sorted string."""
    recent = permits.filter(F.col("assessment_year") >= F.lit(min_year))
    return join_strings(recent, "pin", permit_entry("permit_number", "date_issued", "work_description"),
                        "permits", count_col="n_permits")


def scoped_universe(universe: DataFrame, flagged: DataFrame | None = None,
                    triads: Sequence[str] | None = None) -> DataFrame:
    """Universe rows of the triads asked for (all when None) whose building has a
    flagged unit."""
    uni = universe if triads is None else universe.filter(F.col("triad_name").isin(list(triads)))
    return keep_flagged_groups(uni, flagged) if flagged is not None else uni


def unit_base(universe: DataFrame, chars: DataFrame, flagged: DataFrame | None = None,
              triads: Sequence[str] | None = None) -> DataFrame:
    """Units of the triads with their characteristics, one row per (pin, year)
    (J2).  When ``flagged`` is given, only buildings with a flagged unit are
    kept -- before any join (J7 moved down).

    The review sheet reads them three times (units, keys, building counts), so
    they are written once to the shared folder, by column."""
    return written(scoped_universe(universe, flagged, triads).join(chars, on=["pin", "year"], how="inner"), "units")


def review_units(base: DataFrame, status: DataFrame, addresses: DataFrame) -> DataFrame:
    """Units with status and address, newest year per unit.

    The (pin, year) joins run first, under one hash partitioning; the
    newest-year pick then re-keys by pin once, and every later per-parcel join
    reuses that partitioning."""
    units = base.join(status, on=["pin", "year"], how="left").join(addresses, on=["pin", "year"], how="left")
    return newest_per_key(units, "pin", "year")


def unit_review_rows(universe: DataFrame, chars: DataFrame, permits: DataFrame, status: DataFrame,
                     sales: DataFrame, addresses: DataFrame, qc: DataFrame, min_year: str,
                     triads: Sequence[str] | None = None, map_url: str = DEFAULT_MAP_URL) -> DataFrame:
    """Review rows in the reference's column names (snake case) with the QC flag
    attached (J8; duplicate flags for a unit repeat it, D12), before the sheet
    formatting.

    Sales and permits are the largest inputs and only the reviewed units'
    rows matter, so both are cut to those units by a left-semi join before
    they are rolled up (the key set is broadcast when it is small)."""
    flagged = flagged_units(qc)
    base = unit_base(universe, chars, flagged, triads)
    unit_pins = base.select("pin").distinct()
    units = review_units(base, status, addresses)
    units = (units
             .join(permit_documents(permits.join(unit_pins, "pin", "left_semi"), min_year), "pin", "left")
             .join(sale_documents(sales.join(unit_pins, "pin", "left_semi"), min_year), "pin", "left")
             .join(flagged, "pin", "left"))
    # Units per building from the keys of the base alone, not from the wide
    # joined rows: the count needs no status, address or documents.
    units = units.join(building_unit_counts(base.select("pin", "year")), "pin10", "left")
    address = alnum_words(address_line("prop_address_full", "prop_address_city_name", "prop_address_zipcode_1"))
    rows = units.select(
        "qc_flag",
        map_link("lon", "lat", "pin10", map_url).alias("pin10"),
        "pin", "lon", "lat",
        search_link(address).alias("address"),
        F.col("prop_address_unit_number").alias("unit"),
        "total_number_of_units_in_building",
        "building_sf", F.lit(None).cast("string").alias("new_building_sf"),
        "unit_sf", F.lit(None).cast("string").alias("new_unit_sf"),
        "bedrooms", F.lit(None).cast("string").alias("new_bedrooms"),
        "full_baths", F.lit(None).cast("string").alias("new_full_baths"),
        "half_baths", F.lit(None).cast("string").alias("new_half_baths"),
        F.col("township_name").alias("township"),
        F.col("nbhd_code").alias("neighborhood_code"),
        "parking_pin", "is_parking_space", "parking_space_flag_reason", "is_common_area",
        "sales", "permits", F.col("triad_name").alias("triad"))
    return blank_to_null(rows)


def unit_review_job(universe: DataFrame, chars: DataFrame, permits: DataFrame, status: DataFrame,
                    sales: DataFrame, addresses: DataFrame, qc: DataFrame, min_year: str,
                    triads: Sequence[str] | None = None, map_url: str = DEFAULT_MAP_URL) -> DataFrame:
    """The review sheet: title-cased names ('Pin' -> 'PIN', 'Sf' -> 'SF'), QC flag
    first, permits and sales after the neighborhood code, dashed PIN.  Township
    and Triad stay as the partition columns; rows of a NULL township are
    dropped, as splitting by township drops them (R4, D11)."""
    rows = unit_review_rows(universe, chars, permits, status, sales, addresses, qc, min_year, triads, map_url)
    sheet = rename_all(rows.withColumnRenamed("qc_flag", "QC_Flag"), title_case_acronyms)
    sheet = sheet.withColumnRenamed("Qc Flag", "QC Flag").withColumn("PIN", pretty_pin("PIN", full_length=True))
    sheet = relocate(sheet, first=["QC Flag"], after={"Neighborhood Code": ["Permits", "Sales"]})
    sheet = sheet.filter(F.col("Township").isNotNull()).drop("Lon", "Lat")
    cols = [c for c in sheet.columns if c not in ("Township", "Triad")] + ["Triad", "Township"]
    return sheet.select(*[F.col(f"`{c}`") for c in cols])


def returned_sheet_violations(sheet: DataFrame, key_col: str = "PIN") -> DataFrame:
    """Range rules for a returned review sheet as it was delivered: 'New Bedrooms'
    and the like are matched to the rules in any of the sheet's name forms
    (Q1-Q3); correction columns that the sheet lacks are not checked."""
    plain = {c: c.strip().lower().replace(" ", "_") for c in sheet.columns}
    picked = {p: c for c, p in plain.items() if p in RANGE_RULES}
    rows = sheet.select(F.col(f"`{key_col}`").alias("pin"), *[F.col(f"`{c}`").alias(p) for p, c in picked.items()])
    return range_violations(rows, "pin", {p: RANGE_RULES[p] for p in RANGE_RULES if p in picked})


# --------------------------------------------------------------------------
# Job 3: ratio study
# --------------------------------------------------------------------------

def desk_review_values(sheets: DataFrame, pin_col: str = "PIN", value_col: str = "Desk Review Value") -> DataFrame:
    """Stacked desk-review sheets reduced to (pin, desk_review_value).  Ids are
    cleaned like every other input (D10); a value that is no number is NULL
    here and listed by ``rejected_values``."""
    return sheets.select(clean_pin(F.col(f"`{pin_col}`")).alias("pin"),
                         nan_to_null(F.col(f"`{value_col}`").try_cast("double")).alias("desk_review_value"))


def rejected_values(sheets: DataFrame, pin_col: str = "PIN", value_col: str = "Desk Review Value",
                    source_col: str = "source_file") -> DataFrame:
    """Audit: sheet cells with text that is no number, with their parcel and file."""
    text = F.trim(F.col(f"`{value_col}`").cast("string"))
    return sheets.filter((text != "") & text.try_cast("double").isNull()).select(
        clean_pin(F.col(f"`{pin_col}`")).alias("pin"), F.col(f"`{value_col}`").alias("value"), source_col)


def ratio_parcels(desk_review: DataFrame, universe: DataFrame, models: DataFrame, assessments: DataFrame,
                  model_year: str, model_type: str, universe_years: Sequence[str]) -> DataFrame:
    """Desk-review parcels with township, neighborhood, model value and study sale
    (J9-J12, W1).  The universe and the model values are both cut to the
    reviewed parcels by semi-joins first, so the newest-year window and the
    joins only see requested parcels (the key set is broadcast when small)."""
    reviewed = desk_review.select("pin").distinct()
    scoped = universe.join(reviewed, "pin", "left_semi")
    values = final_model_values(models, assessments, model_year, model_type).join(reviewed, "pin", "left_semi")
    parcels = most_recent_parcels(scoped, universe_years).join(values, "pin", "left")
    return desk_review.join(parcels, "pin", "left")


def study_base(parcels: DataFrame) -> DataFrame:
    """Per parcel of each township: both sale ratios (P15, F16).  Parcels without
    a township fall out, as in the per-township loop (D9).

    The study frame (one row per reviewed parcel) is scanned several times by
    every table built on it, so it is written once to the shared folder, by
    column, instead of re-running the joins above it -- also after an executor
    is lost."""
    return written(R.add_ratios(parcels.filter(F.col("township_name").isNotNull())), "study")


def study_layout(parcels: DataFrame) -> DataFrame:
    """All parcels with their ratios as one ranked layout by township and price:
    price rank, decile and number of sales (W3, W4, A10).  Parcels without a
    township are there too, for the audit; the tables leave them out."""
    return R.rank_by_price(R.add_ratios(parcels))


def all_parcels_sheet(deciled: DataFrame) -> DataFrame:
    """The per-parcel sheet in its delivered column order and title-cased names."""
    cols = ["township_name", "pin", "desk_review_value", "neighborhood_number", "model_value",
            "sale_price", "sale_date", "sale_document_number", "price_decile",
            "model_sale_ratio", "desk_review_sale_ratio"]
    return rename_all(deciled.select(*cols), title_case)


def ratio_study_job(desk_review: DataFrame, universe: DataFrame, models: DataFrame, assessments: DataFrame,
                    polygons: DataFrame | None, model_year: str, model_type: str,
                    universe_years: Sequence[str]) -> dict[str, DataFrame]:
    """All outputs of the ratio study, keyed like the sinks.  Parcels are ranked
    once, in the layout that all of them read.  ``unmatched`` lists
    the reviewed parcels that match no parcel of the universe years: they have
    no township and fall out of every township table (D9 audit)."""
    layout = study_layout(ratio_parcels(desk_review, universe, models, assessments, model_year, model_type, universe_years))
    study = layout.filter(F.col("township_name").isNotNull())
    deciles = R.ratio_deciles(study)
    curve = curve_long(deciles)
    nbhd = R.neighborhood_medians(study)
    out = {
        # Sheets as delivered: title-cased headers ("Model Cod", "Number Of Sales").
        "all_parcels": all_parcels_sheet(study),
        "ratio_deciles": rename_all(deciles, title_case),
        "town_stats": rename_all(R.town_stats(study), title_case),
        "curve": curve,
        "curve_axis": curve_axis(curve),
        "neighborhood_medians": nbhd,
        "unmatched": layout.filter(F.col("township_name").isNull()).select("pin", "desk_review_value"),
    }
    if polygons is not None:
        out["neighborhood_map"] = neighborhood_map_frame(nbhd, polygons)
    return out
