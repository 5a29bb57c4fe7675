"""Attaching rows to parcels: newest row per key, coverage expansion, filtered
left joins and flagged-group semi-joins (J1-J13, W1, O3, P11-P14, P18, P19).

Join strategy is left to Catalyst and AQE: relations under
``spark.sql.autoBroadcastJoinThreshold`` (estimated statically, measured at
runtime by AQE) are broadcast, larger ones are shuffled on the key.  Hints
are only used where the size bound is structural.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelbeam.functions.keys import pin10
from parcelbeam.session import written

MAX_BROADCAST_ROWS_CONF = "parcelbeam.broadcast.maxRows"
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def broadcast_limit(spark: SparkSession) -> int:
    """Most rows of a derived table that is broadcast (``parcelbeam.broadcast.maxRows``)."""
    conf = spark.conf.get(MAX_BROADCAST_ROWS_CONF, None)
    return int(conf) if conf is not None else DEFAULT_MAX_BROADCAST_ROWS


def sized(small: DataFrame, rows: int, max_rows: int | None = None) -> DataFrame:
    """``small``, of at most ``rows`` rows by count, marked for broadcast up to ``max_rows``
    (``broadcast_limit`` by default); beyond that joins with it are shuffle joins, with AQE's
    skew splitting."""
    limit = broadcast_limit(small.sparkSession) if max_rows is None else max_rows
    return F.broadcast(small) if rows <= limit else small


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL keys meet NULL keys, as they do in a grouping."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in on], F.lit(True))
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in on])


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
               max_rows: int | None = None, null_safe: bool = False, materialised: bool = False) -> DataFrame:
    """Join a derived table that is usually small (medians per group, rank
    offsets) onto ``big``.  It is broadcast only after it has been counted --
    the count is the proof of its size (see ``sized``).  ``small`` is written to
    the shared folder first, unless it is ``materialised`` already, so the count
    and the join read one table that outlives its executors."""
    small = small if materialised else written(small, "small")
    side = sized(small, small.count(), max_rows)
    if not null_safe:
        return big.join(side, on=on, how=how)
    return join_null_safe(big, side, [on] if isinstance(on, str) else on, how)


def newest_per_key(df: DataFrame, key: Sequence[str] | str, by: Sequence[str] | str) -> DataFrame:
    """The row of each key that is highest by ``by``, and by all other columns
    (in name order) where rows tie (W1, O3, A13).

    The maximum of a struct: a mergeable aggregate, so each map task sends one row
    per key whatever the key's size, and the pick depends on the rows alone, not
    on their order.  NULLs are lowest.  Columns without an order (maps) may not
    occur."""
    keys = [key] if isinstance(key, str) else list(key)
    by = [by] if isinstance(by, str) else list(by)
    rest = sorted(c for c in df.columns if c not in keys and c not in by)
    whole = F.max(F.struct(*[F.col(f"`{c}`") for c in [*by, *rest]])).alias("_newest")
    found = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(whole)
    return found.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_newest.`{c}`") for c in df.columns])


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(c.cast("double")), c)


def explode_coverage(models: DataFrame, array_col: str, out_col: str,
                     keep: Sequence[str] = ("run_id",)) -> DataFrame:
    """``CROSS JOIN UNNEST(arr)``: one row per array element; a NULL or empty
    array yields no row (J9)."""
    return models.select(*keep, F.explode(F.col(array_col)).alias(out_col))


def final_model_values(models: DataFrame, assessments: DataFrame, year: str, model_type: str) -> DataFrame:
    """Model values of the final runs for (year, type): runs exploded to the
    townships they cover, then joined to per-parcel values on (run, township)
    (R7, P11, P14, J9, J10)."""
    runs = explode_coverage(
        models.filter((F.col("year") == F.lit(year)) & (F.col("type") == F.lit(model_type))),
        "township_code_coverage", "township_code")
    vals = join_small(assessments, runs, ["run_id", "township_code"])
    return vals.select(
        F.col("meta_pin").alias("pin"),
        nan_to_null(F.col("pred_pin_final_fmv_round")).alias("model_value"),
        nan_to_null(F.col("sale_ratio_study_price")).alias("sale_price"),
        F.col("sale_ratio_study_date").alias("sale_date"),
        F.col("sale_ratio_study_document_num").alias("sale_document_number"))


def most_recent_parcels(universe: DataFrame, years: Sequence[str]) -> DataFrame:
    """One row per parcel: the newest of the listed years."""
    scoped = universe.filter(F.col("year").isin(list(years))).select(
        "pin", "year", "township_name", F.col("nbhd_code").alias("neighborhood_number"))
    return newest_per_key(scoped, "pin", "year")


def left_join_where(left: DataFrame, right: DataFrame, on: Sequence[str] | str,
                    right_condition: Column | None = None) -> DataFrame:
    """``LEFT JOIN right ON keys AND <predicate on right only>``.

    The predicate restricts the right side before the join; moving it to a
    WHERE clause would drop unmatched left rows (J3, J5, P18).
    """
    if right_condition is not None:
        right = right.filter(right_condition)
    return left.join(right, on=on, how="left")


def keep_flagged_groups(df: DataFrame, flagged_keys: DataFrame, key_col: str = "pin",
                        flag_key_col: str = "pin") -> DataFrame:
    """Keep rows whose building (first 10 characters of the key) has a flagged
    unit (J7).  A left-semi join: each row is kept at most once however many
    flags its building has."""
    buildings = flagged_keys.select(pin10(F.col(flag_key_col)).alias("_flag_pin10")).distinct()
    return df.join(buildings, pin10(F.col(key_col)) == F.col("_flag_pin10"), "left_semi")
