"""Sale-ratio study statistics.

With r = a / p (assessed over sale price), m = median(r), n rows and i the
1-based rank by ascending price (ties by parcel id):

* COD = 100 / m * mean(|r - m|)
* PRD = mean(r) / (sum(a) / sum(p))
* PRB = OLS slope of (r - m) / m on log2((a / m + p) / 2)
* G(x) = (2 * sum(i * x) / sum(x) - (n + 1)) / n;  MKI = G(a) / G(p)

Strict statistics (the ratio tables) are NULL when any input ratio in the
group is NULL; the lenient median (the neighborhood map) skips NULLs.
Every division goes through ``try_divide`` so a zero median or G(p) = 0 gives
NULL instead of an error; a zero price gives an infinite ratio, and only the
statistics that it makes infinite are NULL.

No statistic needs a group in one task.  Medians and decile cuts come from
histogram selection (``selection``: counts per value range, no shuffle of
rows), COD, PRD, PRB and MKI from partial aggregates beside the broadcast
medians, and MKI's price rank from the ranked layout (``ranking``), so a
township holding a third of all sales is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.text import price_range
from parcelbeam.operators.attach import join_null_safe, join_small, sized
from parcelbeam.operators.ranking import group_row_number, ntile_from_rank, ranked_layout, total_order
from parcelbeam.operators.selection import cut_ranks, mean_pick, median_ranks, select_ranks

# The two stages compared in the study, their value columns,
# display labels and order (Model first).
STAGES: dict[str, str] = {"model": "model_value", "desk_review": "desk_review_value"}
STAGE_LABELS: dict[str, str] = {"model": "Model", "desk_review": "Desk Review"}
STAGE_ORDER: dict[str, int] = {"model": 1, "desk_review": 2}

ROUND_DIGITS = 6


def ratio_col(stage: str) -> str:
    return f"{stage}_sale_ratio"


def add_ratios(df: DataFrame, stages: Mapping[str, str] = STAGES, price: str = "sale_price") -> DataFrame:
    """``<stage>_sale_ratio = value / price``; NULL for a NULL value or price.  A zero price
    makes the ratio infinite (NULL if the value is zero too): it ranks last and leaves the
    median of the others finite."""
    def ratio(value: Column) -> Column:
        infinite = F.when(value > 0, F.lit(float("inf"))).when(value < 0, F.lit(float("-inf")))
        return F.when(F.col(price) == 0, infinite).otherwise(F.try_divide(value.cast("double"), F.col(price)))
    return df.withColumns({ratio_col(s): ratio(F.col(v)) for s, v in stages.items()})


def finite(c: Column) -> Column:
    """NULL instead of an infinite or undefined statistic."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def price_order(df: DataFrame, group_cols: Sequence[str], price: str, tiebreak: str) -> list[Column | str]:
    """Ascending price, NULLs last; ties by parcel, then by all other columns."""
    return [F.col(price).asc_nulls_last(), *total_order(df.drop(*group_cols, price), [tiebreak])]


def rank_by_price(df: DataFrame, group_cols: Sequence[str] = ("township_name",), price: str = "sale_price",
                  tiebreak: str = "pin", buckets: int = 10, decile_col: str = "price_decile",
                  rank_col: str = "price_rank", size_col: str = "number_of_sales") -> DataFrame:
    """The rows as one ranked layout by (group, price) with the price rank, the
    number of prices and the NTILE bucket; rows without a price keep NULLs and
    are not counted (W3, W4).  Every output of a study reads this one table."""
    ranked = ranked_layout(df, group_cols, price_order(df, group_cols, price, tiebreak),
                           "_price_pos", "_group_rows", count_of=price, count_col="_priced")
    priced = F.col(price).isNotNull()
    return (ranked
            .withColumn(rank_col, F.when(priced, F.col("_price_pos")))
            .withColumn(size_col, F.when(priced, F.col("_priced")))
            .withColumn(decile_col, ntile_from_rank(rank_col, size_col, buckets))
            .drop("_price_pos", "_group_rows", "_priced"))


def add_price_deciles(df: DataFrame, group_cols: Sequence[str] = ("township_name",),
                      price: str = "sale_price", tiebreak: str = "pin", buckets: int = 10,
                      decile_col: str = "price_decile", size_col: str = "number_of_sales") -> DataFrame:
    """NTILE(buckets) of price inside each group without ranking its rows; rows
    without a price keep NULL and are not counted (W3).

    The last rank of each bucket is found by histogram selection; a row's bucket
    is then one more than the number of cuts below it.  Only rows whose price
    equals a cut that falls between equal prices need their place among those:
    they alone are ranked (``group_row_number``).  ``df`` is scanned several
    times, so it should be materialised."""
    keys = list(group_cols)
    cuts = select_ranks(df, keys, price, cut_ranks(buckets)).select(
        *keys, F.col("n_values").alias("_priced"), F.col("picks").alias("_cuts"))
    within = lambda c: c["rank"] - c["below"]  # noqa: E731 -- place of the cut among equal prices
    # equal prices on both sides of a cut, at most
    torn_ties = F.transform("_cuts", lambda c: F.when(within(c) < c["ties"], c["ties"]).otherwise(F.lit(0)))
    groups, torn = cuts.agg(F.count(F.lit(1)), F.coalesce(F.max(F.array_max(torn_ties)), F.lit(0))).first()
    rows = join_null_safe(df, sized(cuts, groups), keys, "left")
    p, place = F.col(price).cast("double"), "_place"
    if torn:
        here = F.exists("_cuts", lambda c: (p == c["value"]) & (within(c) < c["ties"]))
        tied = rows.filter(here)
        order = total_order(df.drop(*keys, price), [tiebreak])
        ranked = group_row_number(tied, [*keys, price], order, place, "_tied", known_max_group_rows=torn).drop("_tied")
        rows = rows.filter(~F.coalesce(here, F.lit(False))).withColumn(place, F.lit(None).cast("long")).unionByName(ranked)
    else:
        rows = rows.withColumn(place, F.lit(None).cast("long"))
    above = F.size(F.filter("_cuts", lambda c: (p > c["value"]) | ((p == c["value"]) & (F.col(place) > within(c)))))
    priced = F.col(price).isNotNull()
    return (rows.withColumn(size_col, F.when(priced, F.col("_priced")))
            .withColumn(decile_col, F.when(priced, F.coalesce(above, F.lit(0)) + 1).cast("int"))
            .drop("_priced", "_cuts", place))


def stage_long(df: DataFrame, keep: Sequence[str], stages: Mapping[str, str] = STAGES) -> DataFrame:
    """One row per (parcel, stage) with ``stage``, ``assessed`` and ``ratio``."""
    rows = F.array(*[
        F.struct(F.lit(s).alias("stage"), F.col(v).cast("double").alias("assessed"),
                 F.col(ratio_col(s)).alias("ratio"))
        for s, v in stages.items()])
    return df.select(*keep, F.inline(rows))


def medians(long: DataFrame, group_cols: Sequence[str], value: str = "ratio", strict: bool = True,
            price: str | None = None) -> DataFrame:
    """Exact median of ``value`` per group by histogram selection, plus row counts.

    Returns ``group_cols + [n_rows, n_values, median]`` (and, with ``price``,
    ``min_price``, ``max_price``).  With ``strict`` the median is NULL when the
    group has a NULL value (R's default ``median``)."""
    extra = [F.min(price).alias("min_price"), F.max(price).alias("max_price")] if price else []
    found = select_ranks(long, group_cols, value, median_ranks, extra)
    usable = (F.col("n_values") == F.col("n_rows")) if strict else F.lit(True)
    return found.withColumn("median", F.when(usable, finite(mean_pick()))).drop("picks")


def mean_deviation(median: str = "median", value: str = "ratio") -> Column:
    """Aggregate: COD's mean distance from the median, of rows that carry it."""
    return F.avg(F.abs(F.col(value) - F.col(median)))


def dispersion(deviation: Column, median: Column) -> Column:
    """COD from the mean distance and the median; NULL where either is not finite."""
    return finite(F.try_divide(F.lit(100.0) * deviation, median))


def median_stats(long: DataFrame, group_cols: Sequence[str], value: str = "ratio", strict: bool = True,
                 price: str | None = None) -> DataFrame:
    """``medians`` with the COD beside the median (A2, A4): one more partial
    aggregate over the rows, the medians joined to them after a size check."""
    keys = list(group_cols)
    found = medians(long, keys, value, strict, price)
    beside = join_small(long.select(*keys, value), found.select(*keys, "median"), keys, null_safe=True, materialised=True)
    apart = beside.groupBy(*keys).agg(mean_deviation(value=value).alias("_apart"))
    out = join_null_safe(found, apart, keys, "left")
    return out.withColumn("cod", dispersion(F.col("_apart"), F.col("median"))).drop("_apart")


def vertical_equity(long: DataFrame, medians: DataFrame, group_cols: Sequence[str],
                    price: str = "sale_price", rank_col: str = "price_rank") -> DataFrame:
    """COD, PRD, PRB and MKI per group (strict), carrying the columns of
    ``medians`` (a materialised table) through.  It has one row per group (stages x
    townships) and is joined to the rows by ``join_small``, broadcast after a size check, so all
    four come from one partial aggregate."""
    group_cols = list(group_cols)
    carried = [c for c in medians.columns if c not in group_cols]
    m_tab = medians.withColumn("_m", F.col("median"))
    j = join_small(long, m_tab, group_cols, null_safe=True, materialised=True)
    a, p, r, m, i = F.col("assessed"), F.col(price).cast("double"), F.col("ratio"), F.col("_m"), F.col(rank_col)
    y = F.try_divide(r - m, m)
    x = F.log2(F.lit(0.5) * (F.try_divide(a, m) + p))
    agg = j.groupBy(*group_cols).agg(
        *[F.first(c).alias(c) for c in carried],
        F.count(F.lit(1)).alias("_n"),
        F.avg(r).alias("_mean_r"), F.sum(a).alias("_sa"), F.sum(p).alias("_sp"),
        F.regr_slope(y, x).alias("_prb"),
        mean_deviation("_m").alias("_apart"),
        F.sum(i * a).alias("_ia"), F.sum(i * p).alias("_ip"))
    n = F.col("_n").cast("double")

    def gini(weighted: Column, total: Column) -> Column:
        return F.try_divide(F.try_divide(F.lit(2.0) * weighted, total) - (n + 1), n)

    usable = F.col("n_values") == F.col("n_rows")
    prd = F.try_divide(F.col("_mean_r"), F.try_divide(F.col("_sa"), F.col("_sp")))
    mki = F.try_divide(gini(F.col("_ia"), F.col("_sa")), gini(F.col("_ip"), F.col("_sp")))
    return agg.select(
        *group_cols, *carried,
        dispersion(F.col("_apart"), F.col("median")).alias("cod"),
        F.when(usable, finite(prd)).alias("prd"),
        F.when(usable, finite(F.col("_prb"))).alias("prb"),
        F.when(usable, finite(mki)).alias("mki"))


def _wide(stats: DataFrame, key_cols: Sequence[str], measures: Sequence[str],
          stages: Sequence[str]) -> DataFrame:
    """(key, stage, measures) -> key + '<stage>_<measure>' columns (rounded), plus
    the stage-independent price range and number of sales."""
    cols = []
    for s in stages:
        for mname in measures:
            label = "ratio" if mname == "median" else mname
            cols.append(F.round(F.max(F.when(F.col("stage") == s, F.col(mname))), ROUND_DIGITS)
                        .alias(f"{s}_{label}"))
    cols += [price_range(F.min("min_price"), F.max("max_price")).alias("price_range"),
             F.max("n_rows").alias("number_of_sales")]
    return stats.groupBy(*key_cols).agg(*cols)


def ratio_deciles(deciled: DataFrame, group_cols: Sequence[str] = ("township_name",),
                  stages: Mapping[str, str] = STAGES, price: str = "sale_price") -> DataFrame:
    """Per (group, price decile): strict median ratio and COD per stage, price
    range label and number of sales (A10, A2, A4, A8, A9)."""
    keys = [*group_cols, "price_decile"]
    priced = deciled.filter(F.col(price).isNotNull())
    long = stage_long(priced, [*keys, price], stages)
    stats = median_stats(long, ["stage", *keys], price=price)
    out = _wide(stats, keys, ["median", "cod"], list(stages))
    order = [*keys] + [f"{s}_{m}" for s in stages for m in ("ratio", "cod")] + ["price_range", "number_of_sales"]
    return out.select(*order)


def town_stats(deciled: DataFrame, group_cols: Sequence[str] = ("township_name",),
               stages: Mapping[str, str] = STAGES, price: str = "sale_price") -> DataFrame:
    """Per group, over rows with their price rank: strict median ratio, COD, PRD, PRB, MKI per stage, price range
    and number of sales (A11, A2, A4-A9)."""
    keys = list(group_cols)
    priced = deciled.filter(F.col(price).isNotNull())
    long = stage_long(priced, [*keys, price, "price_rank"], stages)
    stats = vertical_equity(long, medians(long, ["stage", *keys], price=price), ["stage", *keys], price=price)
    out = _wide(stats, keys, ["median", "cod", "prd", "prb", "mki"], list(stages))
    order = keys + [f"{s}_{m}" for s in stages for m in ("ratio", "cod", "prd", "prb", "mki")] + [
        "price_range", "number_of_sales"]
    return out.select(*order)


def neighborhood_medians(parcels: DataFrame, group_cols: Sequence[str] = ("township_name", "neighborhood_number"),
                         stages: Mapping[str, str] = STAGES) -> DataFrame:
    """Lenient (NULL-skipping) median ratio per neighborhood and stage, over all
    parcels of the township, sold or not (A3, A12).  Long form with stage label
    and order (R3, R8)."""
    keys = list(group_cols)
    stats = medians(stage_long(parcels, keys, stages), ["stage", *keys], strict=False)
    label = F.create_map(*[x for s in stages for x in (F.lit(s), F.lit(STAGE_LABELS.get(s, s)))])
    order = F.create_map(*[x for s in stages for x in (F.lit(s), F.lit(STAGE_ORDER.get(s, 99)))])
    return stats.select(
        *keys, label[F.col("stage")].alias("stage"), order[F.col("stage")].alias("stage_order"),
        F.round("median", ROUND_DIGITS).alias("median_sale_ratio"))


def strict_and_lenient(parcels: DataFrame, group_cols: Sequence[str] = ("township_name",),
                       stages: Mapping[str, str] = STAGES, price: str = "sale_price") -> DataFrame:
    """Both median rules side by side per group and stage (D6): strict over the
    sold parcels (as in the tables), lenient over all parcels (as in the map)."""
    keys = list(group_cols)
    long_all = stage_long(parcels, [*keys, price], stages)
    strict = medians(long_all.filter(F.col(price).isNotNull()), ["stage", *keys])
    lenient = medians(long_all, ["stage", *keys], strict=False)
    # Every group with a sale also has parcels, so the lenient side is complete.
    return lenient.select("stage", *keys, F.round("median", ROUND_DIGITS).alias("lenient_median"),
                          F.col("n_rows").alias("n_parcels"), F.col("n_values").alias("n_ratios")).join(
        strict.select("stage", *keys, F.round("median", ROUND_DIGITS).alias("strict_median"),
                      F.col("n_rows").alias("n_sales")),
        on=["stage", *keys], how="left")
