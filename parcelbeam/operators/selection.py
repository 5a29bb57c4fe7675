"""Exact order statistics per group by histogram selection.

The value at a rank is found without sorting or shuffling rows.  Each wanted rank starts with the
range from its group's smallest to its largest value.  A round counts the values of every range into
``buckets`` equal parts (added up per task before the shuffle), and each rank goes on with the part
that holds it, narrowed to the smallest and largest value there.  Both ends of a range always fall
into different parts, so every round shrinks it.  Once a range holds at most ``most`` values, these
are gathered, sorted and picked from; a range whose ends are equal is done without that.

What travels between rounds is one row per group and wanted rank, written to the shared folder.
Rows are only scanned, so a group that holds a third of them is spread like any other, and no group
is too large for it.  Where no group has more than ``most`` values there is nothing to narrow, and
one pass gathers and picks.

NULL and NaN count as missing.  Infinite values are ordinary ones at the ends.  NULL group keys form
a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelbeam.operators.attach import join_null_safe, nan_to_null, sized
from parcelbeam.session import written

MOST = 10_000
BUCKETS = 2048
NEAR = 1024.0


def _inf(sign: int = 1) -> Column:
    return F.lit(sign * float("inf"))


def _finite(v: Column) -> Column:
    return F.when(F.abs(v) != _inf(), v)


def _scale(v: Column) -> Column:
    """An order-preserving scale that spreads orders of magnitude evenly: the sign times the binary
    logarithm, moved so that it is positive for all doubles."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1080))


def _bucket(v: Column, low: Column, high: Column, buckets: int) -> Column:
    """Part of [low, high] (finite ends) that a value lies in; infinite values lie beyond the parts.

    Parts are equal in width where the ends are within a factor of ``NEAR`` of each other, else
    equal in orders of magnitude.  Rounding keeps the order of values, so a part holds neighbouring
    values either way, and few rounds narrow any range."""
    small, large = F.least(F.abs(low), F.abs(high)), F.greatest(F.abs(low), F.abs(high))
    near = (F.signum(low) == F.signum(high)) & (large <= small * NEAR)
    share = F.when(near, F.try_divide(v - low, high - low)).otherwise(
        F.try_divide(_scale(v) - _scale(low), _scale(high) - _scale(low)))
    part = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1)).cast("int")
    return F.when(v == _inf(), buckets).when(v == _inf(-1), -1).otherwise(part)


def select_ranks(df: DataFrame, group_cols: Sequence[str], value: str, ranks: Callable[[Column], Column],
                 extra: Sequence[Column] = (), most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """Per group: ``group_cols``, n_rows, n_values, the ``extra`` aggregates and ``picks``, an array
    of (rank, value, below, ties) by rank: the value at each rank of ``ranks(n_values)`` (an array
    of 1-based ranks), how many values are smaller, and how many are equal.

    ``df`` is scanned once for the sizes, once for the bounds if a group is larger than ``most``,
    once per round and once for the picks."""
    keys = list(group_cols)
    rows = df.withColumn("_v", nan_to_null(F.col(value)).cast("double"))
    v = F.col("_v")
    largest = rows.groupBy(*keys).agg(F.count("_v").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:  # every range is gathered as it is: one pass
        return written(_gathered(rows, keys, ranks, extra), "picks")
    summary = written(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_v").alias("n_values"), *extra,
        F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        F.min(_finite(v)).alias("_from"), F.max(_finite(v)).alias("_to")), "ranges")
    wanted = summary.filter("n_values > 0").select(
        *keys, F.explode(ranks(F.col("n_values"))).alias("_rank"), F.lit(0).cast("long").alias("_before"),
        F.col("n_values").alias("_size"), "_low", "_high", "_from", "_to")
    values = rows.filter("_v IS NOT NULL").select(*keys, "_v")
    open_range = (F.col("_size") > most) & (F.col("_low") < F.col("_high"))
    while True:
        n, going = wanted.agg(F.count(F.lit(1)), F.count_if(open_range)).first()
        if not going:
            break
        wanted = written(_narrowed(wanted, open_range, n, values, keys, buckets), "ranges")
    picks = _picked(wanted, n, values, keys)
    kept = summary.drop("_low", "_high", "_from", "_to")
    return written(join_null_safe(kept, picks, keys, "left"), "picks")


def _gathered(rows: DataFrame, keys: Sequence[str], ranks: Callable[[Column], Column], extra: Sequence[Column]) -> DataFrame:
    """The result where no group has more values than may be gathered."""
    sorted_ = F.col("_sorted")

    def pick(rank: Column) -> Column:
        at = F.get(sorted_, (rank - 1).cast("int"))
        return F.struct(rank.cast("long").alias("rank"), at.alias("value"), (F.array_position(sorted_, at) - 1).alias("below"),
                        F.size(F.filter(sorted_, lambda x: x == at)).cast("long").alias("ties"))
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count("_v").alias("n_values"), *extra,
                                    F.sort_array(F.collect_list("_v")).alias("_sorted"))
    picks = F.transform(F.when(F.col("n_values") > 0, ranks(F.col("n_values"))), pick)
    return found.withColumn("picks", F.when(F.size(picks) > 0, picks)).drop("_sorted")


def _inside(values: DataFrame, ranges: DataFrame, rows: int, keys: Sequence[str]) -> DataFrame:
    """Each value with the range of its group that it lies in; ranges of a group do not overlap."""
    return join_null_safe(values, sized(ranges, rows), keys).filter(F.col("_v").between(F.col("_low"), F.col("_high")))


def _narrowed(wanted: DataFrame, open_range: Column, rows: int, values: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    going = wanted.filter(open_range)
    ranges = going.select(*keys, "_low", "_high", "_from", "_to").distinct()
    counted = (_inside(values, ranges, rows, keys)
               .withColumn("_part", _bucket(F.col("_v"), F.col("_from"), F.col("_to"), buckets))
               .groupBy(*keys, "_low", "_part")
               .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_largest")))
    # at most buckets + 2 rows a range
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_low").orderBy("_part"))
    parts = counted.select(*keys, "_low", "_n", "_least", "_largest", upto.alias("_upto"))
    # within the range, ranks up to _upto lie in this part or an earlier one
    rank = F.col("_rank") - F.col("_before")
    met = join_null_safe(going.select(*keys, "_low", "_rank", "_before"), parts, [*keys, "_low"]).filter(
        rank.between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    onward = met.select(*keys, "_rank", (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_before"),
                        F.col("_n").alias("_size"), F.col("_least").alias("_low"), F.col("_largest").alias("_high"),
                        _finite(F.col("_least")).alias("_from"), _finite(F.col("_largest")).alias("_to"))
    return wanted.filter(~open_range).unionByName(onward)


def _picked(wanted: DataFrame, rows: int, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The array of picks of each group."""
    many = F.col("_low") < F.col("_high")
    ranges = wanted.filter(many).select(*keys, "_low", "_high").distinct()
    gathered = _inside(values, ranges, rows, keys).groupBy(*keys, "_low").agg(
        F.sort_array(F.collect_list("_v")).alias("_sorted"))
    found = join_null_safe(wanted.filter(many), gathered, [*keys, "_low"])
    at = F.get("_sorted", (F.col("_rank") - F.col("_before") - 1).cast("int"))
    pick = F.struct(F.col("_rank").cast("long").alias("rank"), at.alias("value"),
                    (F.col("_before") + F.array_position("_sorted", at) - 1).alias("below"),
                    F.size(F.filter("_sorted", lambda x: x == at)).cast("long").alias("ties"))
    one = F.struct(F.col("_rank").cast("long").alias("rank"), F.col("_low").alias("value"),
                   F.col("_before").alias("below"), F.col("_size").alias("ties"))
    each = found.select(*keys, pick.alias("_pick")).unionByName(
        wanted.filter(~many).select(*keys, one.alias("_pick")))
    return each.groupBy(*keys).agg(F.sort_array(F.collect_list("_pick")).alias("picks"))


def median_ranks(n: Column) -> Column:
    """The one or two middle ranks of n values."""
    return F.array_distinct(F.array(F.floor((n + 1) / 2).cast("long"), (F.floor(n / 2) + 1).cast("long")))


def cut_ranks(buckets: int) -> Callable[[Column], Column]:
    """Last rank of each NTILE bucket but the last (the first ``n % buckets`` buckets hold one row
    more); buckets without rows are left out."""
    def ranks(n: Column) -> Column:
        small, more = F.floor(n / buckets).cast("long"), (n % buckets).cast("long")
        ends = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda k: (k * small + F.least(k, more)).cast("long"))
        return F.filter(F.array_distinct(ends), lambda e: (e > 0) & (e < n))
    return ranks


def mean_pick() -> Column:
    """The median: mean of the one or two picked values."""
    return F.aggregate("picks", F.lit(0.0), lambda s, p: s + p["value"], lambda s: F.try_divide(s, F.size("picks").cast("double")))
