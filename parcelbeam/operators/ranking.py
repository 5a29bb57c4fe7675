"""Row numbers within groups without putting a group in one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a
group to a single task.  When one township holds a third of all parcels
that task holds a third of the data.  ``ranked_layout`` gets the same
numbers from one table, written once and read by every output:

1. ``repartitionByRange(g, o)`` + ``sortWithinPartitions(g, o)``: every
   partition holds one contiguous slice of the total order, and a hot
   group is spread over as many partitions as its size needs (the sort key
   ends in a unique tie-breaker, so the range bounds can cut inside it;
   buckets by group could not).
2. Each row gets its partition and its position there (from
   ``monotonically_increasing_id``: position in the lower 33 bits), and
   the rows are written as a Parquet table in the shared folder.  The
   numbers are as fixed as the files, whatever executors are lost later.
3. A small table -- one row per (partition, group), so at most
   ``partitions + groups`` rows -- gives each group's first position and
   row count per partition; a running sum over partitions gives the rows
   of the same group in earlier partitions.
4. That table is joined back when the layout is read -- broadcast after
   it has been counted (see ``attach.join_small``) -- so ranks, group
   sizes, NTILE buckets and rank-weighted sums are column arithmetic over
   a scan, without a further Exchange.

``group_row_number`` is the general form for any rank.  When every group is
small, a plain ``row_number`` window (one shuffle, groups spread over tasks
by hash) is cheaper; it counts the rows of the largest group (one partial
aggregate, one number back) and uses the window only when that group fits in
a task (``parcelbeam.rank.windowMaxGroupRows``, default 2,000,000 rows).
The ratio study does not depend on that size: it ranks by the layout and
takes medians and deciles by histogram selection (``selection``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelbeam.operators.attach import join_small
from parcelbeam.session import written

_POS_BITS = 33
WINDOW_MAX_GROUP_ROWS_CONF = "parcelbeam.rank.windowMaxGroupRows"
DEFAULT_WINDOW_MAX_GROUP_ROWS = 2_000_000


def window_limit(df: DataFrame) -> int:
    """Largest group (rows) that may be ranked by a single-task window."""
    value = df.sparkSession.conf.get(WINDOW_MAX_GROUP_ROWS_CONF, None)
    return int(value) if value is not None else DEFAULT_WINDOW_MAX_GROUP_ROWS


def largest_group(df: DataFrame, group_cols: Sequence[str]) -> int:
    """Rows in the largest group: a partial (map-side) count, one number to the driver."""
    row = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("m")).first()
    return int(row["m"] or 0) if row else 0


def group_row_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                     rank_col: str = "rank", size_col: str = "group_size",
                     num_partitions: int | None = None,
                     count_of: str | None = None, count_col: str | None = None,
                     window_max_group_rows: int | None = None,
                     known_max_group_rows: int | None = None) -> DataFrame:
    """Add ``rank_col`` (1-based row number inside each group, by ``order_cols``)
    and ``size_col`` (rows in the group).  With ``count_of``/``count_col`` also
    the number of non-NULL ``count_of`` values in the group.

    ``window_max_group_rows`` overrides the size bound for the window path;
    0 forces the range path.  ``known_max_group_rows`` is an upper bound on
    the group size the caller already measured (e.g. on a coarser grouping of
    the same rows); without it the input is counted here, so it should be
    cheap to read twice (persisted or checkpointed).
    """
    limit = window_limit(df) if window_max_group_rows is None else window_max_group_rows
    if limit <= 0:
        use_window = False
    else:
        largest = known_max_group_rows if known_max_group_rows is not None else largest_group(df, group_cols)
        use_window = largest <= limit
    if use_window:
        return window_row_number(df, group_cols, order_cols, rank_col, size_col, count_of, count_col)
    return range_row_number(df, group_cols, order_cols, rank_col, size_col, num_partitions, count_of, count_col)


def window_row_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                      rank_col: str = "rank", size_col: str = "group_size",
                      count_of: str | None = None, count_col: str | None = None) -> DataFrame:
    """Window form, for groups known to fit in one task."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    whole = Window.partitionBy(*group_cols)
    cols = {rank_col: F.row_number().over(whole.orderBy(*order)), size_col: F.count(F.lit(1)).over(whole)}
    if count_of:
        cols[count_col] = F.count(count_of).over(whole)
    return df.withColumns(cols)


def total_order(df: DataFrame, first: Sequence[Column | str]) -> list[Column | str]:
    """``first`` followed by all other sortable columns, by name: rows that still tie are equal in
    every column, so any order of theirs gives the same numbers (and so does a retried task)."""
    named = {c for c in first if isinstance(c, str)}
    rest = [f.name for f in sorted(df.schema.fields, key=lambda f: f.name)
            if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    return [*first, *[F.col(f"`{c}`") for c in rest]]


def range_row_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                     rank_col: str = "rank", size_col: str = "group_size",
                     num_partitions: int | None = None,
                     count_of: str | None = None, count_col: str | None = None) -> DataFrame:
    """Range-partitioned form, for groups of any size: the rows of ``ranked_layout``."""
    return ranked_layout(df, group_cols, order_cols, rank_col, size_col, num_partitions, count_of, count_col)


def ranked_layout(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                  rank_col: str = "rank", size_col: str = "group_size",
                  num_partitions: int | None = None,
                  count_of: str | None = None, count_col: str | None = None) -> DataFrame:
    """``df`` written once, range-partitioned and sorted by group and order, and read back with
    ``rank_col`` and ``size_col`` (see module notes).

    ``order_cols`` must end in a tie-breaker that is unique inside a group so
    the numbering is deterministic.  ``df`` is held in memory and on disk only while it is
    sampled for the range bounds and dealt out.
    """
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(c) for c in group_cols] + order
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        spread = held.repartitionByRange(num_partitions, *keys) if num_partitions else held.repartitionByRange(*keys)
        layout = written(spread.sortWithinPartitions(*keys)
                         .withColumn("_rk_part", F.spark_partition_id())
                         .withColumn("_rk_pos", F.monotonically_increasing_id()
                                     - F.shiftleft(F.col("_rk_part").cast("long"), _POS_BITS)), "ranked")
    finally:
        held.unpersist()

    # One row per (partition, group): bounded by partitions + groups.
    part_aggs = [F.min("_rk_pos").alias("_rk_first"), F.count(F.lit(1)).alias("_rk_cnt")]
    if count_of:
        part_aggs.append(F.count(count_of).alias("_rk_nn"))
    per_part = layout.groupBy("_rk_part", *group_cols).agg(*part_aggs)
    w_before = (Window.partitionBy(*group_cols).orderBy("_rk_part")
                .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*group_cols)
    extra = [F.sum("_rk_nn").over(w_all).alias(count_col)] if count_of else []
    offsets = per_part.select(
        "_rk_part", *group_cols, "_rk_first",
        F.coalesce(F.sum("_rk_cnt").over(w_before), F.lit(0)).alias("_rk_before"),
        F.sum("_rk_cnt").over(w_all).alias(size_col), *extra)

    # Null-safe: a NULL group (a parcel without a neighborhood) is a group too.
    joined = join_small(layout, offsets, ["_rk_part", *group_cols], null_safe=True)
    return (joined
            .withColumn(rank_col, (F.col("_rk_before") + F.col("_rk_pos") - F.col("_rk_first") + 1))
            .drop("_rk_part", "_rk_pos", "_rk_first", "_rk_before"))


def ntile_from_rank(rank: Column | str, size: Column | str, buckets: int) -> Column:
    """SQL NTILE from a 1-based rank and the group size: the first ``size % buckets``
    buckets hold one row more than the rest."""
    r = F.col(rank) if isinstance(rank, str) else rank
    n = F.col(size) if isinstance(size, str) else size
    k = F.lit(buckets)
    q = F.floor(n / k).cast("long")
    rem = (n - q * k).cast("long")
    big = q + 1
    threshold = rem * big
    in_big = F.floor((r - 1) / big).cast("long") + 1
    in_small = rem + F.floor((r - threshold - 1) / F.greatest(q, F.lit(1))).cast("long") + 1
    return F.when(r.isNull() | n.isNull(), F.lit(None).cast("int")).otherwise(
        F.when(r <= threshold, in_big).otherwise(in_small).cast("int"))
