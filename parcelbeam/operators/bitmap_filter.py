"""Pruning of a large table by a bitmap of the wanted keys.

When a key list is too large to broadcast, a join shuffles both sides, and most rows of the large one
only to be dropped.  A bitmap of the keys' hashes is far smaller than the keys: Spark's
bitmap aggregates build it bucket by bucket (4 KB each, merged per task before the shuffle), it is
broadcast, and rows whose bit is not set are dropped where they are read.  A set bit may be another
key's, so an exact join follows; the filter only spares its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.operators.attach import broadcast_limit, sized
from parcelbeam.session import written

#: Bits of one bucket of Spark's bitmap aggregates.
BUCKET_BITS = 32768
#: Bits aimed at per key: about one row in eight that is not wanted passes with 8.
BITS_PER_KEY = 8
#: At most so many buckets (4 KB each), which bounds the broadcast at 64 MB; with more keys more
#: unwanted rows pass.
MAX_BUCKETS = 16384


def _place(key: Column, buckets: int) -> Column:
    """A bit for a key: 1 to the number of bits."""
    return F.pmod(F.xxhash64(key), F.lit(buckets * BUCKET_BITS)) + 1


def bucket_count(keys: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-keys * BITS_PER_KEY // BUCKET_BITS)))


def key_bitmap(keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The bits of all keys: bucket, bits (4,096 bytes); one row per bucket that has any."""
    place = keys.filter(F.col(key).isNotNull()).select(_place(F.col(key), buckets).alias("place"))
    return place.groupBy(F.bitmap_bucket_number("place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))


def possibly_wanted(df: DataFrame, key: str, bitmap: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``df`` whose key's bit is set: all wanted ones and few others."""
    place = _place(F.col(key), buckets)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmap), "_bucket")
    # the position inside a byte counts from its lowest bit
    return joined.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("_bucket", "_bits")


def keep_possibly_wanted(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted`` (of one column, ``key``), and perhaps a few others:
    for a join that leaves those out by itself.  No row of ``df`` is shuffled.

    The list is counted: a short one is broadcast into a semi-join; for a longer one the bitmap (at
    most ``MAX_BUCKETS`` rows, written once) is broadcast instead."""
    wanted = wanted.select(key).filter(F.col(key).isNotNull())
    n = wanted.count()
    if n <= broadcast_limit(df.sparkSession):
        return df.join(sized(wanted, n), key, "left_semi")
    buckets = bucket_count(n)
    return possibly_wanted(df, key, written(key_bitmap(wanted, key, buckets), "bitmap"), buckets)


def keep_wanted(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted``, each once: ``keep_possibly_wanted``, then an exact
    join with the different keys, whose shuffle few others reach.  (A semi-join would be moved
    below the bitmap's join by the optimizer.)"""
    pruned = keep_possibly_wanted(df, wanted, key)
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    return pruned.join(keys, key, "inner").select(*df.columns)
