"""WKB built from columns, read back with struct."""

import math
import random
import struct

from pyspark.sql import functions as F

from parcelbeam.functions import wkb


def test_bits_of_doubles(spark):
    rng = random.Random(2)
    values = [0.0, 1.0, -1.0, 2.0, 0.5, -87.95, 41.6, 1 / 3, 1e308, -1e-300, 2.0 ** -1022, math.inf, -math.inf, 2.0 ** 52 - 1, 2.0 ** 53 + 2,
              math.nextafter(1, 0), math.nextafter(2, 0), math.nextafter(8, 9), 1e22, 1e23, -180.0]
    values += [rng.uniform(-180, 180) for _ in range(300)] + [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", wkb.double_hex(F.col("v")).alias("h")).collect():
        assert r.h == struct.pack(">d", r.v).hex().upper(), r.v
    odd = spark.createDataFrame([(math.nan,), (None,), (5e-324,)], "v double")
    assert [r.h for r in odd.select(wkb.double_hex(F.col("v")).alias("h")).collect()] == [None, None, None]


def points(data):
    order, kind, rings, n = struct.unpack(">BIII", data[:13])
    assert (order, kind, rings) == (0, 3, 1) and len(data) == 13 + 16 * n
    return [struct.unpack(">dd", data[13 + 16 * i:29 + 16 * i]) for i in range(n)]


def test_polygons(spark):
    df = spark.createDataFrame([(0.0, 1.0, 2.5, 3.25), (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    got = df.select(wkb.polygon_wkb(wkb.box(*map(F.col, "abcd"))).alias("g")).collect()
    assert points(bytes(got[0].g)) == [(0, 1), (2.5, 1), (2.5, 3.25), (0, 3.25), (0, 1)] and got[1].g is None
    rings = [[(0.0, 0.0), (1.0, 0.0), (1.0, 2.0)], [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)], [(None, 1.0)], [], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "i int, p array<struct<x: double, y: double>>")
    got = [r.g for r in df.select("i", wkb.points_wkb(F.col("p")).alias("g")).orderBy("i").collect()]
    assert points(bytes(got[0])) == rings[0] + rings[0][:1] and points(bytes(got[1])) == rings[1]
    assert got[2:] == [None, None, None]
