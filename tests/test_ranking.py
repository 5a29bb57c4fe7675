"""The distributed rank must equal a plain window row_number, also when one
group holds most rows and is cut across many range partitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from parcelbeam.operators.ranking import group_row_number, largest_group, ntile_from_rank

PATHS = {"range": 0, "window": 10**9}


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 20)}"
        rows.append((g, float(rnd.randint(0, 50)), f"p{i:06d}"))
    return spark.createDataFrame(rows, "g string, v double, pin string")


@pytest.mark.parametrize("path", sorted(PATHS))
def test_rank_equals_window_row_number(spark, path):
    df = _data(spark)
    ours = group_row_number(df, ["g"], ["v", "pin"], "r", "n", num_partitions=16,
                            window_max_group_rows=PATHS[path])
    w = Window.partitionBy("g").orderBy("v", "pin")
    ref = df.withColumn("r_ref", F.row_number().over(w)).withColumn("n_ref", F.count("*").over(Window.partitionBy("g")))
    j = ours.join(ref, ["g", "v", "pin"])
    assert j.count() == df.count()
    assert j.filter((F.col("r") != F.col("r_ref")) | (F.col("n") != F.col("n_ref"))).count() == 0


def test_size_check_picks_range_for_hot_group(spark):
    df = _data(spark)
    assert largest_group(df, ["g"]) > 1500  # the hot group holds most rows
    ranked = group_row_number(df, ["g"], ["v", "pin"], "r", "n", num_partitions=16, window_max_group_rows=1000)
    # range path: the hot group's rows are spread over several partitions of the sort
    assert "_rk_part" not in ranked.columns
    assert ranked.filter(F.col("g") == "hot").agg(F.max("r")).first()[0] == largest_group(df, ["g"])


@pytest.mark.parametrize("path", sorted(PATHS))
def test_ntile_matches_sql_ntile(spark, path):
    df = _data(spark, n=1234)
    ranked = group_row_number(df, ["g"], ["v", "pin"], "r", "n", window_max_group_rows=PATHS[path])
    ours = ranked.withColumn("t", ntile_from_rank("r", "n", 10))
    ref = df.withColumn("t_ref", F.ntile(10).over(Window.partitionBy("g").orderBy("v", "pin")))
    j = ours.join(ref, ["g", "v", "pin"])
    assert j.filter(F.col("t") != F.col("t_ref")).count() == 0


def test_ntile_bucket_sizes_13_rows(spark):
    df = spark.createDataFrame([("a", float(i), f"p{i:02d}") for i in range(13)], "g string, v double, pin string")
    out = group_row_number(df, ["g"], ["v", "pin"], "r", "n").withColumn("t", ntile_from_rank("r", "n", 10))
    sizes = [r["c"] for r in out.groupBy("t").agg(F.count("*").alias("c")).orderBy("t").collect()]
    assert sizes == [2, 2, 2, 1, 1, 1, 1, 1, 1, 1]
