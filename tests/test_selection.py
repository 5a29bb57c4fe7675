"""Histogram selection against sorted lists, and deciles by it against both rank paths."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelbeam.operators import ratio as R
from parcelbeam.operators.ranking import group_row_number, ntile_from_rank
from parcelbeam.operators.selection import cut_ranks, mean_pick, median_ranks, select_ranks

SCHEMA = "pin string, township_name string, neighborhood_number string, sale_price double, model_value double, desk_review_value double"


def brute(rows, ranks):
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    out = {}
    for g, vs in groups.items():
        kept = sorted(v for v in vs if v is not None and not math.isnan(v))
        picks = [(r, kept[r - 1], sum(x < kept[r - 1] for x in kept), kept.count(kept[r - 1])) for r in (ranks(len(kept)) if kept else [])] or None
        out[g] = (len(vs), len(kept), picks)
    return out


def run(spark, rows, ranks, **kw):
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    return {r.g: (r.n_rows, r.n_values, None if r.picks is None else [tuple(p) for p in r.picks])
            for r in select_ranks(df, ["g"], "v", ranks, **kw).collect()}


def medians_of(n):
    return sorted({(n + 1) // 2, n // 2 + 1})


def cuts_of(b):
    def ranks(n):
        ends = [k * (n // b) + min(k, n % b) for k in range(1, b)]
        return sorted({e for e in ends if 0 < e < n})
    return ranks


def made(rng):
    inf = float("inf")
    return {"spread": lambda: rng.uniform(-5, 5), "ties": lambda: float(rng.randrange(6)), "one": lambda: 7.5,
            "heavy": lambda: 10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]),
            "ends": lambda: rng.choice([inf, -inf, 0.0, -0.0, 1e308, -1e308, 5e-324, 1e-323, float("nan"), None, rng.random()])}


@pytest.mark.parametrize("most,buckets,kinds", [
    (10_000, 2048, ["spread", "ties", "one", "heavy", "ends", None]), (20, 64, ["spread", "ties", "one", "heavy", "ends", None]),
    (1, 2, ["ties", "one"])])
def test_equals_sorted_lists(spark, most, buckets, kinds):
    rng = random.Random(most)
    make = made(rng)
    rows = [(kind, make[kind or "spread"]()) for kind in kinds for _ in range(300 if kind == "heavy" else 120)]
    rows += [("single", 3.0), ("nothing", None), ("two", 1.0), ("two", 4.0)]
    assert run(spark, rows, median_ranks, most=most, buckets=buckets) == brute(rows, medians_of)
    assert run(spark, rows, cut_ranks(10), most=most, buckets=buckets) == brute(rows, cuts_of(10))


def test_median_of_picks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), ("c", None)], "g string, v double")
    got = {r.g: r.m for r in select_ranks(df, ["g"], "v", median_ranks).withColumn("m", mean_pick()).collect()}
    assert got == {"a": 2.5, "b": 2.0, "c": None}
    assert select_ranks(df.limit(0), ["g"], "v", median_ranks).count() == 0


def study(spark, n=1500):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        town = "HOT" if rng.random() < 0.6 else f"T{rng.randrange(4)}"
        price = rng.choice([None, float("inf") if i % 500 == 0 else 1.0, 250000.0, float(rng.randrange(50, 900) * 1000)])
        rows.append((f"{i // 2:06d}", town, None, price, float(i), float(n - i)))
    rows += [("s", "SMALL", None, 1.0, 1.0, 1.0), ("t", "SMALL", None, 1.0, 2.0, 1.0), ("u", "UNSOLD", None, None, 2.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("path", [0, 10 ** 9])
def test_deciles_equal_both_rank_paths(spark, path):
    """Many prices on a cut, parcels on two sheets: the same deciles as from full ranks."""
    df = study(spark)
    order = R.price_order(df, ["township_name"], "sale_price", "pin")
    ranked = group_row_number(df, ["township_name"], order, "pos", "rows", count_of="sale_price", count_col="priced",
                              window_max_group_rows=path)
    want = ranked.withColumn("price_decile", F.when(F.col("sale_price").isNotNull(), ntile_from_rank("pos", "priced", 10)))
    key = ["pin", "township_name", "sale_price", "model_value", "price_decile"]
    def as_rows(frame):
        return sorted((tuple(r) for r in frame.select(*key).collect()), key=repr)
    assert as_rows(R.add_price_deciles(df)) == as_rows(want)
    assert as_rows(R.rank_by_price(df)) == as_rows(want)


def test_ranks_of_the_layout_equal_a_window(spark):
    df = study(spark).filter("sale_price IS NOT NULL")
    got = R.rank_by_price(df)
    w = Window.partitionBy("township_name").orderBy("sale_price", "pin", "desk_review_value")
    both = got.withColumn("want", F.row_number().over(w))
    assert both.filter("price_rank <> want").count() == 0 and both.count() == df.count()


def _operators(df):
    """Lines of the physical plan, each with its depth."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [(len(line) - len(line.lstrip(" :+-*")), line.lstrip(" :+-*()0123456789")) for line in plan.split("\n") if line.strip()]


def test_study_outputs_scan_the_layout_without_shuffling_rows(spark):
    """One layout is written; beyond it only partial aggregates are exchanged, and nothing is
    sorted or ranked again."""
    spark.conf.set("spark.sql.maxMetadataValueLength", "1000")
    layout = R.rank_by_price(R.add_ratios(study(spark)))
    assert "/ranked-" in layout._jdf.queryExecution().executedPlan().toString()
    for out in (R.town_stats(layout), R.ratio_deciles(layout), R.neighborhood_medians(layout), layout):
        lines = _operators(out)
        names = [text.split(" ")[0].split("(")[0] for _, text in lines]
        assert not {"Window", "TakeOrderedAndProject", "InMemoryTableScan"} & set(names), names
        for i, (depth, text) in enumerate(lines):
            if text.startswith("Exchange hashpartitioning"):
                under = []
                for d, t in lines[i + 1:]:
                    if d <= depth:
                        break
                    under.append(t)
                scan = next((t for t in under if t.startswith("FileScan")), "")
                aggregated = any(t.startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")) for t in under)
                # rows of the layout are added up before; else it is a table with a row per group
                assert aggregated or "/ranked-" not in scan, under


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    layout = R.rank_by_price(R.add_ratios(study(spark)))
    R.town_stats(layout).collect()
    R.ratio_deciles(R.add_price_deciles(layout.drop("price_decile", "number_of_sales"))).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty() or all(
        "ExistingRDD" in str(r) or "Checkpoint" in str(r) or "MapPartitions" in str(r)
        for r in spark.sparkContext._jsc.getPersistentRDDs().values())
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
