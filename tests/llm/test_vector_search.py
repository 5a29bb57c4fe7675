import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelbeam.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, label int, block int, chunk int, v int"


def brute(rows, every=50, k=5):
    usable = [(i, [math.floor(256 * x) for x in np.array(v, dtype=np.float32).astype(float)]) for i, v, *_ in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in usable if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, start=1)]
    return sorted(out)


def run(spark, rows, every=50):
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v, *_ in rows], SCHEMA)
    return sorted(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % every == 0, 5)
                  .select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block,chunk", [(4096, 2048), (70, 3)])
def test_equals_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 24)) * 0.3
    rows = [(i, (centres[i % 6] + rng.normal(size=24) * 0.1).tolist()) for i in range(400)]
    assert run(spark, rows) == brute(rows)


def test_many_partitions(spark, monkeypatch):
    """Both sides of a cell meet however many partitions there are."""
    monkeypatch.setattr(vector_search, "BLOCK", 60)
    monkeypatch.setattr(vector_search, "CHUNK", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = np.random.default_rng(4)
        rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, []), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (None, [9.0, 9.0]), (8, [2.0]), (9, [0.0, 0.0]), (50, [0.0, 0.0]), (100, [-1.0, 2.0, 3.0]), (2, [1.0, 0.5])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[2] for r in got if r[0] == 0][:1] == [8]


def test_repeated_query_ids_are_ranked_apart(spark):
    rows = [(50, [1.0]), (50, [1.0]), (0, [-1.0]), (50, [2.0])] + [(i, [i / 256]) for i in range(1, 10)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[3] // 256 for r in got if r[0] == 50 and r[1] == 1] == [9, 9, 18]


def test_few_candidates_large_values_and_empty(spark):
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []
    rows = [(i, [1e6 * (i - 3), 1e5 * i]) for i in range(7)]
    assert run(spark, rows, 1) == brute(rows, 1)


def test_search_stops_before_all_levels_and_is_exact():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(3000, 32)) * 60).astype(np.int64)
    index = vector_search.ImpactIndex(np.arange(3000), vectors)
    for i in range(0, 3000, 300):
        scores = vectors @ vectors[i]
        want = [(int(scores[j]), int(j)) for j in np.lexsort((np.arange(3000), -scores)) if j != i][:5]
        assert index.search(vectors[i], i, 5) == want


def test_small_dimensions_are_bounded_by_their_own_gain(monkeypatch):
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.normal(size=(3000, 32)) * 4000 * 0.5 ** np.arange(32)).astype(np.int64)
    index = vector_search.ImpactIndex(np.arange(3000), vectors)
    levels, partition = [], np.argpartition
    monkeypatch.setattr(np, "argpartition", lambda *args: levels.append(1) or partition(*args))
    for i in range(0, 3000, 300):
        scores = vectors @ vectors[i]
        want = [(int(scores[j]), int(j)) for j in np.lexsort((np.arange(3000), -scores)) if j != i][:5]
        assert index.search(vectors[i], i, 5) == want
    # of ten levels a query takes less than half: small dimensions cannot add a whole floor
    assert len(levels) <= 10 * 5


def test_postings_that_reach_a_floor():
    rng = np.random.default_rng(7)
    vectors = rng.integers(-90, 60, size=(200, 9))
    vectors[:, 4] = 7
    index = vector_search.ImpactIndex(np.arange(200), vectors)
    query = np.array([5, -3, 0, 1, 2, -1, 40, -40, 9])
    low = np.sort(vectors // 4 * 4, axis=0).T
    gain = np.maximum(query[:, None] * low, query[:, None] * (low + 3))
    least = np.minimum(query[:, None] * low, query[:, None] * (low + 3)).min(axis=1)
    floors = np.array([4000, 900, 100, 7, 1, 0])
    want = [[0 if query[d] == 0 else int((gain[d] - least[d] >= f).sum()) for d in range(9)] for f in floors]
    assert index.ends(query, least, floors).tolist() == want
