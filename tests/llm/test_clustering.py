import hashlib
import math

import numpy as np
import pytest

from parcelbeam.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, first int, v int, cluster int"


def brute(rows, k, rounds, width, seed=2):
    kept = [(i, np.array([math.floor(256 * float(np.float32(x))) for x in v], dtype=object)) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), list(r[1])))
    at = [v for _, v in start[:k]]

    def nearest():
        return [min((int(((v - c) ** 2).sum()), n) for n, c in enumerate(at)) for _, v in kept]
    for _ in range(rounds):
        found = nearest()
        for n in range(len(at)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                at[n] = sum(own[1:], own[0]) // len(own)
    found = nearest()
    inertia = [sum(d for d, m in found if m == n) for n in range(len(at))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    key = lambda r: (r[0] is None, r)
    return sorted(((i, m, d, inertia[m], sum(inertia), digests[m]) for (i, _), (d, m) in zip(kept, found)), key=key)


def run(spark, rows, k, rounds, width):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in clustering.clusters(df, k, rounds, width).collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("k,rounds", [(12, 5), (40, 3), (2, 2), (1, 2)])
def test_equals_brute_force(spark, monkeypatch, k, rounds):
    monkeypatch.setattr(clustering, "ROWS", 50)
    rng = np.random.default_rng(k)
    middles = rng.normal(size=(9, 8)) * 0.5
    rows = [(i, (middles[i % 9] + rng.normal(size=8) * 0.2).tolist()) for i in range(400)]
    assert run(spark, rows, k, rounds, 8) == brute(rows, k, rounds, 8)


def test_ties_and_repeated_rows(spark):
    """A coarse grid: many equal distances, equal vectors and equal centroids."""
    rng = np.random.default_rng(3)
    rows = [(i // 2, (rng.integers(-2, 3, size=3) / 256).tolist()) for i in range(150)]
    assert run(spark, rows, 20, 4, 3) == brute(rows, 20, 4, 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, -inf]),
            (8, [0.5, 0.5]), (8, [0.5, 0.5]), (None, [0.25, -1.0]), (None, [4.0, 4.0]), (9, [-0.001, 0.001])]
    got = run(spark, rows, 40, 5, 2)
    assert got == brute(rows, 40, 5, 2) and len(got) == 5
    assert run(spark, rows[:7], 40, 5, 2) == [] == run(spark, [], 40, 5, 2)
    # beyond the range of exact squared distances
    assert [r[0] for r in run(spark, [*rows, (10, [1e8, 0.0]), (11, [3e38, 0.0])], 3, 1, 2)].count(10) == 0


def test_largest_components_stay_exact(spark):
    edge = clustering.largest(2) // 256 - 1
    rows = [(i, [float((-1) ** i * edge), float(i)]) for i in range(6)]
    assert run(spark, rows, 2, 2, 2) == brute(rows, 2, 2, 2)


def test_search_skips_most_distances():
    """The state of a round spares searches in the next; results stay those of a full comparison."""
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(40, 16)) * 300
    vectors = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 16)) * 40).astype(np.int64)
    n = len(vectors)
    at = vectors[rng.choice(n, 40, replace=False)]
    state = clustering.Assignment(vectors, np.zeros(n, np.int32), np.ones(n, np.int32), np.full(n, np.inf), np.full(n, -np.inf))
    before, taken = None, []
    for _ in range(6):
        state.searched = 0
        state.advance(clustering.Centroids(at, before))
        distances = ((vectors[:, None, :] - at[None]) ** 2).sum(2)
        assert (state.first == distances.argmin(1)).all()
        assert (state.upper >= np.sqrt(distances.min(1))).all()
        others = distances.copy()
        others[np.arange(n), state.first] = np.iinfo(np.int64).max
        assert (state.lower <= np.sqrt(others.min(1))).all()
        taken.append(state.searched)
        before, at = at, np.array([vectors[state.first == m].sum(0) // max((state.first == m).sum(), 1)
                                   if (state.first == m).any() else at[m] for m in range(40)])
    # the first round knows no near centroid yet
    assert taken[0] < n * 40 and taken[1] < taken[0] / 2 and taken[-1] < 0.1 * n * 40
