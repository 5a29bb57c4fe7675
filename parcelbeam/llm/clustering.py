"""Centroid clustering in whole numbers by Shallot search (op 13).

Vectors become whole numbers once and are written with the state that a round hands to the next: the
assigned and the second-nearest centroid, an upper bound on the distance to the first and a lower
bound on the distance to all others.  A round widens the bounds by how far centroids moved.  Where
the upper bound, made exact if need be, stays below the lower one or below half the way to the
nearest other centroid, the vector keeps its centroid.  Else both remembered centroids are measured
and the nearer one becomes the middle of the search: its neighbours are scanned in order of their
distance from it, as far as a ball of its own distance plus the second-best distance so far, which
shrinks with every nearer centroid found.

Bounds are doubles that err on the safe side and only rule centroids out; those left are compared by
their squared distances in 64-bit whole numbers, ties going to the smaller number.  The bounds never
change a result.

Each round is one pass over the vectors without a shuffle, and one aggregation, with sums per task,
of a row per centroid.  Only centroids (``k`` of them) reach the driver and travel to the tasks.  A
round's table is written to the shared folder and the one before it deleted then.

Edge cases: vectors that are null, of another width, or hold null or non-finite components take no
part, nor do those with a component of ``largest(width)`` (2^27 for 64) or more in amount, whose
squared distances a long cannot hold; null ids count as empty text for the start; equal hashes are ordered by components; with fewer
vectors than ``k`` all are centroids; repeated rows count each; empty clusters keep their centroid;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import drop_written, map_batches, written

#: Doubles are off by far less than this share after a few roundings.
SLACK = 1e-9
#: Vectors that a worker assigns at a time.
ROWS = 8192

STATE = "vec_id long, v array<int>, first int, second int, upper double, lower double"


def largest(width: int) -> int:
    """Components below this in amount have squared distances below 2^62."""
    return int((2 ** 62 / width) ** 0.5) // 2


def whole_vector(embedding: Column, width: int, scale: int) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    edge = largest(width) / scale
    x = embedding.cast("array<double>")
    # a component beyond the range, null or not a number is none of these
    fine = F.forall(x, lambda c: F.coalesce((c >= -edge) & (c < edge), F.lit(False)))
    return F.when((F.size(x) == width) & fine, F.transform(x, lambda c: F.floor(c * scale).cast("int")))


def starting_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:id``, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


class Centroids:
    """Centroids with their distances to each other, and how far each has moved."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        k = len(at)
        self.apart = np.sqrt(np.array([squared(at, c) for c in at], dtype=np.float64).reshape(k, k))
        # neighbours of each, nearest first, itself left out
        order = np.argsort(self.apart + np.diag(np.full(k, -1.0)), axis=1, kind="stable")
        self.order = order[:, 1:].astype(np.int32)
        self.half_way = np.take_along_axis(self.apart, self.order, axis=1)[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(squared(at, before).astype(np.float64))
        self.moved = moved * (1 + SLACK)
        # how far any centroid but this one has moved at most
        by_move = np.sort(self.moved)
        self.others_moved = np.where(self.moved == by_move[-1], by_move[-2] if k > 1 else 0.0, by_move[-1])


class Assignment:
    """State of some vectors: first and second centroid, upper and lower bound."""

    def __init__(self, vectors: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.vectors, self.first, self.second, self.upper, self.lower = vectors, first, second, upper, lower
        self.searched = 0  # squared distances taken

    def advance(self, centroids: Centroids) -> None:
        """The nearest centroid of every vector, after the centroids have moved."""
        c = centroids
        self.upper += c.moved[self.first]
        self.lower -= c.others_moved[self.first]
        sure = np.maximum(self.lower, c.half_way[self.first]) * (1 - SLACK)
        open_ = np.flatnonzero(self.upper >= sure)
        if not len(open_):
            return
        d = squared(self.vectors[open_], c.at[self.first[open_]])
        self.searched += len(open_)
        self.upper[open_] = np.sqrt(d.astype(np.float64)) * (1 + SLACK)
        still = self.upper[open_] >= sure[open_]
        if len(c.at) > 1:
            self.search(open_[still], d[still], c)

    def search(self, rows: np.ndarray, d_first: np.ndarray, c: Centroids) -> None:
        vectors = self.vectors[rows]
        best, second = self.first[rows].copy(), self.second[rows].copy()
        d_best, d_second = d_first.copy(), squared(vectors, c.at[second])
        self.searched += len(rows)
        swap = (d_second < d_best) | ((d_second == d_best) & (second < best))
        best[swap], second[swap] = second[swap], best[swap]
        d_best[swap], d_second[swap] = d_second[swap], d_best[swap]
        middle, d_middle = best.copy(), np.sqrt(d_best.astype(np.float64))
        known = second.copy()  # of the two measured ones, the one that is not the middle
        going = np.arange(len(rows))
        for rank in range(c.order.shape[1]):
            candidate = c.order[middle[going], rank]
            radius = (d_middle[going] + np.sqrt(d_second[going].astype(np.float64))) * (1 + SLACK)
            inside = c.apart[middle[going], candidate] <= radius
            going, candidate = going[inside], candidate[inside]
            if not len(going):
                break
            new = candidate != known[going]
            at, z = going[new], candidate[new]
            d = squared(vectors[at], c.at[z])
            self.searched += len(at)
            nearer = (d < d_best[at]) | ((d == d_best[at]) & (z < best[at]))
            next_ = ~nearer & (d < d_second[at])
            moved = at[nearer]
            second[moved], d_second[moved] = best[moved], d_best[moved]
            best[moved], d_best[moved] = z[nearer], d[nearer]
            second[at[next_]], d_second[at[next_]] = z[next_], d[next_]
        self.first[rows], self.second[rows] = best, second
        self.upper[rows] = np.sqrt(d_best.astype(np.float64)) * (1 + SLACK)
        # centroids never measured lie outside the ball, so no nearer than the second
        self.lower[rows] = np.sqrt(d_second.astype(np.float64)) * (1 - SLACK)


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), width)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def state_of(batch: pa.RecordBatch, width: int) -> Assignment:
    columns = [batch.column(i).to_numpy(zero_copy_only=False).copy() for i in range(2, 6)]
    return Assignment(matrix(batch.column(1), width), *columns)


def assigned(state: DataFrame, centroids: Centroids) -> DataFrame:
    """The state after a search among ``centroids``."""
    width = centroids.at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            now = state_of(batch, width)
            now.advance(centroids)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(now.first), pa.array(now.second),
                                   pa.array(now.upper), pa.array(now.lower)], names=batch.schema.names)

    return map_batches(state, run, STATE)


def measured(state: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, cluster and exact squared distance after a search among ``centroids``."""
    width = centroids.at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            now = state_of(batch, width)
            now.advance(centroids)
            yield pa.record_batch([batch.column(0), pa.array(now.first), pa.array(squared(now.vectors, centroids.at[now.first]))],
                                  names=["vec_id", "cluster", "distance"])

    return map_batches(state, run, "vec_id long, cluster int, distance long")


def means(state: DataFrame, at: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; empty clusters keep their centroid."""
    sums = [F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(at.shape[1])]
    out = at.copy()
    for row in state.groupBy("first").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # k rows at most
        out[row["first"]] = [row[f"s{i}"] // row["n"] for i in range(at.shape[1])]
    return out


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_vector(F.col("embedding"), width, scale).alias("v"))
    # without state, every bound is open and the first two centroids are the ones remembered
    state = written(whole.filter("v IS NOT NULL").select(
        "vec_id", "v", F.lit(0).alias("first"), F.lit(1).alias("second"),
        F.lit(float("inf")).alias("upper"), F.lit(float("-inf")).alias("lower")), "vectors")
    at = starting_centroids(state, k, seed)
    if not len(at):
        return state.select("vec_id", F.lit(0).alias("cluster"), *(
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    now = Centroids(at)
    for _ in range(rounds):
        before, state = state, written(assigned(state, now), "assigned")
        drop_written(spark, before)
        now = Centroids(means(state, now.at), now.at)
    found = written(measured(state, now), "clusters")
    drop_written(spark, state)
    totals = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows at most
    inertia = sum(r.cluster_inertia for r in totals)
    rows = [(r.cluster, r.cluster_inertia, inertia,
             hashlib.sha256(",".join(map(str, now.at[r.cluster].tolist())).encode()).hexdigest()) for r in totals]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
