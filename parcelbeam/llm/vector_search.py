"""Exact top-k inner product by an impact-ordered, score-at-a-time index (op 7).

Vector components are whole numbers.  Candidates are dealt into blocks of bounded size, queries
into chunks, and every block meets every chunk in a task of its own.  A block keeps, for each
dimension, its postings sorted by quantised impact.  A query takes the segments of all dimensions
in descending impact, level by level, adding them up for the vectors they name.  After a level it
knows for every vector how much it can still gain; it stops only when at most a few vectors can
reach the k-th best exact score found so far, and scores those exactly.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part, nor
do rows without an id; a shorter vector counts as filled up with zeros; rows that share a query's
id are the query's own; repeated candidate rows are each ranked; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelbeam.llm.common import checkpointed, ship_package

BLOCK = 4096
CHUNK = 2048
QUANTUM = 4
#: Impact levels, as shares of the largest gain of a query in a block; the last takes the rest.
LEVELS = (0.8, 0.66, 0.58, 0.52, 0.47, 0.42, 0.36, 0.28, 0.18, 0.0)
FEW = 64
SEEN = float(2 ** 40)


def whole_components(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    x = embedding.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return F.when(x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(False)), whole)


class ImpactIndex:
    """Postings of one block, per dimension sorted by value; values quantised to ``QUANTUM``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()  # [dimension, rank] -> row
        # a posting's impact is at least that of the low value, at most that of low + QUANTUM - 1
        low = np.take_along_axis(vectors, self.order.T, axis=0).T // QUANTUM * QUANTUM
        self.low = low.astype(np.float64)
        self.least, self.most = low.min(initial=0), low.max(initial=0)
        self.span = int(self.most) - int(self.least) + 3
        # the low values of all dimensions in one order, where they fit in a long
        self.whole = self.span * len(low) < 2 ** 62
        self.gains = np.empty(low.shape)  # room for those of one search
        self.places = (low - self.least + 1 + self.span * np.arange(len(low))[:, None]).ravel() if self.whole else None

    def ends(self, query: np.ndarray, least: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """For each floor and dimension the number of postings whose gain reaches the floor."""
        n, dims = len(self.ids), np.arange(len(query))
        up, q = query > 0, np.where(query == 0, 1, query)
        need = floors[:, None] + least
        # the least low value for a positive component; the first one too high for a negative one
        edge = np.where(up, -(-need // q) - (QUANTUM - 1), need // q + 1)
        edge = np.clip(edge, self.least, self.most + 1) - self.least + 1
        at = np.searchsorted(self.places, edge + self.span * dims) - n * dims
        return np.where(query == 0, 0, np.where(up, n - at, at))

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), by score and then smaller id."""
        n = len(self.ids)
        up = query >= 0
        q = query.astype(np.float64)
        # the gain of a posting: its impact above the least that its dimension can add
        lowest, highest = q * self.low[:, 0], q * (self.low[:, -1] + (QUANTUM - 1))
        least, most = np.where(up, lowest, highest), np.where(up, highest, lowest)
        gain_max = most - least
        top = gain_max.max(initial=0.0)
        largest = max(top, np.abs(least).max(initial=0.0), np.abs(most).max(initial=0.0))
        done = np.zeros(len(q), dtype=np.int64)
        sums = np.zeros(n)  # gains so far, plus SEEN for each dimension met
        alive = self.ids != own
        if not alive.any():
            return []
        possible = np.flatnonzero(alive)
        # beyond this the sums would not be whole in a double: everything is then scored exactly
        if largest * len(q) < SEEN and self.whole:
            floors = np.ceil(np.array(LEVELS) * top)
            ends = self.ends(query, least.astype(np.int64), floors.astype(np.int64))
            gains = np.multiply(self.low, q[:, None], out=self.gains)
            gains += (np.where(up, q * (QUANTUM - 1), 0) - least + SEEN)[:, None]
        else:
            floors = ends = ()
        for floor, end in zip(floors, ends):
            begin = np.where(up, n - end, done)
            for d in np.flatnonzero(end > done):
                part = slice(begin[d], begin[d] + end[d] - done[d])
                np.add.at(sums, self.order[d, part], gains[d, part])
            done = np.maximum(done, end)
            met = np.floor(sums / SEEN)
            # an unmet dimension can add at most the floor, and never more than its own largest gain,
            # which is above the floor for those met
            bound = (sums - met * SEEN) + (np.minimum(gain_max, floor).sum() - met * floor) + least.sum()
            bound[~alive] = -np.inf
            lead = np.argpartition(-bound, min(4 * k, n - 1))[: 4 * k]
            lead = lead[alive[lead]]
            if len(lead) >= k:
                scores = np.sort(self.vectors[lead] @ query)[::-1]
                possible = np.flatnonzero(bound >= scores[k - 1])
                if len(possible) <= FEW:
                    break
        scores = self.vectors[possible] @ query
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return [(int(scores[i]), int(self.ids[possible[i]])) for i in best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: Column, k: int, scale: int = 256) -> DataFrame:
    """Rows query_id, rank (from 1), vec_id, score: for every row that the condition ``queries``
    selects, the ``k`` candidates of highest inner product among all other rows."""
    whole = checkpointed(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                        whole_components(F.col("embedding"), scale).alias("v"),
                                        F.coalesce(queries, F.lit(False)).alias("asks"))
                         .filter("vec_id IS NOT NULL AND v IS NOT NULL"))
    n, asked = whole.agg(F.count("*"), F.count_if("asks")).first()
    blocks, chunks = max(1, -(-n // BLOCK)), max(1, -(-asked // CHUNK))
    # rows of the written table keep their numbers on a retry, and no id decides a block
    deal = lambda count: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int")
    # both sides number cells in the same type: hashes of an int and of a long differ
    cells = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = whole.withColumn("block", deal(blocks)).select(
        "vec_id", "v", "block", cells(chunks).alias("chunk"))
    asking = whole.withColumn("ask", F.monotonically_increasing_id()).withColumn("chunk", deal(chunks)).filter(
        "asks").select("vec_id", "v", "ask", "chunk", cells(blocks).alias("block"))

    def run(block: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(block) and len(chunk):
            width = max(block["v"].map(len).max(), chunk["v"].map(len).max())
            index = ImpactIndex(block["vec_id"].to_numpy(), _matrix(block["v"], width))
            for ask, query_id, q in zip(chunk["ask"], chunk["vec_id"], _matrix(chunk["v"], width)):
                out += [(ask, query_id, vec_id, score) for score, vec_id in index.search(q, query_id, k)]
        return pd.DataFrame(out, columns=["ask", "query_id", "vec_id", "score"])

    ship_package(vectors.sparkSession)
    # cells are work, not bytes: their number is given, so that small ones are not put together
    dealt = [side.repartition(blocks * chunks, "block", "chunk").groupBy("block", "chunk") for side in (candidates, asking)]
    found = dealt[0].cogroup(dealt[1]).applyInPandas(run, "ask long, query_id long, vec_id long, score long")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
