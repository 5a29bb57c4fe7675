"""Toxicity from the nearest labelled examples (op 6).

The terms of a text are its words and their first ``PREFIX`` letters.  From a bounded sample of
labelled training documents (``MAX_EXAMPLES``, the only bound on what is learnt from) the terms
that depend on the label are selected; each example becomes a TF-IDF vector of unit length over
them.  The examples' inverted index is cut into blocks that know the largest weight of each term.
A text visits the blocks by descending bound and stops when no block can hold a nearer example,
so its neighbours are exact.  Votes weighted by cosine, pulled to the base rate, give the score;
the neighbours are the evidence.

Edge cases: a null, empty or featureless text gets the base rate; without labelled training
documents the score is 0; null labels are ignored; of repeated labels for one id the larger
counts; ties between examples go to the earlier one in id order.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import checkpointed, held_out, map_batches

FOLDS = 5
MAX_EXAMPLES = 16_000
MAX_TERMS = 4096
#: Least chi-squared of a selected term: a significance of one in a million, whatever the number of examples
#: and the share of toxic ones.
MIN_DEPENDENCE = 23.93
MIN_DOCS = 5
PREFIX = 5
BLOCK = 64
NEIGHBOURS = 15
#: Weight of the base rate among the votes.
PULL = 0.15
#: Runs of letters and digits.
WORD = re.compile(r"[^\W_]+")


def terms(text: str | None) -> Counter:
    """Words and word beginnings (marked by *) of a text, lower-cased, and how often they come."""
    words = Counter(WORD.findall((text or "").lower()))
    out = Counter(words)
    for w, n in words.items():
        if len(w) > PREFIX:
            out[w[:PREFIX] + "*"] += n
    return out


def examples(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """Up to ``limit`` labelled training documents, the first by hash of id: doc_id, toxic, terms,
    counts (of the terms)."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # bounded: broadcast below
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([list(c) for c in found], pa.list_(pa.string())),
                                   pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], names=["doc_id", "toxic", "terms", "counts"])

    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    return map_batches(sample, run, "doc_id long, toxic int, terms array<string>, counts array<long>")


def select_terms(sample: DataFrame, n: int, toxic: int) -> list[tuple[str, int]]:
    """The terms that depend most on the label (chi-squared over documents), and their counts.

    Only terms that speak for toxicity are taken: what speaks against it is everything else."""
    counted = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("bad"))
    a, b = F.col("bad").cast("double"), (F.col("n") - F.col("bad")).cast("double")
    c, d = F.lit(float(toxic)) - a, F.lit(float(n - toxic)) - b
    chi = n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    best = counted.withColumn("chi", F.when((a * d > b * c) & (F.col("n") >= MIN_DOCS), chi)).filter(
        F.col("chi") >= MIN_DEPENDENCE).orderBy(F.desc("chi"), "term").limit(MAX_TERMS)
    return [(r["term"], r["n"]) for r in best.collect()]


@dataclass
class Index:
    """Postings by term over the examples, and the largest weight per term and block."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    starts: np.ndarray
    members: np.ndarray
    weights: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_max: np.ndarray
    labels: np.ndarray
    doc_ids: np.ndarray
    base: float

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(sorted(counts), dtype=np.int64)
        w = np.array([(1 + math.log(counts[i])) * self.idf[i] for i in ids])
        return ids, w / np.sqrt((w * w).sum()) if len(w) else w

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0, as (cosine, example), nearest first."""
        n_blocks = -(-len(self.labels) // BLOCK)
        gather = lambda starts, values: [values[starts[t]:starts[t + 1]] for t in ids]
        spread = lambda starts, values: np.concatenate([v * w for v, w in zip(gather(starts, values), weights)])
        bound = np.bincount(np.concatenate(gather(self.block_starts, self.blocks)), spread(self.block_starts, self.block_max), n_blocks)
        members, gains = np.concatenate(gather(self.starts, self.members)), spread(self.starts, self.weights)
        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound)]
        found: list[tuple[float, int]] = []
        done, step = 0, 4
        while done < len(order):
            if len(found) == k and -found[-1][0] > bound[order[done]] + 1e-9:
                break  # proof: no example of this block or of any later one can enter
            visit = np.zeros(n_blocks, dtype=bool)
            visit[order[done:done + step]] = True
            mine = visit[members // BLOCK]
            sums = np.bincount(members[mine], gains[mine], len(self.labels))
            hits = np.flatnonzero(sums)
            best = hits[np.lexsort((hits, -sums[hits]))][:k]
            found = sorted(found + [(-sums[h], int(h)) for h in best])[:k]
            done, step = done + step, step * 4
        return [(-c, e) for c, e in found]

    def score(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        """Cosine-weighted votes with the base rate, and the neighbours' ids."""
        if not counts:
            return self.base, []
        near = self.nearest(*self.vector(counts))
        vote = sum(c * self.labels[e] for c, e in near)
        total = sum(c for c, _ in near)
        return (vote + PULL * self.base) / (total + PULL), [int(self.doc_ids[e]) for _, e in near]


def build_index(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> Index | None:
    """The index over the sample; its size is bounded by ``limit`` and ``MAX_TERMS``."""
    sample = checkpointed(examples(docs, labels, limit))
    n, toxic = sample.agg(F.count("*"), F.sum((F.col("toxic") > 0).cast("long"))).first()
    if not n:
        return None
    chosen = select_terms(sample, n, toxic or 0)
    vocabulary = {t: i for i, (t, _) in enumerate(chosen)}
    idf = np.array([math.log((1 + n) / (1 + c)) + 1 for _, c in chosen])
    # what the driver gets is bounded too: the chosen terms of at most ``limit`` documents
    long = sample.select("doc_id", "toxic", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("doc_id", "toxic", "t.terms", "t.counts")
    names = docs.sparkSession.createDataFrame([(t,) for t in vocabulary], "terms string")
    rows = long.join(F.broadcast(names), "terms").groupBy("doc_id", "toxic").agg(
        F.map_from_entries(F.collect_list(F.struct("terms", "counts"))).alias("terms")).orderBy("doc_id").collect()
    index = Index(vocabulary, idf, *[np.zeros(0)] * 6, np.array([int(r["toxic"] > 0) for r in rows]),
                  np.array([r["doc_id"] for r in rows]), (toxic or 0) / n)
    postings: list[list[tuple[int, float]]] = [[] for _ in chosen]
    for e, r in enumerate(rows):
        for t, w in zip(*index.vector({vocabulary[t]: n for t, n in r["terms"].items()})):
            postings[t].append((e, w))
    index.starts = np.cumsum([0] + [len(p) for p in postings])
    index.members = np.array([e for p in postings for e, _ in p], dtype=np.int64)
    index.weights = np.array([w for p in postings for _, w in p])
    tops: list[dict[int, float]] = []
    for p in postings:
        top: dict[int, float] = {}
        for e, w in p:
            top[e // BLOCK] = max(top.get(e // BLOCK, 0.0), w)
        tops.append(top)
    index.block_starts = np.cumsum([0] + [len(t) for t in tops])
    index.blocks = np.array([b for t in tops for b in t], dtype=np.int64)
    index.block_max = np.array([w for t in tops for w in t.values()])
    return index


def score_documents(docs: DataFrame, index: Index | None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, evidence (ids of the neighbours)."""
    vocabulary = index.vocabulary if index else {}
    whole = {t: i for t, i in vocabulary.items() if not t.endswith("*")}
    starts = {t[:-1]: i for t, i in vocabulary.items() if t.endswith("*")}

    def chosen(text: str | None) -> dict[int, int]:
        """Counts of the vocabulary's terms in a text (as by ``terms``, without making the others)."""
        out: dict[int, int] = {}
        for w, n in Counter(WORD.findall((text or "").lower())).items():
            for i in (whole.get(w), starts.get(w[:PREFIX]) if len(w) > PREFIX else None):
                if i is not None:
                    out[i] = out.get(i, 0) + n
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = [index.score(chosen(t)) if index else (0.0, []) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([s for s, _ in scored], pa.float64()),
                                   pa.array([e for _, e in scored], pa.list_(pa.int64()))],
                                  names=["doc_id", "score", "evidence"])

    scored = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                         "doc_id long, score double, evidence array<long>")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def toxicity_report(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    return score_documents(docs, build_index(docs, labels, limit))
