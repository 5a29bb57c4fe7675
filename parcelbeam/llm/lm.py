"""Interpolated modified Kneser-Ney bigram model (op 8).

Spark counts the corpus: words first, then word pairs, added up per task before they are
shuffled and dealt into shards by their first word; pairs of very frequent first words are dealt by
both words, so no word makes a shard large.  Each shard is written to the shared folder as a sorted array of pair hashes
with counts, each slice of the vocabulary as a sorted array of word hashes with its smoothing
terms.  Workers memory-map the arrays and look whole batches up by binary search.

p(w | u) = max(c(uw) - D(c(uw)), 0) / c(u.) + g(u) p1(w),  g(u) = (D1 N1(u.) + D2 N2(u.) + D3 N3+(u.)) / c(u.)
p1(w) = max(k(w) - E(k(w)), 0) / K + h / (V + 1),  h = (E1 M1 + E2 M2 + E3 M3+) / K

k(w) is the number of different words before w, K their sum; D and E are the modified
discounts 1, 2, 3+ from the counts of counts; V + 1 leaves a share for unseen words.  The first
word of a text follows a mark of its own, and an end token closes each text.

Edge cases: a null or empty text is its end token alone; without training texts every token has
the probability 1; null ids count as training; repeated rows count each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import held_out, map_batches, map_groups, shared_folder, written
from parcelbeam.llm.hashing import mix, word_hashes
from parcelbeam.llm.store import Store, distinct_runs, look_up

FOLDS = 10
BEGIN, END = np.uint64(0x5BE6), np.uint64(0xE4D)
#: Tokens gathered by a task before they are counted and sent on.
GATHER = 2_000_000
#: Bytes of text that a task hashes at a time.
SLICE = 2_000_000
#: Pairs aimed at per shard, and words per slice of the vocabulary.
SHARD_PAIRS = 1_000_000
SLICE_WORDS = 500_000
MIX_PAIR = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the texts, each closed by END; the hash before each; tokens per text."""
    words, counts = word_hashes(texts)
    w = np.insert(words, np.cumsum(counts), END) if len(counts) else words
    counts = counts + 1
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[np.cumsum(counts) - counts] = BEGIN
    return u, w, counts


def pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(u) * MIX_PAIR + w)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (u, w) of the texts, some ``GATHER`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        texts = batch.column(0)
        at = 0
        while at < len(texts):  # a slice of texts of bounded length at a time
            to, n = at, 0
            while to < len(texts) and n < SLICE:
                n += len(texts[to].as_py() or b"") + 1
                to += 1
            u, w, _ = tokens(texts.slice(at, to - at).to_pylist())
            held.append((u, w))
            size += len(w)
            at = to
            if size >= GATHER:
                yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                held, size = [], 0
    if size:
        yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and, for each of the value arrays, the sums per key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = distinct_runs(keys)
    return keys[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values]


WORD = np.dtype([("raw", "<f8"), ("p1", "<f8"), ("total", "<f8"), ("back", "<f8")])


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"), FOLDS)).select(F.col("text").cast("binary"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), raw (its count) over the training texts, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w in _gathered(batches):
            words, counts = np.unique(w, return_counts=True)
            yield pa.record_batch([pa.array(_signed(words)), pa.array(counts.astype(np.int64))], names=["word", "raw"])

    return map_batches(training(docs), run, "word long, raw long").groupBy("word").agg(F.sum("raw").alias("raw"))


def pair_shards(docs: DataFrame, shards: int, hot: list[int]) -> DataFrame:
    """Per task and shard one row: the sorted pairs and their counts, as bytes."""
    hot_words = np.sort(np.array([BEGIN, *np.array(hot, dtype=np.int64).view(np.uint64)], dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, w in _gathered(batches):
            order = np.lexsort((w, u))
            u, w = u[order], w[order]
            first = distinct_runs(u, w)
            n = np.diff(np.append(first, len(u))).astype("<u4")
            u, w = u[first], w[first]
            spread = hot_words[np.minimum(np.searchsorted(hot_words, u), len(hot_words) - 1)] == u
            shard = (np.where(spread, pair_keys(u, w), mix(u)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = [order[a:b] for a, b in zip(ends[:-1], ends[1:])]
            full = [k for k in range(shards) if len(rows[k])]
            runs = [np.flatnonzero(np.concatenate([[True], np.diff(u[rows[k]]) != 0])) for k in full]
            yield pa.record_batch([
                pa.array(full, pa.int32()),
                # the first words are sorted: each is sent once, with the length of its run
                pa.array([u[rows[k]][r].tobytes() for k, r in zip(full, runs)], pa.binary()),
                pa.array([np.diff(np.append(r, len(rows[k]))).astype("<u4").tobytes() for k, r in zip(full, runs)], pa.binary()),
                pa.array([w[rows[k]].tobytes() for k in full], pa.binary()),
                pa.array([n[rows[k]].tobytes() for k in full], pa.binary())], names=["shard", "u", "runs", "w", "n"])

    return map_batches(training(docs), run, "shard int, u binary, runs binary, w binary, n binary")


def write_pairs(sent: DataFrame, store: Store) -> DataFrame:
    """Write each shard; return what the vocabulary needs of it, in rows (word, total, n1, n2,
    n3, before): context totals and follower counts of first words, the number of different
    words before second words; and the shard's counts of counts under kind 1."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        u = np.concatenate([np.repeat(np.frombuffer(a, "<u8"), np.frombuffer(r, "<u4")) for a, r in zip(rows["u"], rows["runs"])])
        w = np.concatenate([np.frombuffer(x, "<u8") for x in rows["w"]])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in rows["n"]]).astype(np.int64)
        order = np.lexsort((w, u))
        u, w, n = u[order], w[order], n[order]
        first = distinct_runs(u, w)
        u, w, n = u[first], w[first], np.add.reduceat(n, first)
        keys = pair_keys(u, w)
        order = np.argsort(keys)
        shard = int(rows["shard"].iloc[0])
        store.write(f"pairs-{shard}", keys[order])
        store.write(f"counts-{shard}", np.minimum(n[order], 2 ** 32 - 1).astype("<u4"))
        contexts, total, n1, n2, n3 = _sums(u, n, *[(n == c).astype(np.int64) for c in (1, 2)], (n >= 3).astype(np.int64))
        seconds, before = _sums(w, np.ones(len(w), dtype=np.int64))
        zero = lambda x: np.zeros(len(x), dtype=np.int64)
        out = pd.concat([
            pd.DataFrame({"kind": np.int32(0), "word": _signed(contexts), "total": total, "n1": n1, "n2": n2, "n3": n3, "before": zero(total)}),
            pd.DataFrame({"kind": np.int32(0), "word": _signed(seconds), "total": zero(before), "n1": zero(before), "n2": zero(before),
                          "n3": zero(before), "before": before}),
            pd.DataFrame({"kind": np.int32([1]), "word": np.int64([0]), "total": [len(n)],
                          **{f"n{c}": [int((n == c).sum())] for c in (1, 2, 3)}, "before": [int((n == 4).sum())]})])
        return out

    return map_groups(sent, ["shard"], run, "kind int, word long, total long, n1 long, n2 long, n3 long, before long")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified discounts for counts 1, 2 and 3+; 0.5, 1, 1.5 where the counts of counts are too thin."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.1), c) for c, x in enumerate(d, start=1))


def write_vocabulary(words: DataFrame, slices: int, store: Store, d: tuple, e: tuple, k: float, back: float, v: int) -> DataFrame:
    """Write the slices of the vocabulary (by hash): word hashes, counts, p1, context terms."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        word = rows["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        col = {c: rows[c].to_numpy(dtype=np.float64)[order] for c in ("raw", "total", "n1", "n2", "n3", "before")}
        out = np.zeros(len(rows), WORD)
        cut = np.choose(np.clip(col["before"], 0, 3).astype(int), [0.0, *e])
        total = np.maximum(col["total"], 1)
        out["raw"], out["total"] = col["raw"], col["total"]
        out["p1"] = np.maximum(col["before"] - cut, 0) / max(k, 1) + back / (v + 1)
        out["back"] = np.where(col["total"] > 0, (d[0] * col["n1"] + d[1] * col["n2"] + d[2] * col["n3"]) / total, 1.0)
        name = int(rows["slice"].iloc[0])
        store.write(f"words-{name}", word[order])
        store.write(f"terms-{name}", out)
        return pd.DataFrame({"slice": np.int32([name])})

    sliced = words.withColumn("slice", F.pmod("word", F.lit(slices)).cast("int"))
    return map_groups(sliced, ["slice"], run, "slice int")


class Model:
    """A fitted model: a folder of arrays and a few numbers; picklable, arrays open on the workers."""

    def __init__(self, folder: str, pair_parts: list[int], word_parts: list[int], shards: int, slices: int,
                 hot: list[int], d: tuple, n: int, v: int, unseen: float):
        self.folder, self.shards, self.slices, self.hot, self.d = folder, shards, slices, hot, d
        self.pair_parts, self.word_parts, self.n, self.v, self.unseen = pair_parts, word_parts, n, v, unseen

    def score(self, texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, log10 probability."""
        u, w, counts = tokens(texts)
        words, where = np.unique(np.concatenate([w, [BEGIN]]), return_inverse=True)
        found = look_up(self.folder, (_signed(words) % self.slices).astype(np.int64), words, "words", {"terms": WORD}, self.word_parts)["terms"]
        # without a context every token gets p1; unseen words have the share left for them
        p1 = np.where(found["p1"] > 0, found["p1"], self.unseen)
        back = np.where(found["total"] > 0, found["back"], 1.0)
        at_w = where[:-1]
        starts = np.cumsum(counts) - counts
        at_u = np.empty_like(at_w)
        at_u[1:] = at_w[:-1]
        at_u[starts] = where[-1]
        pairs, pair_of = np.unique(pair_keys(u, w), return_inverse=True)
        one = np.zeros(len(pairs), dtype=np.int64)
        one[pair_of] = np.arange(len(u))
        hot = np.array([BEGIN, *np.array(self.hot, dtype=np.int64).view(np.uint64)], dtype=np.uint64)
        first = u[one]
        part = (np.where(np.isin(first, hot), pairs, mix(first)) % np.uint64(self.shards)).astype(np.int64)
        n = look_up(self.folder, part, pairs, "pairs", {"counts": "<u4"}, self.pair_parts)["counts"][pair_of].astype(np.float64)
        less = np.choose(np.clip(n, 0, 3).astype(int), [0.0, *self.d])
        total = found["total"][at_u]
        p = np.maximum(n - less, 0) / np.maximum(total, 1) + back[at_u] * p1[at_w]
        raw = found["raw"][at_w]
        base = np.log10((raw + 0.1) / (self.n + 0.1 * (self.v + 1)))
        per_text = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        return counts, per_text((raw > 0).astype(np.int64)), per_text(base), per_text(np.log10(p))


def fit(docs: DataFrame) -> Model:
    """Count the training texts and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    folder = shared_folder(spark, f"lm-{uuid.uuid4().hex}")
    store = Store(folder)
    raw = written(word_counts(docs), "words")
    n, v = raw.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-n // SHARD_PAIRS))
    # at most 8 * shards words can be that frequent
    hot = [r["word"] for r in raw.filter(F.col("raw") > n / (8 * shards)).select("word").collect()]
    found = written(write_pairs(pair_shards(docs, shards, hot), store), "counts")
    row = found.filter("kind = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "n1", "n2", "n3", "before")]).first()
    d = discounts(row["n1"], row["n2"], row["n3"], row["before"])
    columns = ("raw", "total", "n1", "n2", "n3", "before")
    padded = raw.select("word", "raw", *[F.lit(0).cast("long").alias(c) for c in columns[1:]])
    words = written(found.filter("kind = 0").select("word", F.lit(0).cast("long").alias("raw"), *columns[1:])
                         .unionByName(padded).groupBy("word").agg(*[F.sum(c).alias(c) for c in columns]), "vocabulary")
    b = F.col("before")
    k, *m = words.agg(F.coalesce(F.sum(b), F.lit(0)), *[F.count_if(b == c) for c in (1, 2, 3, 4)], F.count_if(b >= 3)).first()
    e = discounts(*m[:4])
    back = (e[0] * m[0] + e[1] * m[1] + e[2] * m[4]) / max(k, 1) if k else 1.0
    slices = max(1, -(-v // SLICE_WORDS))
    parts = [r["slice"] for r in write_vocabulary(words, slices, store, d, e, float(k), back, v).collect()]
    return Model(folder, list(range(shards)) if n else [], sorted(parts), shards, slices, hot, d, n, v, back / (v + 1))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                counts, known, base, score = model.score(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(counts.astype(np.int64)), pa.array(known.astype(np.int64)),
                                       pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                                      names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    scored = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")),
                         run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
