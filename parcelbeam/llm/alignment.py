"""Alignment of two tokenizers' tokens over the same bytes (op 12).

Every text is tokenized by both.  The cumulative byte ends of each side's tokens become a dictionary
from end to index; ends that both have, found by intersecting the dictionaries' keys and sorted, cut
both id lists into groups.  Links, the pairs of tokens with overlapping bytes, are expanded inside
each group.  A side's bytes must spell a space and the text, else the text has no tokens.

No token of either side runs across a single space between two other characters (the byte-level side
splits there, the other has no such piece, which is checked when it is loaded).  So tokens of both
end before each such space, a text's groups are those of its chunks between these places one after
the other, and a worker aligns a chunk once and remembers it as long as its memo holds it.

The written result of that one pass feeds the counts.  An id pair's count is the number of documents
that hold it, added up per task before the shuffle.  Pairs that many documents hold, at most
``HELD`` by the way the bound on their count is chosen, are broadcast with their counts and meet the
documents' links without a shuffle; the rest meet them in a shuffle join, in which no key has more
rows than that bound.  What comes back is one row of sums per document.

Edge cases: texts that are null, empty, or that a tokenizer does not spell as they are (such as those
with U+2581, or with bytes that are no UTF-8) have zeros and an empty groups_sha256; null ids and
repeated rows are kept, each row counting as a document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.byte_codec import ChunkMemo, RunEncoder, chunk_ends
from parcelbeam.llm.common import byte_slices, drop_written, map_batches, written
from parcelbeam.llm.token_counts import byte_symbols

#: Bytes of text that a worker aligns at a time.
SLICE = 1_000_000
#: Most id pairs that are broadcast with their counts.
HELD = 1_000_000
LINE_MARK = "▁"

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, pairs array<long>, times array<int>"


#: Where chunks begin, for texts in which white space stands beside a space.
CHUNK_START = re.compile(r"(?<=\S)(?= \S)")
UNEVEN = re.compile(r"\s |(?<=.) \s| \Z", re.DOTALL)


class ByteLevelSide:
    """Ids and token bytes of a byte-level vocabulary (a tokenizers file)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        value = {c: b for b, c in enumerate(byte_symbols())}
        self.bytes = [b""] * (max(tokenizer.get_vocab().values()) + 1)
        for entry, i in tokenizer.get_vocab().items():
            # entries beside the byte-level ones (special tokens) stand for their own text
            self.bytes[i] = bytes(map(value.__getitem__, entry)) if all(c in value for c in entry) else entry.encode()
        self.lengths = np.array(list(map(len, self.bytes)), dtype=np.int64)
        self.encoder = RunEncoder(tokenizer, self.lengths)


class PieceSide:
    """Ids and token bytes of a sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = list(map(self.model.id_to_piece, range(self.model.get_piece_size())))
        self.bytes = [bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(LINE_MARK, " ").encode()
                      for i, piece in enumerate(pieces)]
        self.lengths = np.array(list(map(len, self.bytes)), dtype=np.int64)
        #: no piece goes on with a space after another character
        self.splits = not any(LINE_MARK in piece.lstrip(LINE_MARK) for piece in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of chunks, each with its space."""
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def ends(ids: np.ndarray, lengths: np.ndarray) -> dict[int, int]:
    """Cumulative byte end of each token, ascending -> how many tokens end by there."""
    return dict(zip(np.cumsum(lengths[ids]).tolist(), range(1, len(ids) + 1)))


def align(a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group ends, as numbers of tokens of either side up to there, and the linked pairs (A's id in
    the upper 32 bits) with the number of their group, ascending."""
    a_ends, b_ends = ends(a, a_lengths), ends(b, b_lengths)
    common = sorted(a_ends.keys() & b_ends.keys())
    a_cuts = np.fromiter(map(a_ends.__getitem__, common), np.int64, len(common))
    b_cuts = np.fromiter(map(b_ends.__getitem__, common), np.int64, len(common))
    a_counts, b_counts = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    a_group, b_group = np.repeat(np.arange(len(common)), a_counts), np.repeat(np.arange(len(common)), b_counts)
    # groups with one token on a side: it is linked with every token on the other
    of_b = (a_counts == 1)[b_group]
    of_a = ((b_counts == 1) & (a_counts > 1))[a_group]
    pairs = [(a[a_cuts - 1][b_group[of_b]] << 32) | b[of_b], (a[of_a] << 32) | b[b_cuts - 1][a_group[of_a]]]
    groups = [b_group[of_b], a_group[of_a]]
    more, of = [], []
    for g in np.flatnonzero((a_counts > 1) & (b_counts > 1)).tolist():
        left, right = a[a_cuts[g] - a_counts[g]:a_cuts[g]].tolist(), b[b_cuts[g] - b_counts[g]:b_cuts[g]].tolist()
        # side by side, going on with the token that ends first; none end together inside
        p = q = 0
        p_end, q_end = a_lengths[left[0]], b_lengths[right[0]]
        while True:
            more.append((left[p] << 32) | right[q])
            of.append(g)
            if p_end < q_end:
                p += 1
                p_end += a_lengths[left[p]]
            elif q_end < p_end:
                q += 1
                q_end += b_lengths[right[q]]
            else:
                break
    pairs.append(np.array(more, dtype=np.int64))
    groups.append(np.array(of, dtype=np.int64))
    group = np.concatenate(groups)
    order = np.argsort(group, kind="stable")
    return a_cuts, b_cuts, np.concatenate(pairs)[order], group[order]


@lru_cache(maxsize=1)
def decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of the numbers below ``size``, left-aligned with a free place at the end, and
    how many digits each has."""
    numbers = np.char.mod("%d", np.arange(size)).astype("S")
    width = numbers.dtype.itemsize
    digits = np.zeros((size, width + 1), dtype=np.uint8)
    digits[:, :width] = numbers.view(np.uint8).reshape(size, width)
    return digits, (digits > 0).sum(axis=1)


def group_text(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, size: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids (below ``size``) of each group's two sides."""
    if not len(a_cuts):
        return b""
    digits, lengths = decimal_table(size)
    # a token comes after all tokens of earlier groups, and B's after A's of its own
    place_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], b_cuts[:-1]]), np.diff(a_cuts, prepend=0))
    place_b = np.arange(len(b)) + np.repeat(a_cuts, np.diff(b_cuts, prepend=0))
    ids = np.empty(len(a) + len(b), dtype=np.int64)
    ids[place_a], ids[place_b] = a, b
    after = np.full(len(ids), ord(","), dtype=np.uint8)
    after[place_a[a_cuts - 1]] = ord("|")
    after[place_b[b_cuts - 1]] = ord(";")
    rows, stops = digits[ids], lengths[ids]
    rows[np.arange(len(ids)), stops] = after
    return rows[np.arange(rows.shape[1]) <= stops[:, None]].tobytes()[:-1]


def spelled(side: ByteLevelSide | PieceSide, ids: np.ndarray) -> bytes:
    """The bytes that a side's ids stand for."""
    return b"".join(map(side.bytes.__getitem__, ids.tolist()))


#: An aligned chunk: tokens of A and of B, groups, the groups as text, and its links' id pairs (A's
#: id in the upper 32 bits) as 64-bit numbers.
Part = tuple[int, int, int, str, bytes]


class Aligner:
    """Aligned texts under one pair of tokenizers; ``UNSPELLED`` stands for a chunk whose bytes one
    of them does not give back."""

    UNSPELLED: Part = (0, 0, 0, "", b"")

    def __init__(self, a: str, b: str):
        self.first, self.second = ByteLevelSide(a), PieceSide(b)
        self.size = max(len(self.first.bytes), len(self.second.bytes))
        self.memo = ChunkMemo(self.parts, lambda part: 100 + len(part[3]) + len(part[4]))

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut before each single space between two other characters."""
        if not self.second.splits:
            return [" " + text]
        if UNEVEN.search(text) or text[:1].isspace():
            return CHUNK_START.split(" " + text)
        return [" " + part for part in text.split(" ")]

    def parts(self, chunks: list[str]) -> list[Part]:
        """Each chunk aligned; chunks are worked on in runs, as one text whose tokens end with them."""
        out = [self.UNSPELLED] * len(chunks)
        pieces = self.second.encode(chunks)
        for run, a, a_stops in self.first.encoder.encode(chunks):
            own = [chunks[i] for i in run]
            b = np.fromiter(itertools.chain.from_iterable([pieces[i] for i in run]), np.int64)
            b_stops = np.cumsum([len(pieces[i]) for i in run])
            if self.spells(own, a, a_stops, b, b_stops):
                for i, part in zip(run, self.run_parts(a.astype(np.int64), a_stops, b, b_stops)):
                    out[i] = part
            elif len(run) > 1:  # at least one of them is not spelled: each by itself
                for i in run:
                    out[i] = self.parts([chunks[i]])[0]
        return out

    def spells(self, chunks: list[str], a: np.ndarray, a_stops: np.ndarray, b: np.ndarray, b_stops: np.ndarray) -> bool:
        """Whether both sides give back the bytes of every chunk."""
        data, stops = "".join(chunks).encode(), chunk_ends(chunks)
        for side, ids, last in ((self.first, a, a_stops), (self.second, b, b_stops)):
            reached = np.concatenate([[0], np.cumsum(side.lengths[ids])])
            if last[-1] != len(ids) or (reached[last] != stops).any() or spelled(side, ids) != data:
                return False
        return True

    def run_parts(self, a: np.ndarray, a_stops: np.ndarray, b: np.ndarray, b_stops: np.ndarray) -> Iterator[Part]:
        a_cuts, b_cuts, links, group = align(a, b, self.first.lengths, self.second.lengths)
        texts = group_text(a, b, a_cuts, b_cuts, self.size).decode().split(";")
        last = np.searchsorted(a_cuts, a_stops) + 1  # groups up to each chunk's end
        data, pairs = links.tobytes(), [0, *(np.searchsorted(group, last) * 8).tolist()]
        groups = [0, *last.tolist()]
        for n_a, n_b, g, g_end, p, p_end in zip(np.diff(a_stops, prepend=0).tolist(), np.diff(b_stops, prepend=0).tolist(),
                                                groups, groups[1:], pairs, pairs[1:]):
            yield n_a, n_b, g_end - g, ";".join(texts[g:g_end]), data[p:p_end]

    def align(self, texts: list[str]) -> Iterator[list[Part]]:
        """The parts of each text, none where it is empty or not spelled."""
        for parts in self.memo.look_up([self.chunks(t) if t else [] for t in texts]):
            yield [] if self.UNSPELLED in parts else parts


@lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    """One aligner per worker process and pair of tokenizers."""
    return Aligner(a, b)


def aligned(docs: DataFrame, a: str, b: str, keep_groups: bool = False) -> DataFrame:
    """Per document the counts, the groups (as text if kept) with their sha256, and its different
    linked id pairs (A's id in the upper 32 bits) with how often they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a, b)
        for batch in byte_slices(batches, 1, SLICE):
            raw = [t or b"" for t in batch.column(1).to_pylist()]
            texts = [t.decode("utf-8", "replace") for t in raw]
            rows = []
            for data, text, parts in zip(raw, texts, own.align(texts)):
                if text.encode() != data:  # no UTF-8
                    parts = []
                n_a, n_b, n_groups, groups, links = zip(*parts) if parts else ((), (), (), (), ())
                groups, links = ";".join(groups), np.frombuffer(b"".join(links), np.int64)
                pairs, times = np.unique(links, return_counts=True)
                rows.append((sum(n_a), sum(n_b), sum(n_groups), len(links), groups if keep_groups else None,
                             hashlib.sha256(groups.encode()).hexdigest() if parts else "", pairs, times))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.record_batch([batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                                  names=[c.split()[0] for c in ALIGNED.split(", ")])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return map_batches(source, run, ALIGNED)


def with_best(counts: DataFrame) -> DataFrame:
    """Counts of id pairs, with whether a pair's count is its A id's highest.

    The highest counts are one row per A id, so the vocabulary bounds what is broadcast."""
    a_id = F.shiftright("pair", 32)
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a_id", a_id).join(F.broadcast(highest), "a_id").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    base = written(aligned(docs, a, b).drop("groups").withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = base.select("row", F.inline(F.arrays_zip("pairs", "times"))).select(
        "row", F.col("pairs").alias("pair"), "times")
    pair_docs = written(links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-docs")
    counts = with_best(pair_docs)
    n, held_by = pair_docs.agg(F.count("*"), F.coalesce(F.sum("docs"), F.lit(0))).first()
    # at most held_by / bound pairs can have that many documents
    bound = 1 if n <= HELD else -(-held_by // HELD)
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).cast("long").alias("count_sum")]
    frequent = F.broadcast(counts.filter(F.col("docs") >= bound))
    per_row = links.join(frequent, "pair").groupBy("row").agg(*sums)
    if bound > 1:
        rare = links.join(frequent.select("pair"), "pair", "left_anti").join(counts.filter(F.col("docs") < bound), "pair")
        per_row = per_row.unionByName(rare.groupBy("row").agg(*sums)).groupBy("row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    result = base.drop("pairs", "times").join(per_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    report = written(result, "alignment")
    for table in (base, pair_docs):
        drop_written(spark, table)
    return report
