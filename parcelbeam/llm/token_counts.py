"""Token counts by byte-pair merging, without identifiers (op 10).

A piece of text starts as its bytes; the adjacent pair of lowest rank is merged until no ranked
pair is left.  A heap holds the candidate pairs and a linked list the symbols, so a piece of n
bytes takes O(n log n); its count is n minus the merges made.

White space never lies inside a piece, so a text's count is the sum over its white-space
separated chunks.  Chunks repeat a great deal and are remembered per Python worker, up to
``MEMO`` of them.  The work is one Arrow pass over the documents, without a shuffle.

Edge cases: a null or empty text has 0 bytes and 0 tokens; special tokens written in a text count
as one token each, as the vocabulary file says; null ids and repeated rows are kept.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import map_batches

MEMO = 1_000_000
LIMIT = 2048


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    kept = set(plain)
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of byte strings under one vocabulary file (a mapping from chunk to count)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.symbols = byte_symbols()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        from tokenizers import normalizers
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        self.lower = "Lowercase" in steps
        self.steps = [kind() for name, kind in (("NFC", normalizers.NFC), ("Lowercase", normalizers.Lowercase)) if name in steps]
        self.memo: dict[bytes, int] = {}

    def piece_tokens(self, piece: str) -> int:
        """Heap and linked list: pop the lowest-ranked live pair, join it, look at its new neighbours."""
        symbols = [self.symbols[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks = self.ranks
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = left + right, ""
            count -= 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (r := ranks.get((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(heap, (r, a, symbols[a], symbols[b]))
        return count

    def plain_tokens(self, text: str) -> int:
        if text.isascii():
            text = text.lower() if self.lower else text
        else:  # the library's own tables: Python's may be of another Unicode version
            for step in self.steps:
                text = step.normalize_str(text)
        return sum(self.piece_tokens(p) for p in self.pieces.findall(text))

    def chunk_tokens(self, chunk: bytes) -> int:
        n = self.memo.get(chunk)
        if n is None:
            text = chunk.decode()
            if self.special and (found := self.special.findall(text)):
                n = len(found) + sum(map(self.plain_tokens, self.special.split(text)))
            else:
                n = self.plain_tokens(text)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[chunk] = n
        return n

    def count(self, text: bytes) -> int:
        """Tokens of a UTF-8 text.  bytes.split() cuts at ASCII white space only."""
        return sum(map(self.chunk_tokens, text.split()))


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter per worker process and vocabulary."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            counts = [own.count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                         F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = map_batches(source, run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
