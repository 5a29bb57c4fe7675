"""Byte-level BPE encoding and decoding (op 11).

The tokenizers library encodes texts batch by batch.  A rank file holds byte strings and no merges:
each entry of two and more bytes gets the one pair that lowest-rank-first merging of its own bytes
ends with, and the pairs are ordered by the entry's rank.  A merge of a text can only ever be one of
these: while both parts stand side by side, nothing outside has reached into the entry's bytes, so
they were merged as in the entry alone.

A match of the splitting pattern may begin with a single space between two other characters but
does not run across it, and a single line break there is a match of its own.  So a text's ids are
those of its chunks between such places.  Chunks repeat a great deal; each
worker remembers them up to ``MEMO_BYTES``, and the library gets all new ones of a slice in one call.

Token ends in bytes come from the entries' lengths; the byte-to-character mapping turns them into
character offsets.  A token that begins or ends inside a character spans that whole character.
Decoding joins the entries' bytes; text is decoded from all bytes of a document at once, so
characters split between tokens come out whole.

One Arrow pass encodes and another decodes; nothing is shuffled, and a lost task is simply run again.

Edge cases: a null or empty text has no tokens and decodes to no bytes; bytes that are no UTF-8 are
read as replacement characters; special tokens written in a text are ordinary text; null ids and
repeated rows are kept; an id that the vocabulary lacks decodes to the replacement character.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import byte_slices, map_batches
from parcelbeam.llm.token_counts import byte_symbols

#: Bytes of chunks and ids that a worker remembers, and of text that it encodes at a time.
MEMO_BYTES = 128_000_000
SLICE = 4_000_000
#: What a dictionary entry takes besides the chunk and its ids.
ENTRY = 200
#: New chunks that the library gets as one text.
RUN = 500
UNKNOWN = "�".encode()

#: Where chunks begin, for texts in which white space stands beside white space or at an end.
CHUNK_START = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
UNEVEN = re.compile(r"\s\s|^[^\S ]|\s\Z")


def chunks(text: str) -> list[str]:
    """The text cut before each single space and around each single line break that stand between
    two other characters."""
    if UNEVEN.search(text):
        return CHUNK_START.split(text)
    out = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        out += ["\n", first] if first else ["\n"]
        out += [" " + part for part in rest]
    return out[1:]


class ChunkMemo:
    """What ``compute`` makes of chunks, remembered up to ``MEMO_BYTES``.

    The memo has two generations: when the younger one is full it becomes the older one, which
    chunks that occur again leave for the new younger one."""

    def __init__(self, compute: Callable[[list[str]], list], size: Callable[[object], int]):
        self.compute, self.size = compute, size
        self.memo: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.held = 0

    def look_up(self, parts: list[list[str]]) -> list[list]:
        """The values of each list of chunks."""
        found = [list(map(self.memo.get, p)) for p in parts]
        lacking = [i for i, values in enumerate(found) if None in values]
        if lacking:
            self.learn(dict.fromkeys(c for i in lacking for c, value in zip(parts[i], found[i]) if value is None))
            for i in lacking:
                found[i] = list(map(self.memo.__getitem__, parts[i]))
            if self.held > MEMO_BYTES // 2:
                self.memo, self.older, self.held = {}, self.memo if self.held <= MEMO_BYTES else {}, 0
        return found

    def learn(self, new: dict[str, None]) -> None:
        known = {c: self.older.pop(c) for c in new if c in self.older}
        unknown = [c for c in new if c not in known] if known else list(new)
        known.update(zip(unknown, self.compute(unknown)))
        self.memo.update(known)
        self.held += ENTRY * len(known) + 4 * sum(map(len, known)) + sum(map(self.size, known.values()))


class RunEncoder:
    """Ids of chunks under a byte-level tokenizer of the library, whose entries have ``lengths``
    bytes."""

    def __init__(self, tokenizer, lengths: np.ndarray):
        self.tokenizer, self.lengths = tokenizer, lengths

    def encode(self, chunks: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Runs of chunks: their places, their ids one after the other, and how many ids end with
        each of them."""
        # chunks that begin with the space they were cut at may follow each other in one text
        fits = [len(c) > 1 and c[0] == " " and not c[1].isspace() and not c[-1].isspace() for c in chunks]
        joint = [i for i, fit in enumerate(fits) if fit]
        runs = [joint[i:i + RUN] for i in range(0, len(joint), RUN)] + [[i] for i, fit in enumerate(fits) if not fit]
        texts = ["".join([chunks[i] for i in run]) for run in runs]
        for run, encoding in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoding.ids, dtype=np.uint32)
            stops = np.searchsorted(np.cumsum(self.lengths[ids]), chunk_ends([chunks[i] for i in run])) + 1
            yield run, ids, stops

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk."""
        out: list[bytes] = [b""] * len(chunks)
        for run, ids, stops in self.encode(chunks):
            data, at = ids.astype("<u4").tobytes(), [0, *(stops * 4).tolist()]
            for i, start, end in zip(run, at, at[1:]):
                out[i] = data[start:end]
        return out


def chunk_ends(chunks: list[str]) -> np.ndarray:
    """Where each chunk ends in bytes, when they stand one after the other."""
    return np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])


class ChunkEncoder:
    """Ids of whole texts, chunk by chunk."""

    def __init__(self, tokenizer, lengths: np.ndarray):
        self.chunks = ChunkMemo(RunEncoder(tokenizer, lengths).ids_of, len)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(ids) for ids in self.chunks.look_up([chunks(t) for t in texts])]


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string to rank, from a file of base64 strings and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in f if line.strip())}


def last_pair(entry: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts left when an entry's bytes are merged lowest rank first, the entry itself
    aside; None where its bytes do not get that far."""
    parts = [entry[i:i + 1] for i in range(len(entry))]
    while len(parts) > 2:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            return None
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class ByteCodec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = pattern
        self.table = [UNKNOWN] * (max(self.ranks.values(), default=-1) + 1)
        for entry, rank in self.ranks.items():
            self.table[rank] = entry
        self.lengths = np.array([len(b) for b in self.table], dtype=np.int64)

    @cached_property  # decoding alone needs no tokenizer
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        symbols = byte_symbols()
        spelled = {b: "".join(symbols[x] for x in b) for b in self.ranks}
        pairs = (last_pair(b, self.ranks) for b in sorted(self.ranks, key=self.ranks.get) if len(b) > 1)
        tokenizer = Tokenizer(models.BPE(
            vocab={spelled[b]: r for b, r in self.ranks.items()},
            merges=[(spelled[p[0]], spelled[p[1]]) for p in pairs if p],
            ignore_merges=True))  # a match that is an entry as a whole is that entry
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(self.pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return tokenizer

    @cached_property
    def encoder(self) -> ChunkEncoder:
        return ChunkEncoder(self.tokenizer, self.lengths)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return self.encoder.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian 32-bit ids."""
        known, table = len(self.table), self.table
        return b"".join(table[i] if i < known else UNKNOWN for i in np.frombuffer(ids, "<u4").tolist())

    def offsets(self, ids: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last, per token of an encoded text."""
        ends = np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1] + 1


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteCodec:
    """One codec per worker process and vocabulary."""
    return ByteCodec(path, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, offsets: bool = False) -> DataFrame:
    """Per document: doc_id, ids (little-endian unsigned 32-bit integers as binary) and, if asked
    for, starts and ends (character offsets per token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in byte_slices(batches, 1, SLICE):
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            ids = own.encode(texts)
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            if offsets:
                spans = [own.offsets(i, t.encode()) for i, t in zip(ids, texts)]
                columns += [pa.array([s[side] for s in spans], pa.list_(pa.int32())) for side in (0, 1)]
            yield pa.record_batch(columns, names=["doc_id", "ids", "starts", "ends"][:len(columns)])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return map_batches(source, run, "doc_id long, ids binary" + (", starts array<int>, ends array<int>" if offsets else ""))


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per row of doc_id and ids: doc_id, ids, decoded (bytes).  Null ids decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in byte_slices(batches, 1, SLICE):
            texts = [None if ids is None else own.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                                  names=["doc_id", "ids", "decoded"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary")


def text_of(decoded: Column) -> Column:
    """Decoded bytes as text; a character cut off at an end (of a part of a document's ids) is
    replaced."""
    return F.make_valid_utf8(decoded.cast("string"))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(docs, vocabulary, pattern), vocabulary, pattern)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
