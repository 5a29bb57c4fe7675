"""Best-fit packing by swap-based local search (op 3).

Documents become pieces of at most ``CAPACITY`` tokens.  Pieces are dealt at random into groups
of bounded size; a group is packed by best fit and improved by moving a document, exchanging one
for one, or two for one, between underfull bins whenever the sum of squared fills grows, until
bins fall empty.  Bins that stay poorly filled are packed again together in a second round.

Only piece lengths are shuffled, never texts or ids.  Edge cases: a null or empty text is a piece
of one token (the closing id); repeated rows are packed each; null ids are kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import checkpointed, map_batches, map_groups

CAPACITY = 4096
CLOSING = 1
MEMO = 1_000_000
GROUP = 8000
GOOD_FILL = 0.95

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class ChunkIds(dict):
    """Little-endian 32-bit ids of white-space separated chunks, remembered up to ``MEMO`` of them.

    White space ends every piece of the tokenizer's splitting, so a text's ids are its chunks' ids."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = self.tokenizer.to_str()
        self.small = '"type":"Lowercase"' in spec
        # only then is white space no part of any token, and a text the sum of its chunks
        self.by_chunk = '"behavior":"Removed","invert":true' in spec

    def __missing__(self, chunk: bytes) -> bytes:
        ids = np.array(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= MEMO:
            self.clear()
        self[chunk] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        if not self.by_chunk:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        # where texts are lower-cased, chunks that differ in ASCII capitals share an entry; only
        # special tokens, which are looked for in the text as it is, tell them apart
        if self.small and b"<|" not in text:
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def tokenized(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32, ids (null unless kept)."""
    closing = np.array([CLOSING], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chunk_ids(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (own.ids(text) if text else b"") + closing
                for k, at in enumerate(range(0, len(ids), capacity * 4)):
                    part = ids[at:at + capacity * 4]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return map_batches(source, run, PIECE)


class Bins:
    """Bins of one group: contents (piece indexes) and fills."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that still takes it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0  # bit r is set when some bin has room r
        for i in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            need = self.lengths[i]
            fits = rooms >> need
            if fits:
                room = need + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                b, room = len(self.items), self.capacity
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(i)
            self.fill[b] += need
            left = room - need
            if left:
                by_room[left].append(b)
                rooms |= 1 << left

    def exchange(self, a: int, b: int) -> bool:
        """The change that raises the sum of squared fills most: move a document from b to a,
        swap one for one, or two of b for one of a, filling a (the fuller) from b."""
        room = self.capacity - self.fill[a]
        size = self.lengths
        mine = [(0, None)] + [(size[i], i) for i in self.items[a]]
        ones = sorted((size[i], (i,)) for i in self.items[b])
        twos = [(x + y, (i, j)) for n, (x, (i,)) in enumerate(ones) for y, (j,) in ones[n + 1:]]
        offers = sorted(ones + (twos if len(ones) <= 64 else []))
        keys = [o[0] for o in offers]
        best = (0, None, ())
        for out, i in mine:
            k = bisect.bisect_right(keys, out + room) - 1
            if k >= 0 and keys[k] - out > best[0]:
                best = (keys[k] - out, i, offers[k][1])
        gain, out, got = best
        # moving gain tokens from b to a changes the squares by 2 * gain * (fill_a - fill_b + gain)
        if not got or gain * (self.fill[a] - self.fill[b] + gain) <= 0:
            return False
        for i in got:
            self.items[b].remove(i)
            self.items[a].append(i)
        if out is not None:
            self.items[a].remove(out)
            self.items[b].append(out)
        self.fill[a] += gain
        self.fill[b] -= gain
        return True

    def improve(self) -> None:
        """Empty the emptiest bins into the underfull others, as long as the tokens could fit
        into fewer bins and exchanges still succeed."""
        least = -(-sum(self.lengths) // self.capacity)
        live = [b for b in range(len(self.items)) if self.items[b]]
        stuck: set[int] = set()
        while len(live) > least:
            open_bins = [b for b in live if self.fill[b] < self.capacity]
            candidates = [b for b in open_bins if b not in stuck]
            if len(candidates) == 0 or len(open_bins) < 2:
                return
            low = min(candidates, key=lambda b: self.fill[b])
            changed = False
            for a in sorted(open_bins, key=lambda b: -self.fill[b]):
                while a != low and self.items[low] and self.fill[a] >= self.fill[low] and self.exchange(a, low):
                    changed = True
                if not self.items[low]:
                    break
            if not self.items[low]:
                live.remove(low)
                stuck.clear()
            elif not changed:
                stuck.add(low)


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of indexes into ``lengths``."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.improve()
    return [b for b in bins.items if b]


def _pack_groups(pieces: DataFrame, capacity: int, number: int) -> DataFrame:
    """Pack each group; sequence ids hold the round, the group and the bin."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        size = rows["length"].to_numpy()
        where, offset, fill = (np.zeros(len(rows), dtype=np.int64) for _ in range(3))
        for b, members in enumerate(pack_lengths(size.tolist(), capacity)):
            ends = np.cumsum(size[members])
            where[members], offset[members], fill[members] = b, ends - size[members], ends[-1]
        rows["sequence_id"] = (np.int64(number) << 60) + (rows["grp"].to_numpy() << 24) + where
        rows["offset"], rows["fill"] = offset, fill
        return rows[["row", "sequence_id", "offset", "fill"]]

    return map_groups(pieces.select("row", "grp", "length"), ["grp"], run,
                      "row long, sequence_id long, offset long, fill long")


def _dealt(pieces: DataFrame, rows: int) -> DataFrame:
    return pieces.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-rows // GROUP)))))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids when kept).

    The pieces are written once to the shared folder, so their row numbers hold on a retry."""
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    pieces = checkpointed(tokenized(docs, vocabulary, capacity, keep_ids).select(*kept))
    pieces = pieces.withColumn("row", F.monotonically_increasing_id())
    sizes = pieces.select("row", "length")
    first = checkpointed(_pack_groups(_dealt(sizes, pieces.count()), capacity, 0))
    loose = F.col("fill") < int(capacity * GOOD_FILL)
    left = first.filter(loose).join(sizes, "row").select("row", "length")
    second = _pack_groups(_dealt(left, left.count()), capacity, 1)
    placed = first.filter(~loose).unionByName(second).select("row", "sequence_id", "offset")
    return pieces.join(placed, "row").select(*kept, "sequence_id", "offset")


def sequences(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), doc_ids in order.

    A sequence has at most ``capacity`` tokens, so its group is bounded."""
    packed = pack(docs, vocabulary, capacity, keep_ids=True)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        ids = np.frombuffer(b"".join(rows["ids"]), dtype="<u4").astype(np.int32)
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [ids], "doc_ids": [list(rows["doc_id"])]})

    return map_groups(packed.select("sequence_id", "offset", "ids", "doc_id"), ["sequence_id"], run,
                      "sequence_id long, ids array<int>, doc_ids array<long>")
