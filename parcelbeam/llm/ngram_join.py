"""N-gram Jaccard join by vertical partitioning (op 2).

A document is the set of hashes of its five-word runs.  Hash order is the global n-gram order; it
is cut into fragments.

1. The first fragment (a little over a fifth of the order) of all sets is shuffled, to learn
   which of its n-grams occur in two different sets.  A set with more n-grams of its own than a
   similar pair may differ by has no partner and drops out; most documents do.
2. For the sets left, all n-grams are shuffled once, to learn how many of these sets hold each.
   Sets whose unshared n-grams are too many drop out again; the others order their n-grams from
   rare to frequent and keep as prefix those that a similar pair must share one of.
3. Each set is compared with the set that it shares most n-grams with among the most typical
   holders of its n-grams (those with the fewest unshared ones): overlaps are counted fragment
   by fragment and summed per pair.  Documents linked so far form groups.
4. Where groups still share prefix n-grams, each set is compared with the most typical holder in
   another group, and then all pairs left across groups are compared the same way; within a group
   nothing is left to find, so groups of copies are never expanded into pairs.

Links are exact: every pair over the threshold is either compared or already in one group.

Equal sets are one node throughout.  Counting is done on 48 leading bits of the hashes: clashes
there only keep a set in longer.  Edge cases: null, empty and blank texts have an empty set and
stand alone; texts of fewer than five words have one n-gram, the whole; repeated rows with one id
are each returned; a null id is never the smallest id unless all of a component are null.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import checkpointed, fresh, map_batches, map_groups, shared_folder
from parcelbeam.llm.components import connected
from parcelbeam.llm.hashing import mix, run_hashes, word_hashes
from parcelbeam.llm.store import Store, look_up

WIDTH = 5
#: The threshold as a percentage.
SIMILAR = 80
#: Share of the n-gram order in the first fragment: more than the fifth that similar sets may differ by.
FIRST = 0.27
FRAGMENTS = 4
#: Texts are taken some bytes at a time; n-grams aimed at per bucket of a table.
SLICE = 2_000_000
BUCKET = 1_000_000
LEAST_BUCKETS = 8


class Sets(NamedTuple):
    """Sets of consecutive documents: node, size, all n-grams in order, and a rank: the lower, the
    more typical a set seems of its kind (it has fewer n-grams of its own)."""

    nodes: np.ndarray
    sizes: np.ndarray
    grams: np.ndarray
    ranks: np.ndarray

    def pick(self, keep: np.ndarray) -> "Sets":
        return Sets(self.nodes[keep], self.sizes[keep], self.grams[np.repeat(keep, self.sizes)], self.ranks[keep])

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def gram_sets(texts: list[bytes | None]) -> Sets:
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    sets = [np.unique(run_hashes(words[e - c:e], min(WIDTH, c))) if c else words[:0] for e, c in zip(ends, counts)]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    grams = np.concatenate(sets) if sets else words
    # a node is a hash of its sorted n-grams
    place = np.arange(len(grams), dtype=np.uint64) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams + mix(place)), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    nodes = mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
    return Sets(nodes, sizes, grams, np.zeros(len(sizes), np.uint8))


def distinct(sets: Sets) -> Sets:
    """One document per node, empty sets left out."""
    _, first = np.unique(sets.nodes, return_index=True)
    keep = np.zeros(len(sets.nodes), dtype=bool)
    keep[first] = True
    return sets.pick(keep & (sets.sizes > 0))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Sets]]:
    """The last column's texts, ``SLICE`` bytes at a time."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and size < SLICE:
                size += len(texts[to].as_py() or b"") + 1
                to += 1
            part = batch.slice(at, to - at)
            yield part, gram_sets(texts.slice(at, to - at).to_pylist())
            at = to


def spare(sizes: np.ndarray) -> np.ndarray:
    """N-grams that a set may have beyond those of a similar partner."""
    return sizes - -(-sizes * SIMILAR // 100)


def keys_of(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(16)


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the n-gram order."""
    return ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def in_first(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(32)) < np.uint64(int(FIRST * 2 ** 32))


class Table(NamedTuple):
    """Shared n-grams of some sets: a folder, the ranges it is cut into, and those that exist."""

    folder: str
    buckets: int
    have: list[int]

    def holders(self, grams: np.ndarray) -> np.ndarray:
        """Sets that hold each n-gram, as counted; 0 if it is in one set only."""
        return self.look(grams, {"df": "<u4"})["df"]

    def look(self, grams: np.ndarray, values: dict) -> dict[str, np.ndarray]:
        return look_up(self.folder, bucket_of(grams, self.buckets), keys_of(grams), "keys", values, self.have)


def send(sets: Sets, buckets: int) -> pa.RecordBatch:
    """One row per bucket: 48-bit keys in order, their sets as positions in the row's nodes.

    An n-gram in several of the sets is sent for the first and the last of them by (rank, node)
    only, with the count of all: it costs two entries a slice, however many sets hold it."""
    owner = sets.owner()
    order = np.lexsort((sets.nodes[owner], sets.ranks[owner], sets.grams))
    grams, owner = sets.grams[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(grams)) - 1
    several = last > first
    at = np.sort(np.concatenate([first, last[several]]))
    count = np.zeros(len(grams), dtype="<u4")
    count[first] = last - first + 1
    grams, owner, count = grams[at], owner[at], count[at]
    cut = np.searchsorted(bucket_of(grams, buckets), np.arange(buckets + 1))
    rows: list[tuple] = []
    for b in range(buckets):
        part = slice(cut[b], cut[b + 1])
        if cut[b] == cut[b + 1]:
            continue
        who, place = np.unique(owner[part], return_inverse=True)
        wide = place.astype("<u2" if len(who) <= 65536 else "<u4")
        keys = keys_of(grams[part]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        odd = np.flatnonzero(count[part] != 1)  # most counts are 1: only the others are sent
        rows.append((b, keys.tobytes(), wide.tobytes(), sets.nodes[who].tobytes(), sets.ranks[who].tobytes(), odd.astype("<u4").tobytes(), count[part][odd].tobytes()))
    kinds = (pa.int32(), *[pa.binary()] * 6)
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                           names=["bucket", "keys", "place", "nodes", "ranks", "odd", "counts"])


SENT = "bucket int, keys binary, place binary, nodes binary, ranks binary, odd binary, counts binary"


def write_table(sent: DataFrame, buckets: int, folder: str) -> Table:
    """Per bucket the n-grams held by two different nodes: key, count of sets, first node by (rank, node)."""
    store = Store(folder)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys, nodes, ranks, counts = [], [], [], []
        for k, place, who, rank, odd, c in zip(*[rows[x] for x in ("keys", "place", "nodes", "ranks", "odd", "counts")]):
            six = np.frombuffer(k, np.uint8).reshape(-1, 6)
            eight = np.zeros((len(six), 8), np.uint8)
            eight[:, :6] = six
            keys.append(eight.view("<u8").ravel())
            who = np.frombuffer(who, "<u8")
            at = np.frombuffer(place, "<u2" if len(who) <= 65536 else "<u4")
            nodes.append(who[at])
            ranks.append(np.frombuffer(rank, np.uint8)[at])
            n = np.ones(len(six), "<u4")
            n[np.frombuffer(odd, "<u4")] = np.frombuffer(c, "<u4")
            counts.append(n)
        key, node, rank, n = (np.concatenate(x) for x in (keys, nodes, ranks, counts))
        del keys, nodes, ranks, counts
        order = np.lexsort((node, rank, key))
        key, node, n = key[order], node[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        shared = np.minimum.reduceat(node, first) != np.maximum.reduceat(node, first)
        bucket = int(rows["bucket"].iloc[0])
        store.write(f"keys-{bucket}", key[first][shared])
        store.write(f"df-{bucket}", np.add.reduceat(n.astype(np.int64), first)[shared].clip(max=2 ** 32 - 1).astype("<u4"))
        store.write(f"low-{bucket}", node[first][shared])
        return pd.DataFrame({"bucket": np.int32([bucket])})

    written = map_groups(sent, ["bucket"], run, "bucket int").collect()  # one small number per bucket
    return Table(folder, buckets, sorted(r["bucket"] for r in written))


def buckets_for(grams: float) -> int:
    return max(LEAST_BUCKETS, -(-int(grams) // BUCKET))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("binary").alias("text"))


def memberships(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n (set size), node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in sliced(batches):
            yield pa.record_batch([part.column(0), pa.array(sets.sizes), pa.array(sets.nodes.view(np.int64))], names=["doc_id", "n", "node"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")),
                       run, "doc_id long, n long, node long")


def first_table(docs: DataFrame, folder: str, grams: int) -> Table:
    """The first fragment of all sets."""
    # only the first ranges of the order hold n-grams here
    buckets = int(buckets_for(grams * FIRST) / FIRST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in sliced(batches):
            yield send(cut_to_first(distinct(sets)), buckets)

    return write_table(map_batches(texts_of(docs), run, SENT), buckets, folder)


def cut_to_first(sets: Sets) -> Sets:
    keep = in_first(sets.grams)
    kept = np.bincount(sets.owner()[keep], minlength=len(sets.sizes))
    return Sets(sets.nodes, kept, sets.grams[keep], sets.ranks)


def left_after_first(sets: Sets, table: Table) -> Sets:
    """The sets whose own n-grams in the first fragment leave room for a partner."""
    sets = distinct(sets)
    part = cut_to_first(sets)
    own = np.bincount(part.owner()[table.holders(part.grams) == 0], minlength=len(sets.sizes))
    sets = sets._replace(ranks=np.minimum(own * 512 // np.maximum(sets.sizes, 1), 255).astype(np.uint8))
    return sets.pick(own <= spare(sets.sizes))


def candidate_rows(docs: DataFrame, first: Table, second: Table) -> DataFrame:
    """Per remaining set and fragment: node, fragment, n, grams, the partner that it is compared
    with first, the number of its unshared n-grams; on fragment 0 also the prefix."""

    def rows(sets: Sets) -> Iterator[tuple]:
        found = second.look(sets.grams, {"df": "<u4", "low": "<u8"})
        ends = np.cumsum(sets.sizes)
        for node, n, e in zip(sets.nodes, sets.sizes, ends):
            df, low, grams = (x[e - n:e] for x in (found["df"], found["low"], sets.grams))
            shared = df > 0
            own = int((~shared).sum())
            room = int(spare(n)) - own
            if room < 0:
                continue
            grams, df, low = grams[shared], df[shared], low[shared]
            prefix = grams[np.lexsort((grams, keys_of(grams), df))[:room + 1]]
            partners, votes = np.unique(low[low != node], return_counts=True)
            partner = partners[np.argmax(votes)] if len(partners) else node
            part = bucket_of(grams, FRAGMENTS)
            for k in range(FRAGMENTS):
                yield node, k, n, partner, own, grams[part == k].view(np.int64), prefix.view(np.int64) if k == 0 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "fragment", "n", "partner", "own", "grams", "prefix"]
        signed = lambda xs: pa.array(np.array(xs, dtype=np.uint64).view(np.int64))
        for _, sets in sliced(batches):
            out = list(rows(left_after_first(sets, first)))
            if out:
                node, fragment, n, partner, own, grams, prefix = zip(*out)
                yield pa.record_batch([signed(node), pa.array(fragment, pa.int32()), pa.array(n, pa.int64()), signed(partner),
                                       pa.array(own, pa.int64()), pa.array(grams, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))], names=names)

    made = map_batches(texts_of(docs), run, "node long, fragment int, n long, partner long, own long, grams array<long>, prefix array<long>")
    # copies in different slices repeat their rows
    return made.dropDuplicates(["node", "fragment"])


def second_table(docs: DataFrame, first: Table, folder: str, grams: int) -> Table:
    """All n-grams of the sets left after the first fragment."""
    buckets = buckets_for(grams * 0.4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in sliced(batches):
            yield send(left_after_first(sets, first), buckets)

    return write_table(map_batches(texts_of(docs), run, SENT), buckets, folder)


def over_threshold(counted: DataFrame) -> DataFrame:
    """Pairs (a, b) whose summed overlaps reach the threshold."""
    both = F.col("overlap")
    total = counted.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.filter(both * 100 >= (F.col("na") + F.col("nb") - both) * SIMILAR).select("a", "b")


def partial_overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs with the left side's fragments (a, b, fragment, na, grams): the overlap of each
    fragment with that of b."""
    right = sets.select(F.col("node").alias("b"), "fragment", F.col("n").alias("nb"), F.col("grams").alias("others"))
    return pairs.join(right, ["b", "fragment"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("grams", "others")).cast("long").alias("overlap"))


def star_links(sets: DataFrame) -> DataFrame:
    left = sets.filter("partner <> node").select(F.col("node").alias("a"), F.col("partner").alias("b"), "fragment",
                                                 F.col("n").alias("na"), "grams")
    return over_threshold(partial_overlaps(left, sets))


def open_rows(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Prefix n-grams that sets of different groups within each other's reach hold: gram, node, n,
    own, reach, grp.

    If an n-gram is the first that a pair shares, a set of size n with i n-grams before it has at
    most n - i in common with its partner, so the partner's size is bounded (``reach``); both of
    a pair must be within the other's reach."""
    held = sets.filter("fragment = 0").select("node", "n", "own", F.posexplode("prefix").alias("i", "gram"))
    reach = F.expr(f"(n - own - i) * {100 + SIMILAR} div {SIMILAR} - n")
    held = held.join(groups, "node", "left").select("gram", "node", "n", "own", reach.alias("reach"),
                                                    F.coalesce("component", "node").alias("grp"))
    bounds = held.groupBy("gram").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.min("n").alias("least"),
                                      F.max("reach").alias("most")).filter("lo <> hi").drop("lo", "hi")
    held = held.join(bounds, "gram").filter("n <= most AND reach >= least").drop("least", "most")
    return held.persist(StorageLevel.MEMORY_AND_DISK)


def typical_partners(held: DataFrame) -> DataFrame:
    """Pairs (a, b): each set with the most typical holder, of another group, of most of its open
    n-grams.  What is similar to a group's most typical set joins the group by this one pair."""
    hubs = held.groupBy("gram").agg(F.min(F.struct((F.col("own") * 1000 / F.col("n")).alias("rank"), F.col("node").alias("hub"),
                                                   F.col("grp").alias("hub_grp"))).alias("h")).select("gram", "h.hub", "h.hub_grp")
    votes = held.join(hubs, "gram").filter("grp <> hub_grp").groupBy("node", "hub").count()
    return votes.groupBy("node").agg(F.max(F.struct("count", "hub")).alias("m")).select(
        F.col("node").alias("a"), F.col("m.hub").alias("b"))


def cross_pairs(held: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different groups that share a prefix n-gram within reach."""
    spread = held.groupBy("gram", "grp").agg(F.min("n").alias("n"), F.max("reach").alias("reach"))
    side = lambda df, k, *more: df.select("gram", *[F.col(c).alias(c + k) for c in ("grp", "n", "reach", *more)])
    within = (F.col("na") <= F.col("reachb")) & (F.col("nb") <= F.col("reacha"))
    meets = side(spread, "a").join(side(spread, "b"), "gram").filter((F.col("grpa") < F.col("grpb")) & within)
    meets = meets.select("gram", "grpa", "grpb")
    pairs = meets.join(side(held, "a", "node"), ["gram", "grpa"]).join(side(held, "b", "node"), ["gram", "grpb"]).filter(within)
    return pairs.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct()


def pair_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), "fragment", F.col("n").alias("na"), "grams")
    return over_threshold(partial_overlaps(pairs.join(left, "a"), sets))


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest id with the same set), component_id."""
    spark = docs.sparkSession
    folder = shared_folder(spark, f"ngram-{uuid.uuid4().hex}")
    members = checkpointed(memberships(docs))
    grams = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    first = first_table(docs, f"{folder}/first", grams)
    second = second_table(docs, first, f"{folder}/second", grams)
    sets = checkpointed(candidate_rows(docs, first, second))
    links = checkpointed(star_links(sets))
    for pairs_of in (typical_partners, cross_pairs):
        held = open_rows(sets, connected(links))
        links = checkpointed(links.unionByName(pair_links(checkpointed(pairs_of(held)), sets)))
        held.unpersist()
    groups = connected(links)
    lone = F.col("n") == 0
    classes = members.filter(~lone).groupBy("node").agg(F.min("doc_id").alias("class_id")).join(groups, "node", "left")
    classes = classes.select("node", "class_id", F.coalesce("component", "node").alias("component"))
    smallest = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = classes.join(smallest, "component").select(F.col("node").alias("of"), "class_id", "component_id")
    out = members.join(named, (F.col("node") == F.col("of")) & ~lone, "left")
    own = F.when(lone, F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(own, "class_id").alias("class_id"),
                      F.coalesce(own, "component_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, columns as given: the one with the smallest id.

    Rows that repeat an id are one document, of which the least row stays; rows without an id
    cannot be told apart and stay."""
    (lost_id,) = fresh(docs, "lost")
    groups = jaccard_groups(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("keeper"), F.count("*").alias("rows"))
    groups = checkpointed(groups.filter("keeper <> doc_id OR rows > 1"))
    drop = groups.select(F.col("doc_id").alias(lost_id))
    same = F.col("doc_id").cast("long") == F.col(lost_id)
    kept = docs.join(drop, same, "left_anti")
    repeated = groups.filter("keeper = doc_id AND rows > 1").select(F.col("doc_id").alias(lost_id))
    least = docs.join(repeated, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias(lost_id))
    return kept.unionByName(least.select(f"{lost_id}.*"))
