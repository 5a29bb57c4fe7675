import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from parcelbeam.llm import packing
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, packed, capacity=4096):
    want = collections.Counter()
    for doc_id, text in rows:
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], dtype="<u4")
            want[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in packed) // capacity)


def test_pieces_round_trip_and_fill(make_docs, edge_rows):
    rng = random.Random(1)
    rows = edge_rows + [(100 + i, prose(rng, rng.randrange(1, 900))) for i in range(80)]
    used, least = check(rows, packing.pack(make_docs(rows), PATH).collect())
    assert used <= least * 1.03 + 1  # large pieces: the volume bound itself may be out of reach


def test_small_groups_are_packed_again_together(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 20)
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 40))) for i in range(300)]
    used, least = check(rows, packing.pack(make_docs(rows), PATH, capacity=256).collect(), 256)
    assert used <= least * 1.1 + 2


def test_sequences_hold_the_documents(make_docs):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(0, 30))) for i in range(40)]
    texts = dict(rows)
    for r in packing.sequences(make_docs(rows), PATH, capacity=512).collect():
        assert list(r.ids) == [t for d in r.doc_ids for t in ids_of(texts[d])] and len(r.ids) <= 512


def test_exchanges_raise_squared_fill_and_empty_bins():
    bins = packing.Bins([6, 6, 4, 3, 1], 10)
    bins.items, bins.fill = [[0, 3], [1, 4], [2]], [9, 7, 4]
    before = sum(f * f for f in bins.fill)
    assert bins.exchange(1, 2) or bins.exchange(0, 2)
    assert sum(f * f for f in bins.fill) > before
    # two for one: 5 out, 3 + 4 in
    bins = packing.Bins([5, 3, 3, 4], 10)
    bins.items, bins.fill = [[0, 1], [2, 3]], [8, 7]
    assert bins.exchange(0, 1) and bins.fill == [10, 5]
    assert sorted(sum(([3, 5, 7][i] for i in b)) for b in packing.pack_lengths([3, 5, 7], 15)) == [15]


def test_packing_reaches_the_volume_bound():
    rng = random.Random(4)
    lengths = [min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    found = packing.pack_lengths(lengths)
    assert sorted(i for b in found for i in b) == list(range(3000))
    assert all(sum(lengths[i] for i in b) <= 4096 for b in found)
    assert len(found) <= -(-sum(lengths) // 4096) + 1


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), PATH).count() == 0
