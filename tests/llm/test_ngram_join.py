import collections
import random
import re

import pytest

from parcelbeam.llm import ngram_join
from parcelbeam.llm.components import connected
from tests.llm.conftest import prose


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edit(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = "new%d" % rng.randrange(10 ** 6)
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 200), 5000)) for i in range(60)]
    passage = prose(rng, 60, 5000)
    rows += [(100 + i, prose(rng, rng.randrange(20, 60), 5000) + " " + passage) for i in range(60)]
    # a large group of near copies, in which not all are similar to each other
    base = prose(rng, 150, 5000)
    rows += [(300 + i, edit(rng, base, rng.randrange(4))) for i in range(80)]
    # chains: each similar to the next, the ends not
    for c in range(6):
        text = prose(rng, 120, 5000)
        for k in range(8):
            rows.append((500 + 10 * c + k, text))
            text = edit(rng, text, 2)
    rows += [(700 + i, base) for i in range(30)] + [(800 + i, passage) for i in range(5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(make_docs, seed):
    rows = corpus(seed)
    want = brute(rows)
    got = ngram_join.jaccard_groups(make_docs(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_cross_group_step_finds_what_the_first_comparison_misses(make_docs):
    rows = corpus(4)
    docs = make_docs(rows)
    folder = ngram_join.shared_folder(docs.sparkSession, "test-cross")
    first = ngram_join.first_table(docs, folder + "/1", 10000)
    second = ngram_join.second_table(docs, first, folder + "/2", 10000)
    sets = ngram_join.checkpointed(ngram_join.candidate_rows(docs, first, second))
    star = ngram_join.checkpointed(ngram_join.star_links(sets))
    pairs = ngram_join.checkpointed(ngram_join.cross_pairs(ngram_join.open_rows(sets, connected(star))))
    assert pairs.count() > 0 and ngram_join.pair_links(pairs, sets).count() > 0
    # pairs never lie within a group that is known already
    group = {r.node: r.component for r in connected(star).collect()}
    assert all(group.get(p.a, p.a) != group.get(p.b, p.b) for p in pairs.collect())


def test_edges(make_docs, edge_rows):
    got = ngram_join.jaccard_groups(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[3] == {(0, 3)}
    assert by_id[4] == {(1, 4)} and by_id[5] == {(1, 5)} and by_id[11] == {(1, 5)}
    assert by_id[6] == by_id[7] and {c for _, c in by_id[7]} == {6}
    assert {c for _, c in by_id[None]} == {None, 6}


def test_keep_one(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in out.collect())
    assert ids == {None: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 8: 1, 9: 1, 10: 1, 12: 1}
    repeated = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "h i j k l m")]
    assert sorted(r.doc_id for r in ngram_join.keep_one(make_docs(repeated)).collect()) == [1, 2]


def test_empty_table(make_docs):
    assert ngram_join.jaccard_groups(make_docs([])).count() == 0
    assert ngram_join.keep_one(make_docs([])).count() == 0


def test_connected_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r.node: r.component for r in connected(pairs).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
