import collections
import random

import pytest

from parcelbeam.llm import mixing
from tests.llm.conftest import prose


def brute_targets(sizes):
    """Shares by weight 1, 2, 3, ...; stops at three times the size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and w and rest * weight[s] > 3 * sizes[s] * w}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else (rest * weight[s] / w if w else 0.0) for s in names}
        capped |= over


def corpus(seed):
    rng = random.Random(seed)
    names = [None, "", "a", "B", "é", "😀", "￿", "hot"] + [f"s{i}" for i in range(8)]
    rows = [(i, prose(rng, rng.randrange(1, 40)), rng.choice(names + ["hot"] * 8)) for i in range(1500)]
    return rows + [(9001, "x", "tiny"), (9002, None, "none"), (9003, "", "none"), (None, "a b", "hot"), (7, rows[7][1], rows[7][2])]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_rates(make_docs, seed):
    rows = corpus(seed)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    sizes["none"] += 0
    want = brute_targets(sizes)
    got = mixing.mix_report(make_docs(rows)).collect()
    assert len(got) == len(rows)
    source_of = {r[0]: r[2] for r in rows}
    taken = collections.Counter()
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-12)
        assert r.taken == r.size * r.copies <= 3 * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1
        taken[s] += r.taken
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.35 * want[s] + 60, s


def test_reruns_agree_and_mix_has_the_copies(make_docs):
    docs = make_docs(corpus(3))
    report = lambda: sorted((r.doc_id or -1, r.taken, r.copies) for r in mixing.mix_report(docs).collect())
    assert report() == report()
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    copies = collections.Counter()
    for i, _, n in report():
        copies[i] += n
    assert collections.Counter(r.doc_id if r.doc_id is not None else -1 for r in out.collect()) == +copies


def test_edges(make_docs, edge_rows):
    assert mixing.mix_report(make_docs(edge_rows)).count() == len(edge_rows)
    assert mixing.mix_report(make_docs([])).count() == 0 and mixing.mix_documents(make_docs([])).count() == 0
    (r,) = mixing.mix_report(make_docs([(1, None)])).collect()
    assert (r["size"], r.source_size, r.target, r.taken) == (0, 0, 0.0, 0)
