import collections
import math
import random
import re
import zlib

import pytest

from parcelbeam.llm import lm
from parcelbeam.llm.hashing import run_hashes, word_hashes
from tests.llm.conftest import prose


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute(rows):
    """The model with dictionaries, from the formulas in the module's docstring."""
    train = [words(t) + ["<end>"] for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    c = collections.Counter(w for s in train for w in s)
    pairs = collections.Counter(p for s in train for p in zip(["<begin>"] + s, s))
    n, v = sum(c.values()), len(c)
    coc = collections.Counter(pairs.values())
    d = [0.0, *lm.discounts(*[coc[k] for k in (1, 2, 3, 4)])]
    before = collections.Counter(w for _, w in pairs)
    cob = collections.Counter(before.values())
    e = [0.0, *lm.discounts(*[cob[k] for k in (1, 2, 3, 4)])]
    k = len(pairs)
    back = (e[1] * cob[1] + e[2] * cob[2] + e[3] * sum(x for m, x in cob.items() if m >= 3)) / k if k else 1.0
    total, g = collections.Counter(), collections.Counter()
    for (u, _), m in pairs.items():
        total[u] += m
        g[u] += d[min(m, 3)]

    def p(u, w):
        p1 = max(before[w] - e[min(before[w], 3)], 0) / max(k, 1) + back / (v + 1)
        if not total[u]:
            return p1
        m = pairs[u, w]
        return max(m - d[min(m, 3)], 0) / total[u] + g[u] / total[u] * p1
    out = []
    for i, t in rows:
        s = words(t) + ["<end>"]
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(s), sum(w in c for w in s), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s),
                    sum(math.log10(p(u, w)) for u, w in zip(["<begin>"] + s, s))))
    return out, p, c


def key(r):
    return (r[0] is None, r[0] or 0, r[2], round(r[5], 6))


def check(docs, rows):
    got = sorted((tuple(r) for r in lm.score_texts(docs, lm.fit(docs)).collect()), key=key)
    want = sorted(brute(rows)[0], key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_equals_brute_force_over_several_shards(make_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_PAIRS", 3000)
    monkeypatch.setattr(lm, "SLICE_WORDS", 100)
    rng = random.Random(1)
    rows = edge_rows + [(100 + i, "the " * rng.randrange(30) + prose(rng, rng.randrange(80), 300)) for i in range(120)]
    check(make_docs(rows), rows)


def test_probabilities_sum_to_one():
    rng = random.Random(2)
    rows = [(i, prose(rng, 40, 60)) for i in range(40)]
    _, p, c = brute(rows)
    for u in ["<begin>", "unseen", *list(c)[:10]]:
        assert sum(p(u, w) for w in c) + p(u, "unseen word") == pytest.approx(1)


def test_held_out_text_is_better_predicted_than_by_word_counts(make_docs):
    rng = random.Random(3)
    lines = [prose(rng, 12, 400) for _ in range(30)]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(5))) for i in range(150)]
    docs = make_docs(rows)
    held = [r for r in lm.score_texts(docs, lm.fit(docs)).collect() if r.held_out]
    assert held and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_without_training_texts(make_docs):
    assert lm.score_texts(make_docs([]), lm.fit(make_docs([]))).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(held, "a b")]
    check(make_docs(rows), rows)


def test_hashes():
    texts = [b"One two  THREE", None, b"", b" \t", "é É one".encode(), b"two three one"]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [3, 0, 0, 0, 3, 3]
    one, two, three, e1, e2, one2, two2, three2, one3 = hashes
    assert one == one2 == one3 and two == two2 and three == three2 and len({one, two, three, e1, e2}) == 5
    assert len(run_hashes(hashes, 5)) == 5 and len(run_hashes(hashes[:4], 5)) == 0
    assert word_hashes([])[0].size == 0
    many = word_hashes([" ".join(str(i) for i in range(200000)).encode()])[0]
    assert len(set(many.tolist())) == 200000
