import collections
import random
import re

from parcelbeam.llm import quality
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def corpus(rng):
    good = [(i, ". ".join(prose(rng, 12, 3000).capitalize() for _ in range(12)) + ".\n" + prose(rng, 40, 3000)) for i in range(300)]
    symbols = [(1000 + i, " ".join(w + "$$$" if k % 2 else w + "%%%" for k, w in enumerate(prose(rng, 80).split()))) for i in range(30)]
    shouts = [(2000 + i, " ".join(w.upper() + "!!" for w in prose(rng, 80).split())) for i in range(30)]
    repeats = [(3000 + i, (prose(rng, 10) + "\n") * 9) for i in range(30)]
    return good, symbols + shouts + repeats


def test_statistics_equal_brute_force(make_docs, edge_rows):
    rng = random.Random(1)
    rows = [r for r in edge_rows if r[0] is not None]
    rows += [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(60)]
    rows += [(200, "a b\na b\n\n \nc|d\na b\r\n"), (201, "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5"), (202, "é$ É ß😀 x y")]
    got = collections.defaultdict(set)
    for r in quality.quality_report(make_docs(rows)).collect():
        got[r.doc_id].add((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1
    for doc_id, text in rows:
        assert got[doc_id] == {brute(text)}, doc_id


def test_rules_keep_good_and_reject_junk_without_labels(make_docs):
    good, junk = corpus(random.Random(2))
    kept = {r.doc_id for r in quality.keep_good(make_docs(good + junk)).collect()}
    assert {i for i, _ in good} <= kept
    assert len(kept & {i for i, _ in junk}) <= 2


def test_keep_good_keeps_columns_rows_and_report_agrees(make_docs, edge_rows):
    docs = make_docs(edge_rows + [(50, prose(random.Random(3), 200, 4000))] * 2)
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    report = collections.Counter(r.doc_id for r in quality.quality_report(docs).filter("kept").collect())
    assert collections.Counter(r.doc_id for r in out.collect()) == report
    assert report[50] == 2 and 1 not in report and 2 not in report


def test_empty_table(make_docs):
    docs = make_docs([])
    assert quality.quality_report(docs).count() == 0 and quality.keep_good(docs).count() == 0


def test_plan_has_no_python(make_docs):
    plan = quality.keep_good(make_docs([(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
