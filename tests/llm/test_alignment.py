import bisect
import collections
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parcelbeam.llm import alignment
from tests.llm.test_byte_codec import odd_texts

PATHS = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
VALUE = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


def tokens(one, two, text):
    """(id, bytes) of both sides by the libraries, or nothing where they do not spell the text."""
    if not text:
        return [], []
    a = [(i, bytes(VALUE[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[1:-1], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode())
         for i in two.encode(text) for p in (two.id_to_piece(i),)]
    whole = (" " + text).encode()
    return (a, b) if all(b"".join(t for _, t in side) == whole for side in (a, b)) else ([], [])


def brute(rows):
    library, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    library.encode_special_tokens = True
    one, counts = [], collections.Counter()
    for doc_id, text in rows:
        a, b = tokens(library, pieces, text)
        spans = []
        for side in (a, b):
            stops = list(itertools.accumulate(len(t) for _, t in side))
            spans.append([(s - len(t), s, i) for s, (i, t) in zip(stops, side)])
        starts = [s for s, _, _ in spans[1]]
        links = []
        for s, e, i in spans[0]:
            k = max(bisect.bisect_right(starts, s) - 1, 0)
            while k < len(starts) and starts[k] < e:
                assert min(e, spans[1][k][1]) > max(s, starts[k])
                links.append((i, spans[1][k][2]))
                k += 1
        shared = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [([], []) for _ in shared]
        for side in (0, 1):
            for _, e, i in spans[side]:
                groups[bisect.bisect_left(shared, e)][side].append(i)
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        counts.update(set(links))
        one.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(digest.encode()).hexdigest() if a else ""))
    most = collections.defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [(doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha)
            for doc_id, n_a, n_b, n_groups, links, sha in one]


def report(docs):
    return collections.Counter(map(tuple, alignment.alignment_report(docs, *PATHS).collect()))


@pytest.mark.parametrize("held", [alignment.HELD, 40, 1])
def test_equals_brute_force(make_docs, edge_rows, monkeypatch, held):
    """All pairs broadcast, and some or nearly all by the shuffle join."""
    monkeypatch.setattr(alignment, "HELD", held)
    monkeypatch.setattr(alignment, "SLICE", 5000)
    rng = random.Random(7)
    odd = odd_texts(60, seed=rng.random())
    rows = [r for r in edge_rows if r[0] != 8] + [(100 + k, t) for k, t in enumerate(odd)] + [(300, "x▁y"), (301, " lead"), (302, "a" * 3000)]
    assert report(make_docs(rows)) == collections.Counter(brute(rows))


def test_zeros_for_texts_that_are_not_spelled(spark, make_docs):
    got = {r.doc_id: r for r in alignment.alignment_report(make_docs([(1, None), (2, ""), (3, "a▁b"), (4, "a b")]), *PATHS).collect()}
    for k in (1, 2, 3):
        assert tuple(got[k])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert got[4].n_groups == 2 and got[4].n_best == 2
    broken = spark.range(1).selectExpr("id AS doc_id", "CAST(X'61FF62' AS STRING) AS text")
    assert tuple(alignment.alignment_report(broken, *PATHS).first())[1:] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.alignment_report(make_docs([]), *PATHS).count() == 0


def test_kept_groups_and_links_in_slices():
    a, b = np.array([1, 2, 3, 4]), np.array([5, 6, 7])
    a_cuts, b_cuts, links, group = alignment.align(a, b, np.array([0, 2, 2, 1, 3]), np.array([0] * 5 + [3, 1, 4]))
    assert list(zip(a_cuts, b_cuts)) == [(2, 2), (4, 3)] and group.tolist() == [0, 0, 0, 1, 1]
    assert sorted((int(k) >> 32, int(k) & 0xFFFFFFFF) for k in links) == [(1, 5), (2, 5), (2, 6), (3, 7), (4, 7)]
    assert alignment.group_text(a, b, a_cuts, b_cuts, 100) == b"1,2|5,6;3,4|7"
    none, one = np.zeros(0, dtype=np.int64), np.array([1])
    empty = alignment.align(none, none, none, none)
    assert not any(map(len, empty)) and alignment.group_text(none, none, *empty[:2], 100) == b""
    assert alignment.group_text(np.array([50000]), np.array([9]), one, one, 60000) == b"50000|9"


def test_chunks_give_the_tokens_of_whole_texts():
    """Both sides: cut texts against whole ones."""
    own = alignment.Aligner(*PATHS)
    assert own.second.splits
    for text in odd_texts(3000, seed=11) + ["a b", " a", "a ", "a  b", "a \nb", "a\n b c", "\ta b"]:
        chunks = own.chunks(text)
        assert "".join(chunks) == " " + text
        library = own.first.encoder.tokenizer.encode(" " + text, add_special_tokens=False).ids
        assert b"".join(own.first.encoder.ids_of(chunks)) == np.array(library, dtype="<u4").tobytes(), text
        assert sum(own.second.encode(chunks), []) == own.second.encode([" " + text])[0], text


def test_groups_as_text(make_docs):
    r = alignment.aligned(make_docs([(1, "Hello wörld")]), *PATHS, keep_groups=True).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
    assert sum(len(g.split("|")[0].split(",")) for g in r.groups.split(";")) == r.n_a
