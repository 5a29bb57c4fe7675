"""The registered queries over whole tables: against SQL where there is some, else brute force."""

import collections
import hashlib
import os
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelbeam.llm.oracles import ORACLES
from parcelbeam.llm.queries import QUERIES, VOCABULARY
from tests.llm import (
    test_alignment, test_byte_codec, test_lm, test_mixing, test_ngram_join, test_passages, test_quality, test_secret_scan)
from tests.oracle_compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, want.fetchall())


def test_all_operators_are_registered():
    import __spark_entry__
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= {k.split("_")[0] for k in __spark_entry__.queries()}


def test_op1(spark, texts):
    for r in QUERIES["op1_quality_rules"](spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == test_quality.brute(texts[r.doc_id])


def ids_of():
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return lambda t: library.encode(t or "", add_special_tokens=False).ids


def pieces(rows):
    """Multiset of (doc_id, piece, start, length, crc) for (doc_id, text) rows."""
    encode, out = ids_of(), collections.Counter()
    for doc_id, text in rows:
        ids = np.array(encode(text) + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            out[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def packed(rows):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        ends = [0] + list(np.cumsum([n for _, n in sorted(places)]))
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
    return collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_op3_and_op10(spark, texts):
    assert packed(QUERIES["op3_best_fit_packing"](spark, SF).collect()) == pieces(texts.items())
    encode = ids_of()
    for r in QUERIES["op10_token_counts"](spark, SF).collect():
        assert (r.n_tokens, r.n_bytes) == (len(encode(texts[r.doc_id])), len((texts[r.doc_id] or "").encode()))


def test_op11(spark, texts):
    library, count = test_byte_codec.library(), 0
    for r in QUERIES["op11_byte_level_bpe"](spark, SF).collect():
        text, count = texts[r.doc_id] or "", count + 1
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert count == len(texts)


def test_op12(spark, texts):
    got = QUERIES["op12_tokenizer_alignment"](spark, SF).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(test_alignment.brute(list(texts.items())))


def test_op4(spark, texts):
    for r in QUERIES["op4_secret_scans"](spark, SF).collect():
        want = test_secret_scan.listing(test_secret_scan.base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_op5(spark, texts):
    found = QUERIES["op5_substring_dedup"](spark, SF).collect()
    want, got = test_passages.brute(texts.items()), test_passages.covered(found)
    assert want and all(got[i] for i in want)


def test_op6(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op6_toxicity"](spark, SF).collect()
    clean = [r for r in got if labels.get(r.doc_id) == 0]
    assert len(got) == 200 and sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_op8(spark, texts):
    want = {r[0]: r for r in test_lm.brute(list(texts.items()))[0]}
    for r in QUERIES["op8_lm_scoring"](spark, SF).collect():
        assert tuple(r)[:5] == want[r.doc_id][:5]
        assert tuple(r)[5:] == pytest.approx(want[r.doc_id][5:], rel=1e-9)


def redacted(text):
    parts = test_secret_scan.base(text)
    patterns = {k: getattr(test_secret_scan.secret_scan, k.upper()) for k in ("weak_access", "weak_secret", "endpoint")}
    for k, p in patterns.items():
        parts += [(m.start(), test_secret_scan.secret_scan.KINDS.index(k), m.end(), k) for m in test_secret_scan.re.finditer(p, text or "")]
    spans = sorted(test_secret_scan.base(text) + test_secret_scan.brute_linked(parts))
    out, at = "", 0
    for start, _, end, _ in spans:
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + (text or "")[at:] if spans else text


def test_pipeline_equals_its_stages_by_brute_force(spark, texts):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "secret_scans", "source_mixing", "best_fit_packing"]
    good = {r.doc_id for r in QUERIES["op1_quality_rules"](spark, SF).filter("kept").collect()}
    groups = test_ngram_join.brute([(i, texts[i]) for i in sorted(good)])
    docs = {i: redacted(texts[i]) for i in good if groups[i][1] == i}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size = {i: len(test_quality.WORD.findall(t)) for i, t in docs.items()}
    sizes = collections.Counter()
    for i in docs:
        sizes[source[i]] += size[i]
    targets = test_mixing.brute_targets(sizes)
    rows = []
    for i, t in docs.items():
        rate = targets[source[i]] / sizes[source[i]]
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        rows += [(i, t)] * (int(rate) + (u < rate - int(rate)))
    assert packed(corpus_pipeline.run(spark, SF).collect()) == pieces(rows)
