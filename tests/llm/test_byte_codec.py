import random

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelbeam.llm import byte_codec

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["<|endoftext|>", " ", "  ", "\n", "\r\n", "\t", " \n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "᠎", "​", "a", "the", "The",
       "'s", "'S", "'ll", "’", "é", "́", "1", "23", "½", "٣", "😀", "👩‍👩‍👧", "中文", "ठि", "אב", "Ⅷ", "ª", "!!!", "--", "ﬁ", "\x00", "﻿", "ſ", "İ",
       "antidisestablishment", "aaaa", "x" * 50]


def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_codec.read_ranks(PATH), special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_equals_the_reference_library_on_odd_texts_and_every_code_point():
    own, want = byte_codec.ByteCodec(PATH, PATTERN), library()
    texts = odd_texts(6000) + [f"a{chr(c)}b {chr(c)}1 {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 5 == 0 or c < 0x3000]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids_of(ids) == want.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_merges_of_small_vocabularies(tmp_path):
    """Random rank files, most of them not made by training: lowest rank first, then leftmost."""
    rng = random.Random(4)
    single = [bytes([b]) for b in range(256)]
    for trial in range(30):
        entries = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 7))) for _ in range(40)})
        rng.shuffle(entries)
        path = tmp_path / f"{trial}.tiktoken"
        path.write_bytes(b"".join(byte_codec.base64.b64encode(e) + b" %d\n" % i for i, e in enumerate(single + entries)))
        own = byte_codec.ByteCodec(str(path), PATTERN)
        want = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(200)]
        assert [ids_of(i) for i in own.encode(texts)] == [want.encode_ordinary(t) for t in texts]


def test_chunks_cover_the_text():
    for text in odd_texts(3000, seed=8):
        for whole in (text, " " + text):
            assert "".join(byte_codec.chunks(whole)) == whole
    assert byte_codec.chunks(" a b\nc  d") == [" a", " b", "\n", "c  d"]
    assert byte_codec.chunks(" a b\nc\n d e") == [" a", " b", "\n", "c\n d", " e"]


def test_offsets_equal_the_librarys():
    codec = byte_codec.ByteCodec(PATH, PATTERN)
    tokenizer = codec.tokenizer
    for text in odd_texts(3000, seed=5):
        ids = codec.encode([text])[0]
        starts, ends = codec.offsets(ids, text.encode())
        assert list(zip(starts.tolist(), ends.tolist())) == tokenizer.encode(text, add_special_tokens=False).offsets, repr(text)


def test_memo_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(byte_codec, "MEMO_BYTES", 20_000)
    own, want = byte_codec.ByteCodec(PATH, PATTERN), library()
    for k in range(40):
        text = " ".join(f"w{k}x{i}" for i in range(60)) + " 中" * 300 + "长" * 1000
        assert ids_of(own.encode([text])[0]) == want.encode_ordinary(text)
        memo = own.encoder.chunks
        assert memo.held <= 10_000 and sum(len(i) + 4 * len(c) + 200 for c, i in memo.older.items()) <= 20_000


def test_documents(spark, make_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(byte_codec, "SLICE", 1000)
    want = library()
    rows = [r for r in edge_rows if r[0] is not None]
    texts = dict(rows)
    docs = make_docs(rows)
    encoded = byte_codec.encode(docs, PATH, PATTERN, offsets=True)
    got = encoded.collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        assert ids_of(r.ids) == want.encode_ordinary(text)
        assert len(r.starts) == len(r.ends) == len(r.ids) // 4
        # neighbouring tokens meet, or share the character that is split between them
        assert all(b <= a <= b + 1 for a, b in zip(r.ends, r.starts[1:]))
        assert not r.ends or (r.starts[0], r.ends[-1]) == (0, len(text))
    report = {r.doc_id: r for r in byte_codec.round_trip(docs, PATH, PATTERN).collect()}
    assert report[1].n_tokens == report[2].n_tokens == 0 and report[8].n_tokens == len(want.encode_ordinary(texts[8]))
    assert byte_codec.round_trip(make_docs([(None, "a b"), (None, None)]), PATH, PATTERN).count() == 2
    assert byte_codec.round_trip(make_docs([]), PATH, PATTERN).count() == 0


def test_split_characters_unknown_ids_and_invalid_bytes(spark):
    want = library()
    ids = want.encode_ordinary("ab 𓀀𓀁 z")
    parts = [ids[:k] for k in range(len(ids) + 1)] + [[60000, ids[0]]]
    rows = [(k, bytearray(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)] + [(99, None)]
    df = spark.createDataFrame(rows, "doc_id long, ids binary")
    out = {r.doc_id: r for r in byte_codec.decode(df, PATH, PATTERN).withColumn("text", byte_codec.text_of(F.col("decoded"))).collect()}
    for k, p in enumerate(parts[:-1]):
        assert bytes(out[k].decoded) == b"".join(want.decode_single_token_bytes(i) for i in p)
        assert out[k].text.rstrip("�") == bytes(out[k].decoded).decode("utf-8", "ignore")
    assert out[len(ids)].text == "ab 𓀀𓀁 z" and out[99].decoded is None
    assert out[len(parts) - 1].text == "�" + want.decode(ids[:1])
    broken = spark.range(1).selectExpr("id AS doc_id", "CAST(X'61FF62' AS STRING) AS text")
    got = byte_codec.decode(byte_codec.encode(broken, PATH, PATTERN), PATH, PATTERN).first()
    assert bytes(got.decoded).decode() == "a�b"
