import random

import public_tokenizers
from tokenizers import Tokenizer

from parcelbeam.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_equals_the_library_on_odd_texts():
    library, own = Tokenizer.from_file(PATH), token_counts.MergeCounter(PATH)
    rng = random.Random(1)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", " ", "a", "the", "Ing", "İ", "Σ", "ς", "é", "́", "'s", "'T", "'ll", "ſ", "\x1c", "\x85",
             "\xa0", "　", "᠎", "1", "½", "٣", "😀", "!!!", "ß", "ﬁ", "ǅ", "﻿", "‍", "ͅ", "K", "\n", "\t", "\x00", "中", "ठ", "ि",
             "א", "_", "-", "Ⅷ", "ª", "antidisestablishment"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(10)))
        assert own.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_equals_the_library_on_every_code_point():
    library, own = Tokenizer.from_file(PATH), token_counts.MergeCounter(PATH)
    texts = [f"a{chr(c)} {chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 97 == 0)]
    for at in range(0, len(texts), 1000):
        part = " ".join(texts[at:at + 1000])
        want = [len(e.ids) for e in library.encode_batch(texts[at:at + 1000], add_special_tokens=False)]
        assert own.count(part.encode()) == sum(want) or [own.count(t.encode()) for t in texts[at:at + 1000]] == want, hex(at)


def test_merge_order_is_by_rank_then_place(tmp_path):
    own = token_counts.MergeCounter(PATH)
    own.ranks, own.suffix = {("a", "b"): 0, ("b", "a"): 1, ("ab", "ab"): 2}, ""
    assert own.piece_tokens("ababa") == 2  # abab + a
    assert own.piece_tokens("bab") == 2
    assert own.piece_tokens("aaaa") == 4


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 50)
    own = token_counts.MergeCounter(PATH)
    text = " ".join(f"w{i % 300}" for i in range(3000)).encode()
    assert own.count(text) == len(Tokenizer.from_file(PATH).encode(text.decode(), add_special_tokens=False).ids) and len(own.memo) <= 50


def test_documents(make_docs, edge_rows):
    library = Tokenizer.from_file(PATH)
    rows = [r for r in edge_rows if r[0] is not None]
    texts = dict(rows)
    got = token_counts.count_tokens(make_docs(rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)
    assert token_counts.count_tokens(make_docs([(None, None)]), PATH).collect()[0].n_tokens == 0
    assert token_counts.count_tokens(make_docs([]), PATH).count() == 0
