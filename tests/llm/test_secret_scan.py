import collections
import hashlib
import random
import re

from parcelbeam.llm import secret_scan

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def listing(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def noise(rng):
    parts = ["password=", "secret: ", "TOKEN = \"", "api_key'=", "apikey:", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "😀", "é",
             " ", "\n", "hunter2", "0123456789abcdef0123", "token=secret:abcdefghijklmnop", "AKIAAKIA", "=", ":", "passwd", "x", "ſecret=aaaaaaaaaaaaaaa"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(30)))


def test_base_spans_equal_brute_force(make_docs, edge_rows):
    rng = random.Random(1)
    rows = [r for r in edge_rows if r[0] is not None] + [(100 + i, noise(rng)) for i in range(400)]
    texts = dict(rows)
    got = secret_scan.secret_report(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(texts[r.doc_id])
        kinds = collections.Counter(k for *_, k in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"]), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(listing(want).encode()).hexdigest()
        assert set(filter(None, listing(want).split(","))) <= set(r.spans.split(","))


def brute_linked(parts):
    """Weak spans with a complementary part within SCOPE, over all pairs."""
    joins = {"weak_access": secret_scan.SECRETS, "weak_secret": secret_scan.IDENTIFIERS + secret_scan.ENDPOINTS, "endpoint": secret_scan.SECRETS}
    out = []
    for s, o, e, k in parts:
        near = [p for p in parts if p[3] in joins.get(k, ()) and p[0] <= e + secret_scan.SCOPE and p[2] >= s - secret_scan.SCOPE
                and (p[2] <= s or p[0] >= e)]
        if near:
            out.append((s, o, e, k))
    return out


def test_weak_parts_need_a_complement(make_docs):
    far = " lorem" * 100
    rows = [(1, "access_key_id = WXYZ123 and nothing else"), (2, "access_key_id = WXYZ123, secret = abcdefghijklmnop"),
            (3, "see https://db.example.com/x"), (4, "https://db.example.com pwd=tiger99"),
            (5, "https://db.example.com/" + far + " pwd=tiger99"), (6, "client_id: robot7 private_key: s3cr3tkey"),
            (7, "pwd=tiger99"), (8, "AKIA" + "B" * 16 + " pwd=tiger99")]
    got = {r.doc_id: {s.split(":")[0] for s in filter(None, r.spans.split(","))} for r in secret_scan.secret_report(make_docs(rows)).collect()}
    assert got == {1: set(), 2: {"weak_access", "assign"}, 3: set(), 4: {"endpoint", "weak_secret"}, 5: set(),
                   6: {"weak_access", "weak_secret"}, 7: set(), 8: {"access", "weak_secret"}}


def test_links_equal_all_pairs_in_long_texts(make_docs):
    rng = random.Random(2)
    bits = ["login=abcd", "pwd=abcdef", "https://a.bc", "AKIA" + "C" * 15, "0123456789abcdef", "token=abcdefghijkl", "x" * 90, "y" * 250]
    texts = {i: " ".join(rng.choice(bits) for _ in range(400)) for i in range(5)}
    patterns = {"weak_access": secret_scan.WEAK_ACCESS, "weak_secret": secret_scan.WEAK_SECRET, "endpoint": secret_scan.ENDPOINT}
    for r in secret_scan.secret_report(make_docs(list(texts.items()))).collect():
        parts = base(texts[r.doc_id])
        for k, p in patterns.items():
            parts += [(m.start(), secret_scan.KINDS.index(k), m.end(), k) for m in re.finditer(p, texts[r.doc_id])]
        want = sorted(base(texts[r.doc_id]) + brute_linked(parts))
        assert r.spans == listing(want)


def test_redact(make_docs, edge_rows):
    docs = make_docs([(1, "a password=abcdefghijkl b"), (2, "0123456789abcdef"), (3, "clean"), (4, None),
                      (5, 'token = "0123456789abcdef0123" é AKIA' + "Z" * 16)])
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "a [secret] b", 2: "[secret]", 3: "clean", 4: None, 5: '[secret]" é [secret]'}
    texts = collections.Counter((r[0], r[1]) for r in edge_rows)
    assert collections.Counter((r.doc_id, r.text) for r in secret_scan.redact(make_docs(edge_rows)).collect()) == texts


def test_empty_table(make_docs):
    assert secret_scan.secret_report(make_docs([])).count() == 0 and secret_scan.redact(make_docs([])).count() == 0


def test_plan_has_no_python(make_docs):
    plan = secret_scan.redact(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
