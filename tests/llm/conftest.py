import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use inside, as columns that an input may have.
CLASHES = ["size", "target", "kept", "node", "n", "row", "grp", "spans", "mix", "__kept", "__stats", "__lost", "id", "rows"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows, with clashing columns."""
    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        if clash:
            for c in CLASHES:
                df = df.selectExpr("*", f"1 AS `{c}`")
        return df
    return make


def word(i):
    """A made-up word for a number."""
    out = ""
    i = i * 7919 + 13
    while i:
        i, r = divmod(i, 20)
        out += "bcdfghjklmnpqrstvwxz"[r] + "aeiou"[r % 5]
    return out


def prose(rng, n, vocabulary=500):
    return " ".join(word(rng.randrange(vocabulary)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters."""
    import random
    rng = random.Random(5)
    same = prose(rng, 120)
    return [(None, None), (None, same), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four"),
            (6, same), (7, same), (7, same), (8, prose(rng, 30000)), (9, "é́ Σ  x y 中文 \x00 \x85z"),
            (10, "<|endoftext|> a<|startoftext|>b"), (11, "ONE TWO three FOUR"), (12, "x" * 5000)]
