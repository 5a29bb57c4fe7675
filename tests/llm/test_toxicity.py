import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from parcelbeam.llm import toxicity
from tests.llm.conftest import prose

BAD = ["grumbolt", "snarfig", "wixelump", "dradgeous", "flomper"]


@pytest.fixture(scope="module")
def labelled(make_docs, spark):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(700):
        bad = i % 6 == 0
        words = prose(rng, rng.randrange(30, 120), 800).split()
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ing"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return make_docs(rows), labels, {i: t for i, _, t in marks}


def test_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    got = toxicity.toxicity_report(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 700 and 90 < len(held) < 190
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert bool(r.evidence) or r.predicted == 0


def test_neighbours_equal_brute_force(labelled):
    docs, labels, _ = labelled
    index = toxicity.build_index(docs, labels)
    n = len(index.labels)
    dense = np.zeros((n, len(index.vocabulary)))
    for t in range(len(index.vocabulary)):
        part = slice(index.starts[t], index.starts[t + 1])
        dense[index.members[part], t] = index.weights[part]
    assert n > toxicity.BLOCK and np.allclose((dense ** 2).sum(1), 1)
    rng = random.Random(2)
    for _ in range(200):
        ids, w = index.vector(Counter(rng.randrange(len(index.vocabulary)) for _ in range(rng.randrange(1, 6))))
        cosines = dense[:, ids] @ w
        want = sorted(((-c, e) for e, c in enumerate(cosines) if c > 0))[: toxicity.NEIGHBOURS]
        got = index.nearest(ids, w)
        assert np.allclose([c for c, _ in got], [-c for c, _ in want])
        ties = {e for c, e in want if -c > -want[-1][0] + 1e-9}
        assert ties <= {e for _, e in got}


def test_sample_is_bounded_and_labels_of_held_out_documents_unused(labelled):
    docs, labels, truth = labelled
    sample = toxicity.examples(docs, labels, 100).collect()
    assert len(sample) == 100
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id"), 5), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    one = {r.doc_id: r.score for r in toxicity.toxicity_report(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in toxicity.toxicity_report(docs, flipped).collect()}


def test_edges(make_docs, edge_rows, labelled, spark):
    docs, labels, _ = labelled
    index = toxicity.build_index(docs, labels)
    got = toxicity.score_documents(make_docs(edge_rows), index).collect()
    assert len(got) == len(edge_rows) and all(r.score == index.base for r in got)
    assert toxicity.toxicity_report(make_docs([]), labels).count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in toxicity.toxicity_report(make_docs(edge_rows), none).collect()} == {0.0}
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (6, 1, 0), (6, 1, 1)], T.StructType(labels.schema.fields))
    assert toxicity.toxicity_report(make_docs(edge_rows), odd).count() == len(edge_rows)


@pytest.mark.parametrize("n, every", [(90, 2), (80, 4)])
def test_few_labelled_documents_teach_too(make_docs, spark, n, every):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(n):
        words = prose(rng, 60, 800).split() + (["grumbolt"] if i % every == 0 else [])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % every == 0)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert toxicity.build_index(make_docs(rows), labels).vocabulary.keys() >= {"grumbolt"}
    found = {r.doc_id: r.predicted for r in toxicity.toxicity_report(make_docs(rows), labels).collect() if r.held_out}
    assert found and all(found[i] for i in found if i % every == 0)
