"""The quality classifier: held-out accuracy, tables against sums, and odd tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import additive

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def text_of(rng, good):
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(5, 80))]
    if good:
        return ". ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    return rng.choice([" | ".join(words), " ".join(w + rng.choice(["###", "%%%"]) for w in words), "!! ".join(words).upper(), " ".join(w for w in words for _ in range(20))])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = [(i, text_of(rng, i % 4 > 0), "en", "s", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"x": F.lit(1), "score": F.lit("z"), "y": F.lit(2), "quality": F.lit(9)})
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(900) if i % 3], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_documents_are_told_apart(corpus):
    docs, labels = corpus
    out = additive.classify(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 900
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.97


def test_held_out_labels_and_other_columns_change_nothing(corpus, spark):
    docs, labels = corpus
    before = {r.doc_id: r.score for r in additive.classify(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(additive.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.col("doc_id").cast("string")}).repartition(5)
    assert {r.doc_id: r.score for r in additive.classify(other, turned).collect()} == before


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(3)
    x = rng.random((6000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    parted = [np.linspace(0.05, 0.95, 19).astype(np.float32)] * 3
    single = additive.learn(x, y, parted, additive.Spec(pairs=0, rounds=40))
    both = additive.learn(x, y, parted, additive.Spec(pairs=1, rounds=40))
    right = lambda m: ((m.score(x) >= 0.5) == y).mean()
    assert [p[:2] for p in both.pairs] == [(0, 1)] and right(single) < 0.6 and right(both) > 0.9
    at = additive.binned(x[:50], parted)
    i, j, t = both.pairs[0]
    by_hand = [both.intercept + sum(both.tables[k][r[k]] for k in range(3)) + t[both.coarse[i][r[i]], both.coarse[j][r[j]]] for r in at]
    assert np.allclose(both.margin(at), by_hand)


def test_leaves_follow_the_gradient():
    spec = additive.Spec(least=1, prior=0.0, leaves=3)
    out = additive.leaves(np.array([2.0, 2, -4, -4, 6]), np.ones(5), np.ones(5), spec)
    assert out.tolist() == [2, 2, -4, -4, 6]
    assert additive.leaves(np.array([1.0]), np.ones(1), np.ones(1), spec).tolist() == [1]


def test_odd_tables(spark, corpus):
    labels = spark.createDataFrame([(2, None, 0), (7, 1, 0), (7, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert additive.classify(spark.createDataFrame([], DOCS), labels).collect() == []
    rows = [(1, None), (None, "a b"), (7, ""), (7, ""), (3, " \n\t"), (4, "\x00 é"), (5, "w " * 200_000), (6, "x" * 300_000), (-2, "\n\n")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    out = additive.classify(docs, labels.where("doc_id is null")).collect()
    assert len(out) == len(rows) and {r.score for r in out} == {0.5}
    out = additive.classify(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert additive.classify(docs, corpus[1].where("false")).where("score <> 0.5 or predicted <> 1").isEmpty()
