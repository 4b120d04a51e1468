"""The pipeline's stages on odd rows, and their decisions against brute force."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as c
from test_advice_r01 import brute_kept
from tidemark.llm import quality, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def apply(spark, docs):
    for name, stage in c.STAGES:
        docs = c.cut(stage(spark, docs, ""), "test")
        yield name, docs


def test_odd_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f g h i j k l", "en", "s", 3)] * 2 + [(None, None, None, None, None), (2, "", "x", None, 0), (None, "m n o p q r s t u v w", "en", "s", 1), (None, "other words that are quite unlike the rest of them here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    counts = [d.count() for _, d in apply(spark, docs)]
    assert counts[:4] == [4, 3, 3, 3] and counts[4] > 0
    assert [d.count() for _, d in apply(spark, docs.limit(0))] == [0] * 5


def test_decisions_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    steps = [d for _, d in apply(spark, docs)]
    keep = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in steps[0].collect()} == keep
    one = brute_kept({r.doc_id: r.text or "" for r in steps[0].collect()})  # five words, similarity 0.8
    assert Counter(r.doc_id for r in steps[1].collect()) == Counter(one)
    assert all(len(r.text) == r.n_chars for r in steps[2].collect()) and steps[2].count() == len(one)
    assert {r.doc_id for r in steps[3].collect()} <= one and steps[3].columns == list(c.COLUMNS)
    assert steps[4].where("not exact").count() == 0 and steps[4].select("doc_id").distinct().count() == steps[3].select("doc_id").distinct().count()


def test_mix_repeats_documents_as_the_operator_takes_them(spark):
    rows = [(i % 90, f"w{i % 90} " * (1 + i % 90 % 13), "en", f"s{i % 90 % 4}" if i % 90 % 5 else None, i) for i in range(150)] + [(7, "of one kind " * 5, "en", "s1", 1)] * 40
    docs = spark.createDataFrame([(i, t, a, s, len(t)) for i, t, a, s, _ in rows], DOCS)
    taken = Counter()
    for r in c.mixing.mixed(docs).collect():
        taken[r.doc_id, r.size] += int(r.taken / r.size + 0.5)
    got = Counter((r.doc_id, len(r.text.split())) for r in c.mix(spark, docs, "").collect())
    assert got == +taken and len(got) > 50


def test_row_keys_mark_nulls(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, "x", None), (1, "", "x"), (1, "x", ""), (11, "x", ""), (1, "1:x", "")], "a int, b string, c string")
    assert rows.select(c.row_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).distinct().count() == 6


def _similar(a, b):
    x, y = (set(zip(*[t.split()[i:] for i in range(5)], strict=False)) for t in (a, b))
    return len(x & y) >= 0.8 * len(x | y)


def test_repeated_ids_with_other_texts_keep_their_links(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(20):
        for k in range(2):
            text = [word() for _ in range(60)]
            rows.append((i, " ".join(text)))
            rows.append((1000 + 2 * i + k, " ".join([*text[:-1], "other"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for r in simhash.similar(docs).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert all(got[i] == {i} for i in range(20)) and all(got[1000 + j] == {j // 2} for j in range(40))


def test_texts_with_one_boilerplate_make_few_pairs(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(160)]
    texts = [" ".join([*shared, *[word() for _ in range(38)]]) for _ in range(300)]
    texts += [t + " more" for t in texts[:20]]
    seen = []
    held = simhash._similar
    monkeypatch.setattr(simhash, "_similar", lambda pairs, sets, least: (seen.append(pairs.count()), held(pairs, sets, least))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar(docs).collect()}
    assert not any(_similar(texts[i], texts[j]) for i in range(0, 40) for j in range(i))
    assert got == {i: i - 300 if i >= 300 else i for i in range(320)}
    assert seen[1] < 1000, seen
