"""Findings of round 3 on the training-data operators."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pieces, simhash
from tidemark.llm.queries import MODEL


def test_a_text_that_misses_a_chunk_is_not_exact(spark, monkeypatch):
    model, whole = pieces.Model.load(MODEL), pieces.vocabulary
    docs = spark.createDataFrame([(1, "the bank raised rates"), (2, "the bank"), (3, ""), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pieces.digests(docs, model).collect()}
    assert {k: (r.exact, r.n_decoded) for k, r in rows.items()} == {1: (True, 22), 2: (True, 9), 3: (True, 0), 4: (True, 0)}
    monkeypatch.setattr(pieces, "vocabulary", lambda *a: whole(*a).where(F.col("key") != "▁rates"))
    assert {r.doc_id: r.exact for r in pieces.digests(docs, model).collect()} == {1: False, 2: True, 3: True, 4: True}


def test_documents_decode_from_their_ids(spark):
    model = pieces.Model.load(MODEL)
    docs = spark.createDataFrame([(1, "Hello  world\nfoo  été 漢字 ☃ 𝄞"), (2, "x" * 100_000), (3, " lead\tand\r\n end ")], "doc_id long, text string")
    ids = pieces.gather(pieces.encode(docs, model))
    got = {r.doc_id: r.text for r in pieces.decode(ids, model, ["doc_id"]).collect()}
    assert got == {r.doc_id: " " + r.text for r in docs.collect()}
    assert {r.doc_id: r.n_decoded for r in pieces.digests(docs, model).collect()} == {k: len(t) for k, t in got.items()}


def test_near_dedup_meets_texts_by_their_simhash(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [[word() for _ in range(400)] for _ in range(12)]
    rows = [" ".join(t) for t in texts] + [" ".join([*t, "more"]) for t in texts]
    sets = [simhash.shingles(t.encode()) for t in rows]
    near = [i for i in range(12) if (simhash.set_fingerprint(sets[i]) ^ simhash.set_fingerprint(sets[12 + i])).bit_count() <= simhash.RADIUS]
    assert len(near) > 3
    assert simhash.set_fingerprint(sets[0]) == simhash.fingerprint(rows[0].encode(), 5) and simhash.set_fingerprint(np.array([], np.uint64)) == 0
    # without the bands of least hashes, the tables alone link what is within the radius
    monkeypatch.setattr(simhash, "bands", lambda hashes: [])
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert all(got[12 + i] == i for i in near) and all(got[i] == i for i in range(12))
