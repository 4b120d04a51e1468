"""Findings of round 4 on the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import pieces
from tidemark.llm.queries import MODEL, op8_sentencepiece

ODD = ["the bank raised rates", "Hello  world\nfoo  été 漢字 ☃ 𝄞 end ", "", None, "   lead", "a\tb\r\nc", "a▁b", " ", "internationalization thntblereof " * 40, "x" * 3000]


def texts():
    rng = random.Random(8)
    alphabet = "etaoinshrdlu  \n.,éß漢☃𝄞"
    return [*ODD, *("".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(200))]


def test_documents_have_the_ids_of_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    model = pieces.Model.load(MODEL, own_kind=True)
    rows = {r.doc_id: r for r in pieces.coded(docs, model).collect()}
    for i, t in enumerate(texts()):
        assert rows[i].ids == library.encode(t or "")
        assert rows[i].decoded == library.decode(rows[i].ids) == (t or "").replace("▁", " ")
        assert rows[i].exact == ("▁" not in (t or ""))
    by_chunk = {r.doc_id: r.ids for r in pieces.gather(pieces.encode(docs, model)).collect()}
    assert by_chunk == {i: r.ids for i, r in rows.items() if r.ids}


def test_whole_texts_agree_with_the_table_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 3)  # generations follow each other
    docs = spark.createDataFrame([*enumerate(texts()), (0, "again"), (None, "no id"), (None, "no id")], "doc_id long, text string").withColumn("own", F.col("text"))
    model = pieces.Model.load(MODEL)
    whole = pieces.coded(docs, model, keep=("own",)).select("own", "doc_id", "n_chunks", F.size("ids").cast("long").alias("n_tokens"), "exact")
    table = pieces.digests(docs, model, keep=("own",)).select("own", "doc_id", "n_chunks", "n_tokens", "exact")
    assert whole.count() == docs.count() and whole.exceptAll(table).isEmpty() and table.exceptAll(whole).isEmpty()
    chunks = pieces._Chunks(model)
    want = [bytes(chunks[c]) for c in "▁a ▁b ▁c ▁d ▁a ▁e ▁f ▁g ▁a".split()]
    assert want[0] == want[4] == want[8] and len(chunks) <= 3 and len(chunks.old) <= 3


def test_the_query_decodes_whole_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the bank raised rates"), (2, "the▁bank"), (3, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op8_sentencepiece(spark, str(tmp_path)).collect()}
    said = docs.select("doc_id", F.xxhash64(F.translate(F.coalesce("text", F.lit("")), "▁", " ")).alias("h"))
    assert {k: r.decoded_hash for k, r in rows.items()} == {r.doc_id: r.h for r in said.collect()}
    assert {k: (r.n_decoded, r.exact) for k, r in rows.items()} == {1: (21, True), 2: (8, False), 3: (0, True)}
