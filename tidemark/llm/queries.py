"""Registered queries of the training-data operators: thin digests over them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import additive, collocations, media, mixing, pieces, quality, quotes, simhash, surrogates, url_lists, variants, warc, wrappers
from tidemark.llm.common import cut, table


def _quoting(messages: DataFrame) -> DataFrame:
    """Messages as mail would have them: each quotes the one before it, and that one's quote below it a level deeper."""
    one = messages.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("t"))
    back = lambda k: one.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("t").alias(f"t{k}"))
    both = messages.select("conv_id", "turn", "role", "text").join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    quote = lambda c, mark: F.concat(F.lit(mark), F.replace(c, F.lit("\n"), F.lit("\n" + mark)))
    deeper = F.when(F.col("t2").isNotNull(), F.concat(F.lit("\n"), quote(F.col("t2"), ">> "))).otherwise("")
    text = F.concat(F.lit("On Monday, Bob wrote:\n"), quote(F.col("t1"), "> "), deeper, F.lit("\n\n"), F.coalesce("text", F.lit("")))
    return both.select("conv_id", "turn", "role", F.when(F.col("t1").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotes.threads(cut(quotes.link(_quoting(table(spark, sf_dir, "conversations"))), "quote-linked"))
    return linked.withColumn("quoted", F.array_join(F.transform("quoted", lambda q: F.concat_ws(":", q["level"], q["conv"], q["turn"])), ","))


def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op3_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), radius=2, shingle=3)


#: Days after the start of 2024 at which a page counts as fetched.
FETCHED = "timestampadd(HOUR, cast(page_id % 17520 as int), timestamp_ntz '2024-01-01 00:00:00')"


def _list_entries(pages: DataFrame) -> DataFrame:
    """A dated list that grows with the corpus: entries for half of all hosts, some of
    them lifted and renewed, for a path of every fifth, and two for whole domains."""
    hosts = pages.select("page_id", url_lists.host_of(F.col("url")).alias("host")).where("host <> ''").groupBy("host").agg(F.min("page_id").alias("h"))
    day = lambda n: F.expr(f"timestampadd(DAY, cast({n} as int), timestamp_ntz '2024-01-01 00:00:00')")
    entry = lambda kind, value, action, since: F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(action).alias("action"), since.alias("since"))
    host = F.col("host")
    some = F.array(
        F.when(F.col("h") % 2 == 0, entry("host", host, "block", day("h * 37 % 365"))),
        F.when(F.col("h") % 6 == 0, entry("host", host, "remove", day("h * 37 % 365 + 90"))),
        F.when(F.col("h") % 12 == 0, entry("host", host, "block", day("h * 37 % 365 + 200"))),
        F.when(F.col("h") % 5 == 0, entry("prefix", F.concat(host, F.lit("/fr")), "allow", day("150"))),
    )
    dated = hosts.select(F.explode(F.filter(some, lambda x: x.isNotNull())).alias("e")).select("e.*")
    fixed = hosts.sparkSession.sql("select * from values ('domain', 'cheap-pills.example.com', 'block', timestamp_ntz '2023-06-01 00:00:00'), ('domain', 'example.net', 'block', timestamp_ntz '2025-06-01 00:00:00') as t(kind, value, action, since)")
    return dated.unionByName(fixed)


def op5_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr(FETCHED))
    return url_lists.evaluate(captures, _list_entries(pages))


def op6_surrogate_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities", "entities")


def op7_iso_media_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.features(media.store(table(spark, sf_dir, "documents")), payload=True)
    track = F.get("tracks", F.lit(0))
    first = F.get(track["keyframes"], F.lit(0))
    feature = F.concat_ws(";", track["codec"], F.concat(track["seconds"].cast("decimal(20,4)").cast("string"), F.lit("s")), F.concat(F.size(track["keyframes"]).cast("string"), F.lit("k")), F.concat_ws("+", first["offset"], first["length"]))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))


#: The tokenizer's model; only the driver reads it.
MODEL = os.environ.get("TIDEMARK_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.coded(table(spark, sf_dir, "documents"), pieces.Model.load(MODEL, own_kind=True))
    return rows.select("doc_id", "n_chunks", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), F.length("decoded").cast("long").alias("n_decoded"), F.xxhash64("decoded").alias("decoded_hash"), "exact")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("distance")


def op10_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, index = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read(blocks, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:2] == "op" and k[2].isdigit()}
