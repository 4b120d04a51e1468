"""Findings of round 3 on the market queries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import grams, text_joins
from tidemark.sources import pages


def test_near_duplicates_move_sets_by_slot_alone(spark):
    """one shuffle a side, and the matches of all pairs across slots, sources and days."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé𝄞") for _ in range(6)) for _ in range(40)]
    rows = []
    for i in range(160):
        words = [base[(i % 7 + k) % 40] for k in range(8)]
        words[rng.randrange(8)] = rng.choice(base)
        rows.append((i * 2, f"s{i % 3}", " ".join(words) + rng.choice(["", " 1/2", " 3-4"])))
    docs = spark.createDataFrame([*rows, (999, "s1", ""), (1000, "s2", None)], "id long, source string, title string")
    got = text_joins.near_duplicates(docs, "id", "source", "id", 10, 0.6)
    grams_of = lambda t: {("  " + w + " ")[i : i + 3] for w in t.replace("/", " ").replace("-", " ").replace("é", "e").replace("𝄞", " ").split() for i in range(len(w) + 1)}
    day = lambda t: [t.split()[-1].replace("-", "/")] if t.split()[-1][0].isdigit() else []
    want = {}
    for a, sa, ta in rows:
        for b, sb, tb in rows:
            x, y = grams_of(ta), grams_of(tb)
            sim = round(len(x & y) / len(x | y), 6)
            if b < a <= b + 10 and sa != sb and sim >= 0.6 and (not day(ta) or not day(tb) or day(ta) == day(tb)):
                want[a] = max(want.get(a, (0, 0)), (sim, -b))
    assert {r.id: (r.sim, -r.other) for r in got.collect()} == want and len(want) > 20
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate ") == 1, plan


def test_trigram_postings_are_blocks(spark, tmp_path):
    """a row per trigram of many names, not per name."""
    index = grams.Grams(spark, f"file://{tmp_path}/g", parts=4)
    names = spark.range(500).select("id", F.lit("name").alias("field"), F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name")).coalesce(1)
    index.build(names.unionByName(spark.createDataFrame([(7, "ticker", "C7"), (8, "ticker", None), (9, "ticker", " ")], "id long, field string, name string")))
    rows = index.table.read()
    assert rows.where("gram = 'cus'").count() == 1 and rows.where("gram = 'cus'").select(F.size("ids")).first()[0] == 500
    got = {(r.id, r.field): round(r.sim, 4) for r in index.similar("C7", 0.3).collect()}
    assert got == {(7, "ticker"): 1.0}


def test_feeds_are_read_item_by_item(spark):
    """a document's items aren't kept beside its tree, and workers get small batches."""
    body = "<rss><channel>" + "".join(f"<item><title>t{i}</title><link>https://x.vn/a{i}</link></item>" for i in range(3)) + "</channel></rss>"
    items = pages.feed_items(body, "rss")
    assert not isinstance(items, list) and next(items)["url"] == "https://x.vn/a0" and len(list(items)) == 2
    for broken in (body[:-3], "<rss/>"):
        with pytest.raises(pages.Refused):
            next(pages.feed_items(broken, "rss"))
    docs = spark.createDataFrame([("a", "rss", None, None, body), ("b", "rss", None, None, body[:-3])], "feed string, kind string, base string, article string, body string")
    got = pages.feeds(docs)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m"
    assert sorted((r.feed, r.canonical, r.error is None) for r in got.select("feed", F.coalesce("canonical", F.lit("")).alias("canonical"), "error").collect()) == [("a", f"https://x.vn/a{i}", True) for i in range(3)] + [("b", "", False)]
