"""Phrase collocations against brute force, and on odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import collocations as c

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(t):
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in t or "")


def brute(rows, least=30, most=2000):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        some = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        scored = []
        for p, a in some.items():
            if any(100 * b >= 80 * a for q, b in some.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            scored.append((score, a, " ".join(p), left, right))
        scored.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, left, right, total[lang], s) for i, (s, a, p, left, right) in enumerate(scored[:most], 1)]
    return sorted(out)


def made(seed, docs=150):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("abcdefgÉé") for _ in range(rng.randint(2, 6))) for _ in range(8)]
    return [("".join(rng.choice([rng.choice(stock), rng.choice("abXYé")]) + rng.choice([" ", " ", "\t", "  ", ", ", ".\n"]) for _ in range(30)), rng.choice(["en", "de", None])) for _ in range(docs)]


def frame(spark, rows):
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    return docs.withColumns({"phrase": F.lit(1), "a": F.lit("z"), "n": F.lit(2), "words": F.lit(0), "h": F.lit(None).cast("int")})


def test_collocations_are_brute_force(spark, monkeypatch):
    rows = made(1)
    want = brute(rows)
    assert len(want) > 50 and {len(r[2].split()) for r in want} == {2, 3, 4}
    got = c.collocations(frame(spark, rows))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, c.collocations(frame(spark, rows), most=7).collect())) == brute(rows, most=7)  # cut within ties


def test_filters_only_let_more_through(spark, monkeypatch):
    rows = made(2, 80)
    monkeypatch.setattr(c, "SMALLEST", 64)
    monkeypatch.setattr(c, "LARGEST", 64)
    assert sorted(map(tuple, c.collocations(frame(spark, rows), least=12).collect())) == brute(rows, 12)


def test_shards_of_any_size_count_alike():
    texts = [t.encode() for t, _ in made(3, 60)]
    whole = c.Shard(b"en")
    whole.add(texts)
    parts, total = Counter(), Counter()
    for some in (texts[:7], texts[7:8], texts[8:]):
        shard = c.Shard(b"en")
        shard.add(some)
        levels = shard.levels(4)
        for d in range(1, 5):
            parts.update(dict(zip(c.phrases_of(levels, d, c.pa.array(list(shard.ids), c.pa.binary())).to_pylist(), levels[d - 1].count.tolist(), strict=True)))
    levels = whole.levels(4)
    for d in range(1, 5):
        total.update(dict(zip(c.phrases_of(levels, d, c.pa.array(list(whole.ids), c.pa.binary())).to_pylist(), levels[d - 1].count.tolist(), strict=True)))
        if d > 1:  # a node has no more end positions than its link
            assert (levels[d - 1].count <= levels[d - 2].count[levels[d - 1].link]).all()
    assert +parts == +total


def test_filter_of_spark_and_of_numpy_agree(spark):
    words = ["a", "the", "é", "ünd", "x" * 300]
    hashed = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.lit("en"), "w").alias("h"))
    known = c.filter_of(hashed)
    own = c.word_hash([w.encode() for w in words], b"en")
    assert sorted(own.view(np.int64).tolist()) == sorted(r.h for r in hashed.collect())
    assert known.may_have(own).all()
    other = c.word_hash([f"w{i}".encode() for i in range(2000)], b"en")
    assert known.may_have(other).mean() < 0.01


def test_odd_tables(spark):
    assert c.collocations(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(None, None), ("", "x"), (" \t\r\n.,", "y"), ("once upon", "en"), ("a\x00b \x1c c " * 40, "Tie"), ("q r " * 50_000, "long"), ("x" * 300_000, "one"), ("t u. " * 30 + "v w. " * 30, "tie")]
    rows += [("dup lic", "")] * 30
    assert sorted(map(tuple, c.collocations(frame(spark, rows)).collect())) == brute(rows)
