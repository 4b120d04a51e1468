"""Spelling variants against brute force, and on odd tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_words(rows, shortest=5, least=3):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n, out = brute_words(rows), {}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_are_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abeé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(120):
        some = []
        for _ in range(60):
            w = base[min(rng.randrange(60), rng.randrange(60))]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abeÉ") + w[at:], w[:at] + rng.choice("abeÿ") + w[at + 1 :]])
            some.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((rng.choice([i, i, None]), rng.choice([" ", "-", "1", "ō"]).join(some)))
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = result(variants.variants(docs))
    want = brute(rows)
    assert len(want) > 100 and sum(v[0] is not None for v in want.values()) > 30
    assert got == want


def test_crowded_buckets_are_divided(spark):
    words = ["ab" + x + y + "cd" + z for x in "abcdefghij" for y in "klmnopqrst" for z in "uvwxyz"] + ["ab" + x + "kkcdu" for x in "abcdefghij"]
    counted = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n long")
    got = {tuple(sorted((r.a, r.b))) for r in variants.neighbours(counted).collect()}
    assert got == {tuple(sorted((a, b))) for i, a in enumerate(words) for b in words[:i] if one_edit(a, b)}


def test_odd_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert variants.variants(none).collect() == []
    long = "x" * 200_000
    rows = [(1, None), (None, None), (2, ""), (3, "\x00 \n"), (4, "short"), (4, "short"), (4, "Short"), (5, f"{long} {long} {long} {long}y {long}y {long}y"), (6, "÷×÷×÷ " * 3 + "shorts " * 3 + "aß " * 9)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS).withColumns({"word": F.lit(1), "n": F.lit("z"), "key": F.lit(None).cast("int"), "form": F.lit(2)})
    assert result(variants.variants(docs)) == brute(rows)
    assert result(variants.variants(docs.select("text", "doc_id"))) == brute(rows)
