"""Spelling variants by an even-partition pigeonhole join.

Two words that differ by one inserted, deleted or replaced code point agree on one of the
two halves of the shorter: an edit touches a single half.  So each word is indexed by its
two segments, whose places depend on its length, and probes with its own and, for words
one code point shorter, with the segments where those words' lie, shifted by one behind
the edit.  (A word's own probes for its length are its index entries.)

Segments of short words are common.  A bucket with more candidates than a multiple of its
rows is divided again: the half that may differ is cut in two, and the segment grows by
the half that then has to agree.  At a single code point it ends, where a bucket has a
row per letter for words of equal length and per two letters for longer ones.  Candidates
so stay in proportion to words, and none is lost: whatever is cut, the edit lies in one
part.  Parts of long words are divided whatever their bucket, until they are short.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST, LEAST, SPOILT = 5, 3, 97
#: Candidates per row from which a bucket is divided.
CROWDED = 8
#: Code points of the part that may differ up to which candidates are verified.
WIDE = 64
#: Distinct words, and their code points, that a task holds before it hands them on.
HELD, HELD_CHARS = 300_000, 16_000_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def runs(doc_id: int | None, text: bytes | None, shortest: int = SHORTEST, spoilt: int = SPOILT) -> Counter[str]:
    """Runs of letters of a text, A-Z lower-cased, with the spoilt ones short of a code point, and their numbers."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(RUN.findall((text or b"").translate(_LOWER).decode(errors="replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % spoilt == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= shortest:
            out[run] += n
    return out


def words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, spoilt: int = SPOILT) -> DataFrame:
    """``word`` and ``n``, how often it occurs overall, ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        chars = 0

        def out() -> Iterator[pa.RecordBatch]:
            found = list(held.items())
            for at in range(0, len(found), 50_000):
                some = found[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])
            held.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = runs(doc_id, text, shortest, spoilt)
                chars += sum(len(w) for w in own if w not in held)
                held.update(own)
                if len(held) > HELD or chars > HELD_CHARS:
                    yield from out()
                    chars = 0
        yield from out()

    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _key(word: Column, length: Column, since: Column, until: Column, longer: Column) -> Column:
    """What is left of a word without its code points from ``since`` to ``until`` (one more of a
    longer word's), hashed with the length and place that it is meant for."""
    head, tail = F.substring(word, F.lit(1), since), F.substring(word, until + longer + 1, F.length(word))
    return F.xxhash64(length, since, until, head, tail)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", _key(F.col("word"), F.col("length"), F.col("since"), F.col("until"), F.col("longer")))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once per half of the place where it may differ."""
    mid = F.floor((F.col("since") + F.col("until")) / 2).cast("int")
    parts = F.array(F.struct(F.col("since"), mid.alias("until")), F.struct(mid.alias("since"), F.col("until")))
    return _keyed(rows.select("word", "n", "length", "longer", F.inline(parts)))


def _one_edit() -> Column:
    """Whether ``a`` and ``b`` agree outside ``since`` to ``until`` and are one edit apart inside; the
    distance is taken of that short part alone, as its time grows with the square."""
    since, until, after = F.col("since"), F.col("until"), F.col("until") + F.col("longer")
    part = lambda w, end: F.substring(w, since + 1, end - since)
    tail = lambda w, end: F.substring(w, end + 1, F.length(w))
    same = (F.substring("a", F.lit(1), since) == F.substring("b", F.lit(1), since)) & (tail("a", until) == tail("b", after))
    return same & (F.levenshtein(part("a", until), part("b", after), 1) == 1)


def neighbours(counted: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct words one edit apart, once each, with ``na`` and ``nb``.

    ``counted`` has distinct words of ``shortest`` code points or more, and ``n``.
    """
    size = F.length("word").cast("int")
    own = F.struct(size.alias("length"), F.lit(0).alias("longer"))
    probe = F.when(size > shortest, F.struct((size - 1).alias("length"), F.lit(1).alias("longer")))
    rows = counted.select("word", "n", F.inline(F.array_compact(F.array(own, probe))))
    rows = cut(_halves(rows.select("*", F.lit(0).alias("since"), F.col("length").alias("until"))), "variant-rows")
    pairs = None
    while True:
        counts = rows.groupBy("key").agg(F.count_if(F.col("longer") == 0).alias("x"), F.count_if(F.col("longer") == 1).alias("y"))
        made = F.col("x") * (F.col("x") - 1) / 2 + F.col("x") * F.col("y")
        counts = cut(counts.where(made > 0).select("key", (made > (F.col("x") + F.col("y")) * CROWDED).alias("crowded")), "variant-buckets")
        wide = F.col("until") - F.col("since")
        met = cut(rows.join(counts, "key").select("*", ((F.col("crowded") & (wide > 1)) | (wide > WIDE)).alias("divide")), "variant-met")
        still = met.where("not divide")
        left = still.where("longer = 0").select("key", F.col("word").alias("a"), F.col("n").alias("na"), "since", "until")
        right = still.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "longer")
        near = left.join(right, "key").where((F.col("longer") == 1) | (F.col("a") < F.col("b")))
        found = cut(near.where(_one_edit()).select("a", "na", "b", "nb"), "variant-pairs")
        pairs = found if pairs is None else pairs.unionByName(found)
        rest = met.where("divide")
        if rest.isEmpty():
            return pairs.distinct()
        rows = cut(_halves(rest.drop("key")), "variant-rows")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last of the chain of forms; a chain's counts double, so it is
    short, and each round halves what is left of it."""
    now = cut(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, spoilt: int = SPOILT) -> DataFrame:
    """Words of all documents, each with the commoner spelling next to it.

    Words are runs of ``A-Z a-z`` and ``U+00C0`` to ``U+00FF``, A-Z lower-cased; a run
    whose crc32 together with its document's id is divisible by ``spoilt`` loses a code
    point.  Those of ``shortest`` code points and ``least`` occurrences stay.  Returns
    ``word``, ``form`` (of the words one edit away the commonest, then the first by code
    points, if it is twice as common; else null), ``root`` (where forms lead), ``n``,
    ``n_near`` and ``form_n``.

    Null texts have no words; a null id counts as an empty one; repeated rows count again;
    no words give no rows; other columns are ignored.
    """
    counted = cut(words(docs.select("doc_id", "text"), shortest, least, spoilt), "variant-words")
    pairs = cut(neighbours(counted, shortest), "variant-near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("n"), F.col("b").alias("form"))).alias("best"), F.first("na").alias("own"))
    fits = -F.col("best.n") >= 2 * F.col("own")
    near = cut(near.select("word", "n_near", F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n")), "variant-forms")
    out = counted.join(near, "word", "left").join(_roots(near.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
