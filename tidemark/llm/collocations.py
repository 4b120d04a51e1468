"""Phrase collocations over generalised suffix automata.

Texts are read in shards of bounded size.  A shard's pieces make one generalised
suffix automaton of bounded depth: its states are the classes of substrings with the
same end positions, a state's suffix link drops the first words of its substrings.
Bounded to a few words the link tree is made level by level: the end positions of a
substring, split by the word before it, are those of its children, so one sort per
level gives nodes, links and end-position counts.  Counts of all shards are summed by
phrase, and links (and their mirror, without the last word) carry subsumption.

A phrase is no more common than its parts.  Words are counted first, then hashed pairs
of common words, then phrases made of common pairs; "common" is looked up in a Bloom
filter of bounded size, which lets some rare ones through and loses none.  What the
last pass emits is summed by its words, so hashes never decide a count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

UNKNOWN = "und"
#: Most words of a phrase, least occurrences, and the share of its occurrences that subsumes it.
DEPTH, LEAST, COVERED = 4, 30, 80
SCALE = 2_000_000
#: Tokens of a shard, and bytes of text that are cut into words at once.
SHARD, SLICE = 3_000_000, 4_000_000
#: Bits per key of a filter, its probes, and the bounds of its size in bits (16 MB at most).
BITS, PROBES, SMALLEST, LARGEST = 16, 4, 1 << 16, 1 << 27

_GAP = b"\xff"  # never part of a UTF-8 text
_MAP = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b"\n" * 9)
_M31 = np.uint64((1 << 31) - 1)
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Filter:
    """Bloom filter over 64-bit hashes, in 64-bit cells."""

    cells: np.ndarray


    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        size = np.uint64(len(self.cells) * 64 - 1)
        one, two = hashes & _M31, (hashes >> np.uint64(33)) | np.uint64(1)
        found = np.ones(len(hashes), bool)
        for i in range(PROBES):
            at = (one + np.uint64(i) * two) & size
            found &= (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_of(hashed: DataFrame) -> Filter:
    """Filter over the distinct longs in ``h``: cells are made by Spark, of bounded number."""
    n = hashed.count()
    size = min(LARGEST, max(SMALLEST, 1 << (BITS * n).bit_length()))
    one, two = F.col("h").bitwiseAND(F.lit(int(_M31))), F.shiftrightunsigned("h", 33).bitwiseOR(F.lit(1).cast("long"))
    at = F.explode(F.array(*[(one + two * i).bitwiseAND(F.lit(size - 1)) for i in range(PROBES)])).alias("at")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    cells = hashed.select(at).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return Filter(out)


def word_hash(words: list[bytes], lang: bytes) -> np.ndarray:
    """What ``xxhash64(lang, word)`` gives in SQL, unsigned."""
    seed, hashed = xxhash.xxh64_intdigest(lang, 42), xxhash.xxh64_intdigest
    return np.fromiter((hashed(w, seed) for w in words), np.uint64, len(words))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = (first ^ (first >> np.uint64(29))) * _FACTORS[0] + second
    h = (h ^ (h >> np.uint64(32))) * _FACTORS[1]
    return h ^ (h >> np.uint64(31))


@dataclass
class Level:
    """Nodes of one depth: the word that each puts before its link, its link in the level above
    (a word's is -1), and its number of end positions."""

    word: np.ndarray
    link: np.ndarray
    count: np.ndarray


class Shard:
    """Pieces of one language as word ids; id 0 stands between pieces."""

    def __init__(self, lang: bytes):
        self.lang, self.parts, self.size = lang, [], 0
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        assert self.ids[_GAP] == 0

    def add(self, texts: list[bytes]) -> None:
        tokens = b"\n".join([b"", *texts]).translate(_MAP).replace(b"\n", b" \xff ").split()
        self.parts.append(np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def levels(self, depth: int, words: np.ndarray | None = None, pairs: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> list[Level]:
        """The automaton's link tree by depth.  ``words`` marks the words that longer substrings
        may have; ``pairs`` tells which neighbours may follow each other."""
        at, n = np.concatenate(self.parts), len(self.ids)
        count = np.bincount(at, minlength=n)
        count[0] = 0
        out = [Level(np.arange(n), np.full(n, -1), count)]
        fit = at != 0 if words is None else (at != 0) & words[at]
        node, ends = at.astype(np.int64), np.flatnonzero(fit)
        joined = None
        for d in range(2, depth + 1):
            ends = ends[ends >= d - 1]
            ends = ends[fit[ends - d + 1] if joined is None else joined[ends - d + 2]]
            key, back, count = np.unique(node[ends] * n + at[ends - d + 1], return_inverse=True, return_counts=True)
            made = Level(key % n, key // n, count)
            if d == 2 and pairs is not None:
                kept = pairs(made.word, out[0].word[made.link])
                joined = np.zeros(len(at), bool)
                joined[ends] = kept[back]
                ends, back = ends[kept[back]], back[kept[back]]
                place = np.cumsum(kept) - 1
                back, made = place[back], Level(made.word[kept], made.link[kept], made.count[kept])
            elif joined is None:
                joined = np.zeros(len(at), bool)
                joined[ends] = True
            node = np.zeros(len(at), np.int64)
            node[ends] = back
            out.append(made)
        return out


def phrases_of(levels: list[Level], depth: int, words: pa.Array) -> pa.Array:
    """Substrings of the nodes at ``depth``, read along their links."""
    parts, at = [], np.arange(len(levels[depth - 1].word))
    for d in range(depth, 0, -1):
        parts.append(words.take(pa.array(levels[d - 1].word[at])))
        at = levels[d - 1].link[at]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if depth > 1 else parts[0]


def _shards(docs: DataFrame, emit: Callable[[Shard], Iterator[tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Columns that ``emit`` makes of each shard, its language before them; a shard is part of a
    partition and holds ``SHARD`` tokens or the words of one slice more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[list, list]] = {}
        shards: dict[bytes, Shard] = {}

        def out(lang: bytes) -> Iterator[pa.RecordBatch]:
            shard = shards.pop(lang)
            for cols in emit(shard):
                for at in range(0, len(cols[0]), 100_000):
                    some = [c.slice(at, 100_000) for c in cols]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some[0]), pa.binary()), *some], schema=arrow)

        def add(lang: bytes) -> None:
            shards.setdefault(lang, Shard(lang)).add(held.pop(lang)[0])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts, size = held.setdefault(lang, ([], [0]))
                texts.append(text)
                size[0] += len(text)
                if size[0] >= SLICE:
                    add(lang)
                    if sum(x.size for x in shards.values()) >= SHARD:
                        for k in list(shards):
                            yield from out(k)
        for k in list(held):
            add(k)
        for k in list(shards):
            yield from out(k)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).cast("binary").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


_COUNTS = "lang binary, phrase binary, words int, a long"
_COUNTS_ARROW = pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("words", pa.int32()), ("a", pa.int64())])


def _summed(counts: DataFrame) -> DataFrame:
    s = counts.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))
    return s.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "words", "a")


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (a word), ``words`` (1) and ``a`` over all documents; an empty phrase of no words counts all."""

    def emit(shard: Shard) -> Iterator[tuple]:
        count = shard.levels(1)[0].count[1:]
        words = [b"", *list(shard.ids)[1:]]
        yield pa.array(words, pa.binary()), pa.array([0] + [1] * len(count), pa.int32()), pa.array([int(count.sum()), *count.tolist()], pa.int64())

    return _summed(_shards(_texts(docs), emit, _COUNTS, _COUNTS_ARROW))


def _common(shard: Shard, words: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a shard's words, and which of them may be common."""
    hashed = word_hash(list(shard.ids), shard.lang)
    return hashed, words.may_have(hashed)


def pair_counts(docs: DataFrame, words: Filter) -> DataFrame:
    """``h`` and ``a``: hashed pairs of words that may be common, counted."""
    shared = docs.sparkSession.sparkContext.broadcast(words.cells)

    def emit(shard: Shard) -> Iterator[tuple]:
        hashed, fit = _common(shard, Filter(shared.value))
        two = shard.levels(2, fit)[1]
        yield pa.array(pair_hash(hashed[two.word], hashed[two.link]).view(np.int64)), pa.array(two.count, pa.int64())

    pairs = _shards(_texts(docs), emit, "lang binary, h long, a long", pa.schema([("lang", pa.binary()), ("h", pa.int64()), ("a", pa.int64())]))
    return pairs.groupBy("h").agg(F.sum("a").alias("a"))


def phrase_counts(docs: DataFrame, words: Filter, pairs: Filter, depth: int = DEPTH) -> DataFrame:
    """As ``word_counts``, for phrases of 2 to ``depth`` words whose pairs may all be common."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(words.cells), context.broadcast(pairs.cells)

    def emit(shard: Shard) -> Iterator[tuple]:
        hashed, fit = _common(shard, Filter(shared[0].value))
        both = Filter(shared[1].value)
        levels = shard.levels(depth, fit, lambda a, b: both.may_have(pair_hash(hashed[a], hashed[b])))
        own = pa.array(list(shard.ids), pa.binary())
        for d in range(2, depth + 1):
            for at in range(0, len(levels[d - 1].word), 200_000):
                some = levels[: d - 1] + [Level(*(x[at : at + 200_000] for x in (levels[d - 1].word, levels[d - 1].link, levels[d - 1].count)))]
                found = phrases_of(some, d, own)
                yield found, pa.array(np.full(len(found), d), pa.int32()), pa.array(some[-1].count, pa.int64())

    return _summed(_shards(_texts(docs), emit, _COUNTS, _COUNTS_ARROW))


def _best(rows: DataFrame, by: list[Column], most: int) -> DataFrame:
    """Rows that can be among the first ``most`` of their language: level by level of the
    non-negative keys ``by``, what is below the key at which so many are reached goes.

    Each level counts rows per key, so no language meets in one task; rows that tie on all
    keys with the last one stay."""
    kept, ties = rows, F.lit(True)
    for i, key in enumerate(by):
        seen = kept.where(ties).groupBy("lang", key.alias("k")).agg(F.count("*").alias("c"))
        above = F.sum("c").over(Window.partitionBy("lang").orderBy(F.col("k").desc()))
        already = kept.where(~ties).groupBy("lang").agg(F.count("*").alias("over")) if i else rows.sparkSession.createDataFrame([], "lang string, over long")
        reached = seen.withColumn("above", above).join(already, "lang", "left")
        last = reached.groupBy("lang").agg(F.max(F.when(F.col("above") + F.coalesce("over", F.lit(0)) >= most, F.col("k"))).alias("last")).where("last is not null")
        last = cut(last, "phrases-last").withColumnRenamed("last", f"last{i}")
        kept = kept.join(last.hint("broadcast"), "lang", "left")  # a row per language
        edge = F.coalesce(F.col(f"last{i}"), F.lit(0))
        kept = kept.where(~ties | (key >= edge))
        ties = ties & (key == edge)
    return kept.select(*rows.columns)


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, covered: int = COVERED, most: int = 2000) -> DataFrame:
    """Each language's first ``most`` phrases by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Words are runs without blanks and tabs in the pieces between ``.,;:!?`` and line ends,
    A-Z lower-cased.  Candidates are phrases of 2 to ``depth`` words that occur ``least``
    times; of the cuts into two parts with the counts ``l`` and ``r``, the lowest score
    ``floor(2000000 a / (l + r))`` counts, then the earliest.  A candidate inside a longer
    one with ``covered`` percent of its occurrences goes: counts fall along links, so the
    phrases with one word more decide for all.  Ranks follow score, ``a``, then phrase.

    Null texts have no words, a null language is ``und``; languages are values like any
    other.  Repeated rows count again.  No document, word or common phrase: no rows.  Other
    columns are ignored.
    """
    counted = cut(word_counts(docs.select("lang", "text")), "phrases-words")
    totals = counted.where("words = 0").select("lang", F.col("a").alias("n"))
    common = counted.where((F.col("words") == 1) & (F.col("a") >= least))
    words = filter_of(common.select(F.xxhash64("lang", "phrase").alias("h")))
    paired = cut(pair_counts(docs.select("lang", "text"), words).where(F.col("a") >= least).select("h"), "phrases-pairs")
    longer = phrase_counts(docs.select("lang", "text"), words, filter_of(paired), depth).where(F.col("a") >= least)
    phrases = cut(common.unionByName(longer), "phrases-counts")
    w, m = F.split("phrase", " "), F.col("words")
    candidates = phrases.where("words > 1")
    cuts = candidates.select("lang", "phrase", "a", w.alias("w"), "words", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, m - F.col("k")), " ").alias("rest"))
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide("a"), wide("l") + wide("r"))
    both = both.withColumn("score", score)
    scored = both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("s"))
    ends = phrases.where("words > 2").select("lang", F.explode(F.array(F.array_join(F.slice(w, F.lit(2), m - 1), " "), F.array_join(F.slice(w, F.lit(1), m - 1), " "))).alias("phrase"), "a")
    above = ends.groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    left = scored.join(above, ["lang", "phrase"], "left").where(F.col("over").isNull() | (F.col("over").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered))
    left = cut(left.select("lang", "phrase", "a", "s.*"), "phrases-scored")
    best = _best(left, [F.floor(F.col("score") / 1000), F.col("score"), F.col("a")], most)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
