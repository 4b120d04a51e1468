"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit SimHash values over word shingles.  Pairs within the
radius are found by covering LSH (Pagh, "CoveringLSH: locality-sensitive hashing
without false negatives", 2016): bit ``i`` gets a non-zero vector ``m(i)`` of
``radius + 1`` bits, table ``v`` keeps the bits with odd ``<m(i), v>``.  Any
``radius`` positions leave some non-zero ``v`` orthogonal to all of their
vectors, so a pair within the radius agrees on all bits kept by that table and
collides there: no pair is missed.

What collides is then verified exactly and without forming pairs: fingerprints
at distance two or less meet in a common neighbour at distance one, so a
colliding fingerprint is expanded into its one-bit variants (only over bits that
some table in which it collides leaves free), and fingerprints that meet in a
variant are linked to the least of them.  A variant is met by 65 fingerprints at
most, whatever the size of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches
from tidemark.llm.components import components

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BLOCK = 1 << 14


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of some 64-bit hashes have each bit."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """Unsigned SimHash of UTF-8 bytes; null or no word: 0."""
    words = (data or b"").translate(_LOWER).split()
    if not words:
        return 0
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        some = [hashed(line[s:e], SEED) for s, e in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK], strict=True)]
        ones += _ones(np.array(some, np.uint64))
    return _majority(ones, len(starts))


@cache
def masks(radius: int, bits: int = BITS) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` structured masks of covering LSH."""
    size = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if bin((i % size + 1) & v).count("1") % 2) for v in range(1, size + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's bits as a signed long), a row per row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_signed(fingerprint(t, shingle)) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, fp long")


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a``, ``b`` that connect just what chains of distances up to ``radius`` connect.

    ``fps`` has distinct values in the long column ``fp``; ``radius`` is 1 or 2.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    kept = [_signed(m) for m in masks(radius)]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"), F.lit(~m).alias("free")) for i, m in enumerate(kept)])
    tables = fps.select("fp", F.inline(keys))
    full = cut(tables.groupBy("t", "key").count().where("count > 1").select("t", "key"), "lsh-buckets")
    hit = tables.join(full, ["t", "key"]).groupBy("fp").agg(F.bit_or("free").alias("free"))
    flips = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("getbit", F.col("free"), i) == 1)
    variants = cut(hit, "lsh-hits").select("fp", F.explode(F.concat(F.array("fp"), F.transform(flips, lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))).alias("z"))
    own = F.max((F.col("fp") == F.col("z")).cast("int"))
    met = variants.groupBy("z").agg(F.count("*").alias("n"), F.min("fp").alias("hub"), own.alias("own")).where("n > 1")
    if radius == 1:
        met = met.where("own = 1").withColumn("hub", F.col("z"))
    return variants.join(met.select("z", "hub"), "z").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def groups(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Class and component of every document.

    Returns ``doc_id``, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``: the smallest ``doc_id`` that links reach, its own included.
    Null, empty and white-space texts have fingerprint zero and are linked like any
    other.  Null ids are kept as rows and never become a component's id unless a
    component has no other.  Repeated rows stay repeated; an empty table gives an
    empty one; other columns of ``docs`` are ignored.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    linked = components(links(classes.select("fp"), radius))
    tree = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = cut(tree.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    named = cut(tree.join(least, "root").select("fp", "component_id"), "simhash-named")
    return fps.join(named.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Fixed values of the similarity rule: the covering tables of radius 2, and 32 bands of 4
# least hashes for what is further apart: pairs at 0.8 differ in 10 bits on average.  One
# of them shares no band with a probability of 5e-8, a closer one with less.
RADIUS = 2
BANDS, ROWS = 32, 4
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: bytes | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of UTF-8 bytes; null or no word: none."""
    words = (data or b"").translate(_LOWER).split()
    grams = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams)))


def key(hashes: np.ndarray) -> int:
    """Signed key of a set of shingles; no shingle: 0."""
    return _signed(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)) if len(hashes) else 0


def set_fingerprint(hashes: np.ndarray) -> int:
    """Unsigned SimHash of a set of shingles; no shingle: 0."""
    return _majority(sum((_ones(hashes[at : at + _BLOCK]) for at in range(0, len(hashes), _BLOCK)), np.zeros(BITS, np.int64)), len(hashes))


def tables(hashes: np.ndarray) -> list[int]:
    """Signed keys of a set of shingles in the covering tables of its SimHash."""
    own = set_fingerprint(hashes)
    return [_signed(own & m) for m in masks(RADIUS)]


def bands(hashes: np.ndarray) -> list[int]:
    """Signed keys of the bands of a set of shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[at : at + 2048, None] * _FACTORS).min(axis=0))
    return [_signed(xxhash.xxh64_intdigest(x.tobytes(), SEED)) for x in least.astype("<u8").reshape(BANDS, ROWS)]


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose sets have a Jaccard similarity of ``least`` or more."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    both = both.select(*pairs.columns, (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("c"))
    return cut(both.where(F.col("c") >= F.lit(least) * (F.col("n") - F.col("c")) - 1e-9).select(*pairs.columns), "similar-links")


#: Parts by hash in which shared shingles are counted.
PARTS = 32


def _shared(rest: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``sk``; how many of its shingles some other set of ``rest`` has, too; ``p0`` and so on, how many
    of those fall into each part of the hashes; and ``rare``, those of its prefix.

    Two sets have no more in common than the sum of the lesser counts of all parts.  A set's
    prefix is the ``n - ceil(least n) + 1`` shingles that the fewest sets have, ties by hash:
    two similar sets share one of both prefixes (those that no other set has come first
    and are shared with none)."""
    sized = rest.select("sk", "n").distinct()
    grams = sets.join(sized, "sk").select("sk", "n", F.explode("hashes").alias("h"))
    known = grams.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    part = F.pmod("h", F.lit(PARTS))
    found = grams.join(known.hint("shuffle_hash"), "h").groupBy("sk", "n").agg(F.count("*").alias("shared"), F.collect_list(F.struct("c", "h")).alias("hs"), *[F.count_if(part == i).alias(f"p{i}") for i in range(PARTS)])
    prefix = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.col("shared"))
    rare = F.transform(F.slice(F.sort_array("hs"), F.lit(1), F.greatest(prefix, F.lit(0)).cast("int")), lambda x: x["h"])
    return found.select("sk", "shared", *[F.col(f"p{i}").cast("int").alias(f"p{i}") for i in range(PARTS)], rare.alias("rare"))


def similar(docs: DataFrame, least: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``component_id`` (as in ``groups``) under chains of similar texts.

    Two texts are linked if the sets of their shingles have a Jaccard similarity of
    ``least`` or more, which is computed exactly.  Sets meet in the covering tables of
    their SimHash, where all within ``RADIUS`` bits do, and, as similarities of 0.8 are 10
    bits apart on average and tables double with every bit, in bands of least hashes; a
    table's bucket is treated like a band.  Equal sets are one class.  The members of a
    band are held against its most central one first, the one that meets most others
    over all bands: a group of copies of one text lies around it.  Bands that this leaves
    in several components give their members to a second round, which joins their rare
    prefixes: similar sets share a shingle among the rarest ``n - ceil(least n) + 1`` of
    each, so a passage that many of them have brings no two together.  Pairs are of different
    components, and counts must allow them: two sets need ``least / (1 + least)`` of
    their sizes' sum in common, shingles that no other set has aren't in common, and of
    those in one part of the hashes no more than the lesser number is.

    Rows that repeat an id may have other texts: each is in a class of its own text.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            keys = [key(x) for x in sets]
            signed = pa.array([tables(x) + bands(x) if len(x) else [] for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), signed], ["doc_id", "sk", "n", "bands"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            own = [(k, x.astype(np.int64)) for k, x in zip(b.column(0).to_pylist(), sets, strict=True) if key(x) == k]  # an id may have other texts
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.int64()), pa.array([x for _, x in own], pa.list_(pa.int64()))], ["sk", "hashes"])

    signed = cut(own.mapInArrow(sign, "doc_id long, sk long, n long, bands array<long>"), "similar-signed")
    classes = cut(signed.groupBy("sk").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "similar-classes")
    banded = classes.select("sk", "n", F.posexplode("bands").alias("t", "key"))
    full = cut(banded.groupBy("t", "key").agg(F.count("*").alias("m")).where("m > 1"), "similar-bands")
    members = cut(banded.join(full, ["t", "key"]), "similar-members")
    met = cut(members.groupBy("sk").agg(F.sum("m").alias("met")), "similar-met")
    wanted = cut(met.select("sk").join(classes.select("sk", "rep"), "sk"), "similar-wanted")
    texts = own.join(wanted, F.col("doc_id") == F.col("rep")).select("sk", "text")
    sets = cut(texts.mapInArrow(expand, "sk long, hashes array<long>").dropDuplicates(["sk"]), "similar-sets")
    placed = members.join(met, "sk")
    hubs = cut(placed.groupBy("t", "key").agg(F.max(F.struct("met", "sk", "n")).alias("h")).select("t", "key", F.col("h.sk").alias("b"), F.col("h.n").alias("nb")), "similar-hubs")
    sized = lambda x, y: F.least(x, y) >= F.lit(least) * F.greatest(x, y) - 1e-9
    spokes = members.join(hubs, ["t", "key"]).where((F.col("sk") != F.col("b")) & sized(F.col("n"), F.col("nb")))
    first = _similar(spokes.select(F.col("sk").alias("a"), "b").distinct(), sets, least)
    roots = cut(components(first).toDF("sk", "root"), "similar-roots")
    named = members.join(roots, "sk", "left").select("t", "key", "sk", "n", F.coalesce("root", "sk").alias("root"))
    named = cut(named, "similar-named")
    split = cut(named.groupBy("t", "key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("t", "key"), "similar-split")
    rest = named.join(split, ["t", "key"])
    rest = rest.select("sk", "n", "root").distinct()
    rest = cut(rest.join(_shared(rest, sets, least), "sk").where(F.col("shared") >= F.lit(least) * F.col("n") - 1e-9), "similar-rest")
    parts = [f"p{i}" for i in range(PARTS)]
    posted = rest.select("sk", "n", "shared", "root", *parts, F.posexplode("rare").alias("r", "h"))
    per = posted.groupBy("h", "root").agg(F.count("*").alias("c")).groupBy("h").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"))
    posted = cut(posted.join(per.where("roots > 1").select("h", "main"), "h"), "similar-posted")
    # no pair is within a component, so members of a shingle's main one are on one side only
    ours = posted.where("root <> main").select("h", *[F.col(c).alias(f"{c}a") for c in ("sk", "n", "shared", "root", "r", *parts)])
    theirs = posted.select("h", *[F.col(c).alias(f"{c}b") for c in ("sk", "n", "shared", "root", "r", *parts)])
    needed = F.lit(least / (1 + least)) * (F.col("na") + F.col("nb")) - 1e-9
    room = 1 + F.least(F.col("shareda") - 1 - F.col("ra"), F.col("sharedb") - 1 - F.col("rb")) + F.least("ra", "rb")
    common = sum((F.least(f"{p}a", f"{p}b") for p in parts), F.lit(0))
    close = sized(F.col("na"), F.col("nb")) & (F.least("shareda", "sharedb") >= needed) & (room >= needed) & (common >= needed)
    met = ours.join(theirs, "h").where((F.col("roota") != F.col("rootb")) & close)
    met = met.select(F.least("ska", "skb").alias("a"), F.greatest("ska", "skb").alias("b"), F.least("roota", "rootb").alias("ra"), F.greatest("roota", "rootb").alias("rb"))
    second = _similar(met.distinct(), sets, least)
    higher = cut(components(second.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).toDF("low", "high"), "similar-roots")  # of the components so far
    tree = classes.select("sk", "rep").join(roots, "sk", "left").select("sk", "rep", F.coalesce("root", "sk").alias("low"))
    tree = cut(tree.join(higher, "low", "left").select("sk", "rep", F.coalesce("high", "low").alias("root")), "similar-tree")
    low = cut(tree.groupBy("root").agg(F.min("rep").alias("component_id")), "similar-least")
    return signed.select("doc_id", "sk").join(cut(tree.join(low, "root").select("sk", "component_id"), "similar-ids").hint("merge"), "sk").select("doc_id", "component_id")
