"""A positional inverted index over versioned texts, and ranked search on it.

Postings (``token``, ``id``, ``version``, ``length``, ``positions``) lie in segments of
files, each parted by a hash of the token and sorted by token, so a search opens the
parts of the asked tokens alone.  Increments add segments; a manifest, swapped like any
versioned table, names those that count.  A head per revision tells which is an id's
newest; postings of older ones don't match and go when segments are merged.

The rank is that of PostgreSQL's ``ts_rank`` with equal weights: one token scores by the
inverse squares of its places' ordinals, several by the distances of all pairs of their
places.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.session import cut, small_batches
from tidemark.sources import snapshots

# Fixed values of the rank: weight of a place, most places of a token that count, the last
# place that is told apart, and the limit of the sum of inverse squares.
WEIGHT, MOST_PLACES, LAST_PLACE, SQUARES = 0.1, 255, 16_383, 1.64493406685
POSTINGS = "token string, id long, version int, length int, positions array<int>, part int"
#: Parts that tokens are dealt to by hash.
PARTS = 64


def nearness(distance: Column) -> Column:
    """What the distance of two places is worth: near 1 for neighbours, next to nothing past 100."""
    return F.when(distance <= 100, 1.0 / (1.005 + 0.05 * F.exp(distance / 1.5 - 2))).otherwise(1e-30)


def places_of(tokens: Column, word: str) -> Column:
    """Places of a word in an array of tokens, counted from 0, as postings have them."""
    each = F.transform(tokens, lambda t, i: F.when(t == word, i))
    return F.array_compact(each)


def _shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def _ranked(places: Column) -> Column:
    """The places that the rank sees (array indexes count from 0, places from 1)."""
    return F.transform(F.slice(places, 1, MOST_PLACES), lambda p: F.least(p + 1, F.lit(LAST_PLACE)))


def _left(a: Column, b: Column) -> Column:
    """Logarithm of what all pairs of places of two tokens leave of 1; a place has no distance to itself."""
    apart = lambda p, q: F.when(p == q, 0.0).otherwise(F.ln(1 - F.sqrt(WEIGHT * WEIGHT * nearness(F.abs(p - q)))))
    return F.aggregate(a, F.lit(0.0), lambda s, p: s + F.aggregate(b, F.lit(0.0), lambda u, q: u + apart(p, q)))


def rank(places: list[Column]) -> Column:
    """Rank of a text from the places of each distinct token that was asked for."""
    if len(places) == 1:
        used = F.least(F.size(places[0]), F.lit(MOST_PLACES))
        return F.aggregate(F.sequence(F.lit(1), used), F.lit(0.0), lambda s, j: s + WEIGHT / (j * j)) / SQUARES
    rest = sum((_left(a, b) for a, b in combinations([_ranked(p) for p in places], 2)), F.lit(0.0))
    return 1 - F.exp(rest)


def at_most(places: list[Column]) -> Column:
    """A bound of the rank from the numbers of places alone."""
    used = [F.least(F.size(p), F.lit(MOST_PLACES)) for p in places]
    if len(places) == 1:
        return rank(places)
    pairs = sum((a * b for a, b in combinations(used, 2)), F.lit(0))
    closest = WEIGHT * (1.0 / (1.005 + 0.05 * 2.718281828459045 ** (1 / 1.5 - 2))) ** 0.5
    return 1 - F.pow(F.lit(1 - closest), pairs)


#: Columns of postings, and what moves: all postings that a batch has of a part, as compressed Arrow streams
#: of narrow columns, places apart.
_COLUMNS = pa.schema([("token", pa.string()), ("id", pa.int64()), ("version", pa.int32()), ("length", pa.int32()), ("positions", pa.list_(pa.int32()))])
_PACKED = "part int, packed binary, places binary"
#: Texts and postings that are packed at once, and bytes of either.
PACKED_TEXTS, PACKED_ROWS, PACKED_BYTES = 1 << 12, 1 << 16, 16 << 20
#: Revisions of ids that have several which a merge sends to every task; if there are more, it moves postings by id.
MOST_SENT = 1 << 20


def _narrow(x: pa.Array) -> pa.Array:
    """Numbers in the narrowest type that holds them."""
    own = x.to_numpy()
    return pa.array(own.astype(np.min_scalar_type(own.max()))) if len(own) and own.min() >= 0 else x


def _stream(columns: dict[str, pa.Array]) -> bytes:
    rows, sink = pa.RecordBatch.from_arrays(list(columns.values()), list(columns)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _packed(part: np.ndarray, postings: pa.RecordBatch) -> pa.RecordBatch:
    """A row per part of postings whose rows of a part stand together."""
    starts, out = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)), []
    for lo, hi in zip(starts, starts[1:], strict=False):
        own = postings.slice(lo, hi - lo)
        numbers = {k: _narrow(own.column(k)) for k in ("id", "version", "length")}
        packed = _stream({"token": own.column("token").dictionary_encode(), **numbers, "n": _narrow(own.column("positions").value_lengths())})
        out.append((packed, _stream({"place": _narrow(own.column("positions").flatten())})))
    packed, places = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part[starts[:-1]], pa.int32()), pa.array(packed, pa.binary()), pa.array(places, pa.binary())], ["part", "packed", "places"])


def _joined(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` rows or ``PACKED_BYTES``, however small those are that come."""
    some, rows, size = [], 0, 0
    for b in batches:
        some, rows, size = [*some, b], rows + b.num_rows, size + b.nbytes
        if rows >= most or size >= PACKED_BYTES:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()
            some, rows, size = [], 0, 0
    if rows:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed postings of batches of ``id``, ``version``, ``t`` (tokens) and ``p`` (their parts)."""
    for b in _joined(batches, PACKED_TEXTS):
        sizes = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words = b.column(2).flatten().dictionary_encode()
        if not len(words):
            continue
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        code = words.indices.to_numpy().astype(np.int64)
        part = np.zeros(len(words.dictionary), np.int64)
        part[code] = b.column(3).flatten().to_numpy()
        by_part = np.argsort(part, kind="stable")
        turn = np.empty_like(by_part)
        turn[by_part] = np.arange(len(by_part))
        own = turn[code] * len(sizes) + row
        order = np.argsort(own, kind="stable")  # by part, token, text and place
        own = own[order]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        token, of = np.divmod(own[starts], len(sizes))
        token = by_part[token]
        places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)), pa.int32()), pa.array(place[order], pa.int32()))
        columns = [words.dictionary.take(pa.array(token)).cast(pa.string()), b.column(0).take(pa.array(of)), b.column(1).take(pa.array(of)), pa.array(sizes[of], pa.int32()), places]
        yield _packed(part[token], pa.RecordBatch.from_arrays(columns, schema=_COLUMNS))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed postings of batches of ``part`` and postings."""
    for b in _joined(batches, PACKED_ROWS):
        order = pa.array(np.argsort(b.column(0).to_numpy(), kind="stable"))
        part, *own = (c.take(order) for c in b.columns)
        yield _packed(part.to_numpy(), pa.RecordBatch.from_arrays([c.cast(k.type) for c, k in zip(own, _COLUMNS, strict=True)], schema=_COLUMNS))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings and their part, of packed ones."""
    for b in batches:
        for part, packed, places in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            rows, flat = (pa.ipc.open_stream(x.as_buffer()).read_next_batch() for x in (packed, places))
            ends = np.cumsum(np.append(0, rows.column("n").to_numpy()), dtype=np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), flat.column(0).cast(pa.int32()))
            own = [rows.column(k.name).cast(k.type) for k in list(_COLUMNS)[:-1]]
            yield pa.RecordBatch.from_arrays([*own, listed, pa.array(np.full(len(listed), part, np.int32))], [*_COLUMNS.names, "part"])


@contextmanager
def _writing(spark: SparkSession, files: int) -> Iterator[None]:
    """While it lasts, a task keeps so many files open and doesn't sort its rows by file, and gets
    few packed postings, as they grow when they are unpacked."""
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": files, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@dataclass(frozen=True)
class Hits:
    """Ids that match; ``rows`` has ``id``, ``version`` and the array ``p<i>`` of places of each distinct token."""

    rows: DataFrame
    tokens: list[str]

    @property
    def places(self) -> list[Column]:
        return [F.col(f"p{i}") for i in range(len(self.tokens))]

    def scored(self) -> DataFrame:
        """``id``, ``version``, ``score`` of all."""
        return self.rows.select("id", "version", rank(self.places).alias("score"))

    def top(self, k: int, *ties: Column) -> DataFrame:
        """The ``k`` best by score, then ``ties`` (columns of ``rows``), then id.

        Bounds come from numbers of places; the ``k`` highest bounds give a score that the
        best reach, and only what could reach it is scored."""
        bounded = self.rows.withColumn("bound", at_most(self.places))
        first = bounded.orderBy(F.col("bound").desc(), "id").limit(k)
        least = first.agg(F.min(rank(self.places)).alias("s"), F.count("*").alias("n")).first()
        reach = bounded.where(F.col("bound") >= least.s - 1e-12) if least.n == k else bounded
        return reach.withColumn("score", rank(self.places)).orderBy(F.col("score").desc(), *ties, "id").limit(k).drop("bound")


class Index:
    """Postings, heads and the manifest under a path."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.manifest = snapshots.Table(spark, f"{self.path}/manifest")

    def _part(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.parts)).cast("int")

    def entries(self) -> list[tuple[str, str | None]]:
        """Segments that count with the names of their batches, in the order in which they came."""
        rows = self.manifest.read()
        return [] if rows is None else [(r.segment, r.name) for r in rows.orderBy("at").collect()]  # a row per batch

    def segments(self) -> list[str]:
        return list(dict.fromkeys(s for s, _ in self.entries()))

    def _swap(self, entries: list[tuple[str, str | None]], base: int) -> None:
        rows = [(i, *e) for i, e in enumerate(entries)]
        self.manifest.replace(self.spark.createDataFrame(rows, "at int, segment string, name string").coalesce(1), base=base)

    def _write(self, packed: DataFrame, heads: DataFrame) -> str:
        """Write packed postings as a segment.

        They are dealt by part; adaptive execution cuts a part that is large (a token that
        every text has) and joins small ones."""
        segment = uuid.uuid4().hex
        rows = packed.hint("rebalance", F.col("part")).mapInArrow(_unpacked, POSTINGS).sortWithinPartitions("part", "token", "id")
        with _writing(self.spark, self.parts):
            rows.write.partitionBy("part").option("compression", "zstd").parquet(f"{self.path}/postings/{segment}")
        heads.write.parquet(f"{self.path}/heads/{segment}")
        return segment

    def add(self, revisions: DataFrame, name: str | None = None) -> str:
        """Index ``id``, ``version``, ``text`` (distinct revisions) as a new segment; returns its name.

        A ``name`` that is known already isn't added again, so a batch may be sent twice."""
        versions, now = self.manifest.versions(), self.entries()
        if name is not None and name in (known := {n: s for s, n in now}):
            return known[name]
        small_batches(self.spark)
        typed = revisions.select(F.col("id").cast("long").alias("id"), F.col("version").cast("int").alias("version"), text.tokens(text.unaccent(F.coalesce("text", F.lit("")))).alias("t"))
        parted = typed.where("id is not null and version is not null").select("*", F.transform("t", self._part).alias("p"))  # no search finds others
        segment = self._write(parted.mapInArrow(_inverted, _PACKED), revisions.select("id", "version"))
        self._swap([*now, (segment, name)], versions[-1] if versions else 0)
        return segment

    def _read(self, kind: str, schema: str, segments: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{s}" for s in segments])

    def heads(self, segments: list[str] | None = None, of: DataFrame | None = None) -> DataFrame:
        """``id`` and its newest ``version``, of all or of the ids in ``of``."""
        rows = self._read("heads", "id long, version int", segments if segments is not None else self.segments())
        rows = rows if of is None else rows.join(of.select("id").distinct(), "id", "left_semi")
        return rows.groupBy("id").agg(F.max("version").alias("version"))

    def postings(self, tokens: list[str], segments: list[str] | None = None) -> DataFrame:
        """Postings of some tokens, read from their parts alone; all versions."""
        segments = segments if segments is not None else self.segments()
        if not segments or not tokens:
            return self.spark.createDataFrame([], POSTINGS)
        parts = [r.p for r in self.spark.createDataFrame([(t,) for t in tokens], "t string").select(self._part(F.col("t")).alias("p")).distinct().collect()]
        found = None
        for s in segments:  # a path of its own each, so that its folders give the part
            one = self._read("postings", POSTINGS, [s]).where(F.col("part").isin(parts) & F.col("token").isin(tokens))
            found = one if found is None else found.unionByName(one)
        return found

    def search(self, words: list[str], phrase: bool = False) -> Hits:
        """Newest revisions that have all ``words``, or have them next to each other in order; no word matches none."""
        tokens = sorted(set(words))
        segments = self.segments()
        grouped = self.postings(tokens, segments).groupBy("id", "version").agg(*[F.first(F.when(F.col("token") == t, F.col("positions")), True).alias(f"p{i}") for i, t in enumerate(tokens)] or [F.lit(0).alias("p")])
        for i in range(len(tokens)):
            grouped = grouped.where(F.col(f"p{i}").isNotNull())
        if phrase and words:
            starts = [_shifted(F.col(f"p{tokens.index(w)}"), k) for k, w in enumerate(words)]
            both = reduce(F.array_intersect, starts)
            grouped = grouped.where(F.size(both) > 0)
        if segments:
            grouped = grouped.join(self.heads(segments, grouped), ["id", "version"], "left_semi")
        return Hits(grouped, tokens)

    def merge(self) -> str | None:
        """Write the newest revisions of all segments as one and swap the manifest; files of the old
        segments stay for searches that have begun, until ``vacuum``."""
        entries, versions = self.entries(), self.manifest.versions()
        now = list(dict.fromkeys(s for s, _ in entries))
        if len(now) < 2:
            return None
        # of a revision that came twice the first segment's postings stay
        heads, rows = None, None
        for i, seg in enumerate(now):
            head = self._read("heads", "id long, version int", [seg]).withColumn("at", F.lit(i))
            one = self._read("postings", POSTINGS, [seg]).withColumn("at", F.lit(i))
            heads, rows = (head, one) if heads is None else (heads.unionByName(head), rows.unionByName(one))
        newest = heads.groupBy("id").agg(F.max(F.struct("version", (-F.col("at")).alias("at"))).alias("n"), F.count("*").alias("k"))
        heads = cut(newest.select("id", "n.version", (-F.col("n.at")).alias("at"), "k"), "postings-heads")
        # only ids that have several revisions have postings that go
        several = heads.where("k > 1").select(F.col("id").alias("i"), F.col("version").alias("v"), F.col("at").alias("a"))
        several = F.broadcast(several) if several.count() <= MOST_SENT else several.hint("shuffle_hash")
        older = (F.col("id") == F.col("i")) & ((F.col("version") != F.col("v")) | (F.col("at") != F.col("a")))
        kept = rows.join(several, older, "left_anti").select("part", "token", "id", "version", "length", "positions")
        segment = self._write(kept.mapInArrow(_gathered, _PACKED), heads.select("id", "version"))
        self._swap([(segment, n) for _, n in entries], versions[-1])
        return segment

    def vacuum(self) -> list[str]:
        """Delete segments that the manifest doesn't name; returns them.  No ``add`` may be under way."""
        fs, path = self.manifest._fs()
        now, gone = set(self.segments()), set()
        for kind in ("postings", "heads"):
            root = path(f"{self.path}/{kind}")
            for f in fs.listStatus(root) if fs.exists(root) else []:
                if (name := f.getPath().getName()) not in now:
                    fs.delete(f.getPath(), True)
                    gone.add(name)
        return sorted(gone)
