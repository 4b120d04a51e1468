"""SentencePiece encoding and decoding over a table of distinct chunks.

Texts are cut into chunks that no piece of the model crosses (blanks that lead a
word stay with it), so the best segmentation of a text is that of its chunks.
Distinct chunks of the corpus are a grouping; each is segmented once, by Viterbi over
the lattice of its pieces, and decoded again from its ids, in Arrow batches.  ``decode``
joins the ids of any rows to pieces.

Chunks of a text are joined to the chunk table by chunk: those of the most
frequent chunks, a bounded number of bounded length, by a broadcast, all others by
a shuffle, so neither common nor rare words gather anywhere and no text is moved.

``coded`` encodes and decodes whole texts where they lie, and moves neither texts nor
ids; a worker keeps the ids of a bounded number of chunks.

Scores are the model's.  A model is encoded as the library does if it is loaded with its
own kind: by Viterbi, or by merges.  Without it the pieces of a merge model are read as a
unigram model (the library agrees when its copy of the file is marked so), which isn't
the order in which the library would merge.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, small_batches

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
#: Pieces and broadcast chunks are bounded by these numbers.
MOST_PIECES = 1 << 20
HOT_CHUNKS = 1 << 18
HOT_LENGTH = 32
#: Longer chunks are known by their digest.
KEY_LENGTH = 64
#: Chunks whose ids a worker keeps, in each of two generations.
KEPT_CHUNKS = 1 << 19
#: Added to the code point of a character that is no piece, in the place of an id.
NO_PIECE = 1 << 21
_UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Model:
    """What encoding needs of a model file: pieces with scores and types, and the normaliser's switches."""

    pieces: tuple[tuple[str, float, int], ...]
    dummy_prefix: bool = True
    squeeze: bool = False
    merges: bool = False

    @classmethod
    def load(cls, path: str, own_kind: bool = False) -> Model:
        """Read a model file on the driver; normalisers with a character map are refused.

        With ``own_kind`` a merge model is encoded by merges, else any model by Viterbi."""
        pieces, rules, kind = [], {}, 1
        with open(path, "rb") as f:
            message = f.read()
        for number, value in _fields(message):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif number == 3:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("models whose normaliser has a character map aren't supported")
        if own_kind and (kind > 2 or kind == 2 and any(k in (USER, UNUSED) for _, _, k in pieces)):
            raise ValueError("word and character models, and merge models with user-defined or unused pieces, aren't supported")
        return cls(tuple(pieces), bool(rules.get(3, 1)), bool(rules.get(4, 1)), own_kind and kind == 2)

    @property
    def matching(self) -> list[tuple[str, int, float]]:
        return [(p, i, s) for i, (p, s, k) in enumerate(self.pieces) if k in (NORMAL, USER, UNUSED) and p]

    @property
    def said(self) -> list[bytes]:
        """What the piece of every id says."""
        return [p.encode() if k in (NORMAL, USER, UNUSED) else bytes.fromhex(p[3:5]) if k == BYTE else b"" for p, _, k in self.pieces]

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def first_byte(self) -> int | None:
        """Id of the piece of byte 0; those of the other bytes follow it."""
        at = next((i for i, p in enumerate(self.pieces) if p[2] == BYTE), None)
        if at is not None and [p[0] for p in self.pieces[at : at + 256]] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError("byte pieces must stand in order")
        return at

    @property
    def unknown_score(self) -> float:
        return min((s for _, s, k in self.pieces if k == NORMAL), default=0.0) - _UNKNOWN_PENALTY

    def chunk_pattern(self) -> str:
        """Chunks: line feeds and tabs, and runs that start with blanks; checked against the pieces."""
        for p, _, _ in self.matching:
            if len(p) > 1 and re.search(rf"[\n\t]|[^{BLANK}]{BLANK}", p):
                raise ValueError(f"the piece {p!r} crosses chunks")
        return rf"[\n\t]|{BLANK}*[^{BLANK}\n\t]+|{BLANK}+"


def _marked(text: Column, model: Model) -> Column:
    """``text`` in the model's form; null and empty: empty."""
    text = F.coalesce(text, F.lit(""))
    if model.squeeze:
        text = F.trim(F.regexp_replace(text, " +", " "))
    marked = F.concat(F.lit(BLANK if model.dummy_prefix else ""), F.replace(text, F.lit(" "), F.lit(BLANK)))
    return F.when(text == "", "").otherwise(marked)


def chunks_of(text: Column, model: Model) -> Column:
    return F.regexp_extract_all(_marked(text, model), F.lit(model.chunk_pattern()), F.lit(0))


def _key(chunk: Column) -> Column:
    return F.when(F.length(chunk) <= KEY_LENGTH, chunk).otherwise(F.concat(F.lit("\x00"), F.sha2(chunk, 256)))


def segmented(chunk: str, table: dict[str, tuple[int, float]], longest: int, lost: float) -> list[int]:
    """Viterbi over the lattice of a chunk's pieces: the names of the best path's edges in page order.

    A character that is no piece is an edge of its own, named by its code point over
    ``NO_PIECE``.  Of equal scores the earlier start, that is the longer last piece, stays.
    """
    n = len(chunk)
    best, start, name = [0.0] + [-inf] * n, [0] * (n + 1), [0] * (n + 1)
    for s in range(n):
        for e in range(s + 1, min(n, s + longest) + 1):
            found = table.get(chunk[s:e])
            if found is None:
                if e > s + 1:
                    continue
                found = NO_PIECE + ord(chunk[s]), lost
            score = best[s] + found[1]
            if score > best[e]:
                best[e], start[e], name[e] = score, s, found[0]
    out, e = [], n
    while e:
        out.append(name[e])
        e = start[e]
    return out[::-1]


def merged(chunk: str, table: dict[str, tuple[int, float]]) -> list[int]:
    """Merges of neighbours into pieces, the best score first, then the leftmost: the names of what
    is left in page order.  A character that is no piece is named by its code point over ``NO_PIECE``."""
    parts, n = list(chunk), len(chunk)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(-found[1], i, 2) for i in range(n - 1) if (found := table.get(chunk[i : i + 2]))]
    heapify(heap)
    while heap:
        _, i, size = heappop(heap)
        j = right[i]
        if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one of them was merged since
        parts[i], parts[j], right[i] = parts[i] + parts[j], "", right[j]
        if right[i] < n:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < n and (found := table.get(both := parts[a] + parts[b])):
                heappush(heap, (-found[1], a, len(both)))
    return [table[p][0] if p in table else NO_PIECE + ord(p) for p in parts if p]


def _speller(model: Model) -> Callable[[str], list[int]]:
    """What gives the ids of a chunk."""
    table = {p: (i, s) for p, i, s in model.matching}
    longest, lost, first = max(map(len, table), default=1), model.unknown_score, model.first_byte

    def spelt(name: int) -> list[int]:
        """A character that is no piece is its UTF-8 bytes, if the model has them."""
        return [name] if name < NO_PIECE else [model.unknown] if first is None else [first + x for x in chr(name - NO_PIECE).encode()]

    def ids(chunk: str) -> list[int]:
        path = merged(chunk, table) if model.merges else segmented(chunk, table, longest, lost)
        return path if max(path) < NO_PIECE else [i for x in path for i in spelt(x)]

    return ids


class _Chunks(dict):
    """Ids of chunks as bytes, in two generations of bounded size: chunks that are met again stay."""

    def __init__(self, model: Model):
        super().__init__()
        self.ids, self.old = _speller(model), {}

    def __missing__(self, chunk: str) -> bytes:
        out = self.old.get(chunk)
        if out is None:
            out = array("i", self.ids(chunk)).tobytes()
        if len(chunk) <= HOT_LENGTH:
            if len(self) >= KEPT_CHUNKS:
                self.old = dict(self)
                self.clear()
            self[chunk] = out
        return out


@lru_cache(maxsize=1)
def _chunks(model: Model) -> _Chunks:
    """A worker's chunks, which outlive a task."""
    return _Chunks(model)


def coded(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every whole text encoded and its ids decoded: ``keep``, ``doc_id``, ``n_chunks``, ``ids``, ``decoded``
    (the text that the ids of the row say) and ``exact`` (whether that is the row's text, byte by byte).

    A row per row of ``docs``; null is as empty.  Texts are split, encoded and decoded in the
    task that reads them."""
    small_batches(docs.sparkSession, rows=256, mb=4)
    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("raw"), F.col(id_col).cast("long").alias("doc_id"), *keep)
    kept = rows.drop("raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, said, find = _chunks(model), model.said, re.compile(model.chunk_pattern()).findall
        prefix = BLANK if model.dummy_prefix else ""
        for b in batches:
            raws, n_chunks, ids, texts = [x or b"" for x in b.column(0).to_pylist()], [], [], []
            for raw in raws:
                text = raw.decode(errors="replace")
                if model.squeeze:
                    text = re.sub(" +", " ", text).strip(" ")
                own = find(prefix + text.replace(" ", BLANK)) if text else []
                n_chunks.append(len(own))
                ids.append(np.frombuffer(b"".join(map(chunks.__getitem__, own)), np.int32))
                texts.append(b"".join(map(said.__getitem__, ids[-1].tolist())).decode(errors="replace").replace(BLANK, " ")[len(prefix) :])
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
            exact = [text.encode() == raw for text, raw in zip(texts, raws, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n_chunks, pa.int64()), listed, pa.array(texts, pa.string()), pa.array(exact, pa.bool_())], [*b.schema.names[1:], "n_chunks", "ids", "decoded", "exact"])

    out = rows.mapInArrow(run, T.StructType(kept.schema.fields).add("n_chunks", "long").add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string").add("exact", "boolean"))
    return out.select(*keep, "doc_id", "n_chunks", "ids", "decoded", "exact")


def decode(tokens: DataFrame, model: Model, keys: list[str], carry: tuple[str, ...] = (), marked: bool = False) -> DataFrame:
    """``keys``, ``carry`` and ``text``, the text of the ids in the array column ``ids``.

    ``keys`` name a row of ``tokens``.  Control and unknown pieces say nothing, null
    and empty arrays give an empty text, and bytes that are no UTF-8 become U+FFFD.
    The blank that encoding puts before a text is part of the result; ``marked`` leaves
    blanks in the model's form.
    """
    said = [(i, x.hex().upper()) for i, x in enumerate(model.said)]
    table = F.broadcast(tokens.sparkSession.createDataFrame(said, "id int, said string"))
    # what is carried goes with the first id alone, as it may be as long as the ids
    own = F.struct(*carry) if carry else F.struct(F.lit(True).alias("none"))
    listed = F.transform("ids", lambda x, i: F.struct(x.alias("id"), F.when(i == 0, own).alias("own")))
    listed = F.when(F.size("ids") > 0, listed).otherwise(F.array(F.struct(F.lit(None).cast("int").alias("id"), own.alias("own"))))
    rows = tokens.select(*keys, F.posexplode(listed).alias("at", "x")).select(*keys, "at", "x.id", "x.own").join(table, "id", "left")
    parts = rows.groupBy(*keys).agg(*[F.first("own", ignorenulls=True)[c].alias(c) for c in carry], F.sort_array(F.collect_list(F.struct("at", "said"))).alias("parts"))
    text = F.make_valid_utf8(F.unhex(F.array_join(F.transform("parts", lambda p: F.coalesce(p["said"], F.lit(""))), "")).cast("string"))
    return parts.select(*keys, *carry, (text if marked else F.translate(text, BLANK, " ")).alias("text"))


def _encoded(words: DataFrame, model: Model) -> DataFrame:
    """``key``, ``n``, ``ids`` of distinct chunks (``key``, ``word``, ``n``), and ``said``, what their ids decode to."""
    if len(model.pieces) > MOST_PIECES:
        raise ValueError(f"more than {MOST_PIECES} pieces")
    small_batches(words.sparkSession, rows=8192)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, said = _speller(model), model.said
        for b in batches:
            ids = [spell(w.decode(errors="replace")) for w in b.column(1).cast(pa.binary()).to_pylist()]
            texts = [b"".join([said[i] for i in x]).decode(errors="replace") for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())], ["key", "n", "ids", "said"])

    return words.select("key", "word", "n").mapInArrow(run, "key string, n long, ids array<int>, said string")


def vocabulary(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every distinct chunk of the corpus: ``key``, ``n`` (its count), ``ids``, ``n_ids``, ``hash``
    (of the ids), ``exact`` (whether decoding gives the chunk back) and ``n_decoded`` (the
    characters that decoding gives)."""
    words = docs.select(F.explode(chunks_of(F.col(text_col).cast("string"), model)).alias("word"))
    words = words.groupBy("word").agg(F.count("*").alias("n")).select(_key(F.col("word")).alias("key"), "word", "n")
    both = _encoded(words, model)
    exact = (_key(F.col("said")) == F.col("key")).alias("exact")
    return cut(both.select("key", "n", "ids", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("hash"), exact, F.length("said").alias("n_decoded")), "pieces-vocabulary")


def _hot(vocabulary_: DataFrame) -> Column:
    """Condition for the chunks to broadcast: ``HOT_CHUNKS`` of ``HOT_LENGTH`` at most."""
    grade = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    short = F.length("key") <= HOT_LENGTH
    counts = sorted(vocabulary_.where(short).groupBy(grade.alias("g")).count().collect(), reverse=True)
    least, total = 1 << 10, 0
    for g, n in counts:
        total += n
        if total > HOT_CHUNKS:
            break
        least = g
    return short & (grade >= least)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ("ids",), known: DataFrame | None = None, carry: tuple[str, ...] = (), apart: Column | None = None) -> DataFrame:
    """Tokens of every text in relational form: one row per chunk.

    Returns ``doc_id``, ``rk`` (``apart``, or a hash of the text; with ``doc_id`` it tells rows
    apart whose ids are null or repeat), ``carry``, ``at`` (the chunk's place in the text) and
    ``columns`` of the vocabulary, which is made unless it is ``known``.  Texts in order
    of ``at`` give the ids of a text; null and empty texts have no row; a repeated row
    repeats its chunks; an empty table gives an empty one; other columns are ignored.
    """
    known = vocabulary(docs, model, text_col) if known is None else known
    text, own = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    rows = docs.select((F.xxhash64(text) if apart is None else apart).alias("rk"), own.alias("doc_id"), *carry, chunks_of(text, model).alias("words"))
    rows = rows.select("rk", "doc_id", *carry, F.posexplode("words").alias("at", "word"))  # a text is hashed once, not per chunk
    rows = rows.select("rk", "doc_id", *carry, "at", _key(F.col("word")).alias("key"))
    hot = _hot(known)
    common, rare = F.broadcast(known.where(hot).select("key", *columns)), known.where(~hot).select("key", *columns)
    names = ["doc_id", "rk", *carry, "at", *columns]
    return rows.join(common, "key").select(names).unionByName(rows.join(common.select("key"), "key", "left_anti").join(rare.hint("shuffle_hash"), "key").select(names))


def gather(tokens: DataFrame) -> DataFrame:
    """``rk``, ``doc_id`` and ``ids`` of whole texts from the rows of :func:`encode`; moves all ids once."""
    lists = tokens.groupBy("rk", "doc_id").agg(F.sort_array(F.collect_set(F.struct("at", "ids"))).alias("parts"))
    return lists.select("rk", "doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def digests(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document ``n_chunks``, ``n_tokens``, ``ids_hash`` (depends on ids and their order),
    ``n_decoded`` (characters that its ids decode to, in the model's form) and ``exact`` (decoding
    its ids gives its text back: every chunk in its place comes back, and together they are as
    long as the text, so none is missing); a row per row of ``docs``, empty texts count 0.

    Rows are told apart by their id and, if an id is null or has several texts, a hash of
    their text, and those without an id by two hashes of it."""
    text = F.col(text_col).cast("string")
    own = F.col(id_col).cast("long")
    named = F.coalesce(own, F.xxhash64(F.lit("no id"), text))
    texts = docs.groupBy(own.alias("id")).agg(F.min(F.xxhash64(text)).alias("x"), F.max(F.xxhash64(text)).alias("y"))
    apart = F.lit(0).cast("long") if texts.where("id is null or x <> y").isEmpty() else F.xxhash64(text)  # eight bytes of every chunk that is moved
    tokens = encode(docs.select(named.alias("doc_id"), text.alias("text")), model, columns=("n_ids", "hash", "exact", "n_decoded"), apart=apart)
    times = F.sum((F.col("at") == 0).cast("long"))  # repeated rows share a key
    whole = lambda x: F.call_function("div", x, times)
    part = F.xxhash64("at", "hash").bitwiseAND(F.lit(0x7FFFFFFF))
    per = tokens.groupBy("doc_id", "rk").agg(whole(F.count("*")).alias("n_chunks"), whole(F.sum("n_ids")).alias("n_tokens"), whole(F.sum(part)).alias("ids_hash"), F.min("exact").alias("exact"), whole(F.sum("n_decoded")).alias("n_decoded"))
    per = cut(per.withColumnsRenamed({"doc_id": "__id", "rk": "__rk"}), "pieces-digests")
    lost = F.coalesce(text.contains(BLANK) | (F.lit(model.squeeze) & text.rlike("^ | $|  ")), F.lit(False))  # these blanks can't be told apart
    rows = docs.select(*keep, own.alias("doc_id"), named.alias("__n"), apart.alias("__k"), lost.alias("__lost"), F.length(_marked(text, model)).cast("long").alias("__chars"))
    rows = rows.join(per, (F.col("__k") == F.col("__rk")) & (F.col("__n") == F.col("__id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.select(*keep, "doc_id", zero("n_chunks"), zero("n_tokens"), zero("ids_hash"), zero("n_decoded"), (F.coalesce("exact", F.lit(True)) & ~F.col("__lost") & (F.coalesce("n_decoded", F.lit(0)) == F.col("__chars"))).alias("exact"))
