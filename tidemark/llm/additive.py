"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is a row of statistics that depend on no language (``FEATURES``).  Bins follow
quantiles over all documents.  The model is a lookup table per statistic and per chosen
pair, learned by cyclic boosting: round after round each table in turn gets the leaves of
a shallow tree fitted to the gradient of the logistic loss.  A score is the intercept plus
one entry of each table, added for whole batches at once.

Learning takes ``Spec.most`` labelled rows at most (those with the least hashes of their
ids); statistics, quantiles and scores cover all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

#: Statistics of a text, in the order of ``measure``.
FEATURES = (
    "words", "word_bytes", "distinct", "commonest", "neighbours", "letterless", "symbols", "exclamations", "stops", "punctuation", "digits", "upper", "other_bytes", "line_words", "twin_lines",
)


@dataclass(frozen=True)
class Spec:
    """How to learn: most labelled rows, bins of a statistic and of a side of a pair, pairs,
    rounds, step, least rows of a leaf, leaves of a tree, and the weight of a leaf's prior."""

    most: int = 40_000
    bins: int = 48
    coarse: int = 8
    pairs: int = 8
    rounds: int = 120
    step: float = 0.2
    least: int = 20
    leaves: int = 4
    prior: float = 4.0


def measure(text: bytes | None) -> list[float]:
    """Statistics of UTF-8 bytes; a null text is an empty one, for which all are 0."""
    data = text or b""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, seen = len(words), Counter(words)
    counts = np.zeros(256, np.int64)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), 1 << 20):  # bounds the copy that bincount makes
        counts += np.bincount(whole[at : at + (1 << 20)], minlength=256)
    of = lambda chars: int(counts[list(chars)].sum())
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    lines = [x for x in data.split(b"\n") if not x.isspace() and x]
    ink = sum(map(len, words))
    letterless = sum(c for w, c in seen.items() if w.isascii() and w.upper() == w.lower())
    beside = sum(map(bytes.__eq__, words[1:], words))
    return [
        float(np.log1p(n)), ink / n, len(seen) / n, max(seen.values()) / n, beside / n, letterless / n, of(b"#*$%&|<>") / n, of(b"!") / n, of(b".?") / n, of(b",;:()\"'-") / n,
        int(counts[48:58].sum()) / ink, upper / max(1, upper + lower), int(counts[128:].sum()) / ink, float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the statistics, a row per row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [measure(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.float32()))], ["doc_id", "x"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return own.mapInArrow(run, "doc_id long, x array<float>")


def edges(stats: DataFrame, bins: int) -> list[np.ndarray]:
    """Per statistic the distinct quantiles over all rows that part its bins."""
    at = [i / bins for i in range(1, bins)]
    found = stats.agg(*[F.percentile_approx(F.get("x", F.lit(i)), at, 2000).alias(f"q{i}") for i in range(len(FEATURES))]).first()
    return [np.unique(np.array(found[f"q{i}"] or [], np.float32)) for i in range(len(FEATURES))]


def binned(x: np.ndarray, parted: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: a value equal to an edge lies in the lower bin."""
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(parted)], axis=1) if len(x) else np.zeros((0, len(parted)), np.int64)


def leaves(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, spec: Spec) -> np.ndarray:
    """A value per bin: the best-first tree of ``spec.leaves`` leaves over ordered bins."""
    parts, sums = [(0, len(rows))], [np.concatenate([[0.0], np.cumsum(v)]) for v in (gradient, weight, rows)]
    score = lambda g, h: g * g / (h + spec.prior)

    def best(a: int, b: int) -> tuple[float, int]:
        g, h, n = (s[a + 1 : b] - s[a] for s in sums)
        whole = [s[b] - s[a] for s in sums]
        if b - a < 2:
            return 0.0, 0
        gain = score(g, h) + score(whole[0] - g, whole[1] - h) - score(whole[0], whole[1])
        gain[(n < spec.least) | (whole[2] - n < spec.least)] = 0
        k = int(gain.argmax())
        return float(gain[k]), a + 1 + k

    while len(parts) < spec.leaves:
        (gain, at), i = max((best(*p), i) for i, p in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, at), (at, b)]
    out = np.zeros(len(rows))
    for a, b in parts:
        out[a:b] = (sums[0][b] - sums[0][a]) / (sums[1][b] - sums[1][a] + spec.prior)
    return out


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


@dataclass(frozen=True)
class Additive:
    """Intercept, edges, a table per statistic, and per pair its edges' coarse bins and table."""

    intercept: float
    parted: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def margin(self, at: np.ndarray) -> np.ndarray:
        """Sum of table entries per row of bin numbers."""
        f = np.full(len(at), self.intercept)
        for i, t in enumerate(self.tables):
            f += t[at[:, i]]
        for i, j, t in self.pairs:
            f += t[self.coarse[i][at[:, i]], self.coarse[j][at[:, j]]]
        return f

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(binned(x, self.parted)))


def _cell_values(f: np.ndarray, y: np.ndarray, cell: np.ndarray, shape: tuple[int, int], spec: Spec) -> np.ndarray:
    """A tree over one side of a pair and one over the other within each of its leaves."""
    p = _sigmoid(f)
    size = shape[0] * shape[1]
    g, h, n = (np.bincount(cell, v, size).reshape(shape) for v in (y - p, p * (1 - p), np.ones(len(y))))
    outer = leaves(g.sum(1), h.sum(1), n.sum(1), spec)
    out = np.zeros(shape)
    for value in np.unique(outer):
        rows = outer == value
        out[rows] = leaves(g[rows].sum(0), h[rows].sum(0), n[rows].sum(0), spec)
    return out


def learn(x: np.ndarray, y: np.ndarray, parted: list[np.ndarray], spec: Spec) -> Additive:
    """Fit tables to rows of statistics and labels 0 and 1.  No rows: a score of one half
    for all; one class only: its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    tables = [np.zeros(len(e) + 1) for e in parted]
    coarse = [(np.arange(len(t)) * spec.coarse // max(spec.coarse, len(t))) for t in tables]
    if not len(y) or y.min() == y.max():
        return Additive(intercept, parted, tables, coarse, [])
    at, f = binned(x, parted), np.full(len(y), intercept)
    for _ in range(spec.rounds):
        for i, t in enumerate(tables):
            p = _sigmoid(f)
            step = spec.step * leaves(*(np.bincount(at[:, i], v, len(t)) for v in (y - p, p * (1 - p), np.ones(len(y)))), spec)
            t += step
            f += step[at[:, i]]
    rough = [c[at[:, i]] for i, c in enumerate(coarse)]
    sides = [int(c[-1]) + 1 for c in coarse]
    cells = lambda i, j: rough[i] * sides[j] + rough[j]

    def gain(i: int, j: int) -> float:
        """What the pair explains of the gradient that single tables leave."""
        p, size = _sigmoid(f), sides[i] * sides[j]
        g, h = np.bincount(cells(i, j), y - p, size), np.bincount(cells(i, j), p * (1 - p), size)
        return float((g * g / (h + spec.prior)).sum())

    ranked = sorted(combinations(range(len(tables)), 2), key=lambda ij: (-gain(*ij), ij))[: spec.pairs]
    pairs = [(i, j, np.zeros((sides[i], sides[j]))) for i, j in ranked]
    for _ in range(spec.rounds):
        for i, j, t in pairs:
            step = spec.step * _cell_values(f, y, cells(i, j), t.shape, spec)
            t += step
            f += step[rough[i], rough[j]]
    return Additive(intercept, parted, tables, coarse, pairs)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: the crc32 of its id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, spec: Spec) -> Additive:
    """A model of ``labels`` (``doc_id``, ``quality``); held-out ids and null labels don't count."""
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") >= 1).cast("int").alias("y"))
    known = known.where(~held_out(F.col("doc_id"))).join(stats, "doc_id")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(spec.most).select("x", "y").toArrow()
    x = np.array(some["x"].to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return learn(x, some["y"].to_numpy().astype(float), edges(stats, spec.bins), spec)


def classify(docs: DataFrame, labels: DataFrame, spec: Spec | None = None) -> DataFrame:
    """Score every document: ``doc_id``, ``held_out``, ``score`` (0 to 1, higher for label 1), ``predicted``.

    Null and empty texts are texts without words.  Repeated rows are scored alike, and
    count as often when they are labelled; a null id has no label and isn't held out; no
    documents give no rows, no labels a score of one half.  Other columns are ignored.
    """
    spec = spec or Spec()
    stats = cut(statistics(docs.select("doc_id", "text")), "quality-statistics")
    model = fit(stats, labels, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
