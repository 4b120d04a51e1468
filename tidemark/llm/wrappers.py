"""Wrapper induction: main text by aligning the pages of a host.

Per host one page is the pivot.  Every distinct page of the host is aligned with
it by simple tree matching (Yang, "Identifying syntactic differences between two
programs", 1991; Zhai and Liu, "Web data extraction based on partial tree
alignment", 2005): the largest order- and ancestor-preserving match of equal nodes,
ties going to equal texts.  A pivot node whose text is the same in nearly all pages
is template, the others are slots.  The host's region is where its slots are: from
the root down to the container that holds most of the text that varies, links not
counted.  The main text of a page is what stands in slots, or in nodes that the pivot
lacks, of that region.  Tags, roles and names (``article``, ``nav``, ``comments``) come
second: they say what is left out inside the region, and stand in for it on hosts
with too few pages and on pages that don't have it.

Alignments are counted as sums per host and pivot node, so a host with a third of
all pages is spread over all tasks, and the result doesn't depend on any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches
from tidemark.llm.html_blocks import BLOCK, Node, clean, dropped, main_part, tree

_SKIP = frozenset("head script style noscript template svg title".split())
_NODE = struct.Struct("<HIIIB")
_LINK, _HOLDS, _WHOLE, _HEADING = 1, 2, 4, 8
#: Elements that may be a region, and those that are one as a whole.
_CONTAINERS = frozenset("#root html body div main article section td table tbody tr center dd li ul ol".split())


@dataclass(frozen=True)
class Wrapper:
    """A node is template if at least ``least`` distinct pages of the host were aligned,
    it was matched in the share ``matched`` of them, and its text was equal in the share ``equal``.
    A host of ``few`` distinct pages has a region: a container is left for one inside
    that holds the share ``held`` of its varying text, but not past an article's or a
    main element's border or away from a heading."""

    least: int = 8
    matched: float = 0.9
    equal: float = 0.9
    few: int = 3
    held: float = 0.6


def skeleton(root: Node) -> tuple[bytes, list[Node]]:
    """Depth, label, own text, its length and flags of every element, and the elements."""
    out, nodes = [], []
    todo = [(root, 0, 0)]
    while todo:
        node, depth, flags = todo.pop()
        own = " ".join(" ".join([k for k in node.kids if isinstance(k, str)]).split())
        flags = flags & _LINK | _LINK * (node.tag == "a") | _HOLDS * (node.tag in _CONTAINERS) | _WHOLE * (node.tag in ("article", "main") or node.role in ("article", "main")) | _HEADING * (node.tag in ("h1", "h2", "h3"))
        out.append(_NODE.pack(min(depth, 65535), zlib.crc32(node.label.encode("utf-8", "replace")), (zlib.crc32(own.encode("utf-8", "replace")) or 1) if own else 0, len(own), flags))
        nodes.append(node)
        todo += [(k, depth + 1, flags) for k in reversed(node.kids) if not isinstance(k, str) and k.tag not in _SKIP]
    return b"".join(out), nodes


class Shape:
    """A skeleton as arrays with parent and children of every node."""

    __slots__ = ("label", "text", "length", "flags", "kids", "parent", "size", "form", "whole")

    def __init__(self, data: bytes):
        rows = list(_NODE.iter_unpack(data))
        self.label, self.text, self.length, self.flags = ([r[k] for r in rows] for k in (1, 2, 3, 4))
        self.kids: list[list[int]] = [[] for _ in rows]
        self.size = [1] * len(rows)
        self.parent = [-1] * len(rows)
        path: list[int] = []
        for i, r in enumerate(rows):
            del path[r[0] :]
            if path:
                self.kids[path[-1]].append(i)
                self.parent[i] = path[-1]
            path.append(i)
        #: equal for subtrees of equal labels, and of equal labels and texts
        self.form, self.whole = [0] * len(rows), [0] * len(rows)
        for i in range(len(rows) - 1, -1, -1):
            kids = self.kids[i]
            self.form[i] = hash((self.label[i], *[self.form[k] for k in kids]))
            self.whole[i] = hash((self.label[i], self.text[i], *[self.whole[k] for k in kids]))
            if self.parent[i] >= 0:
                self.size[self.parent[i]] += self.size[i]


_FULL = 1 << 20
#: Tables of so many cells are lists, larger ones arrays; both hold the same numbers.
_CELLS = 1024


def _rows(weights: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
    """Rows of the table of best order-preserving matches, ``first`` and one per element."""
    out = [first]
    for w in weights:
        last = out[-1]
        if isinstance(w, list):
            row, left = [0], 0
            for k, x in enumerate(w):
                left = max(last[k + 1], last[k] + x, left)
                row.append(left)
            out.append(row)
            continue
        row = last.copy()
        np.maximum(last[1:], last[:-1] + w, out=row[1:])
        out.append(np.maximum.accumulate(row))
    return out


def _best(weights: list[np.ndarray], m: int) -> list[tuple[int, int]]:
    """Pairs of the best match of ``len(weights)`` elements with ``m`` others.

    Rows are kept at every so many elements and made again from there on the way back,
    so memory grows with the length times its root only; the result is that of the whole table."""
    step = max(64, isqrt(len(weights)) + 1)
    starts = [[0] * (m + 1) if isinstance(weights[0], list) else np.zeros(m + 1, np.int64)]
    for at in range(0, len(weights) - step, step):
        starts.append(_rows(weights[at : at + step], starts[-1])[-1])
    found, j = [], m
    for at in range(len(starts) - 1, -1, -1):
        part = weights[at * step : (at + 1) * step]
        rows = _rows(part, starts[at])
        i = len(part)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((at * step + i, j))
    return found


def align(a: Shape, b: Shape) -> dict[int, int]:
    """Simple tree matching: nodes of ``b`` to nodes of ``a``.

    The match has as many nodes as any; of equally large ones that of two children goes
    to equal texts and equal subtrees.  How many nodes two subtrees match depends on
    their labels alone, so it is counted once per pair of forms, without recursion.
    """
    counted: dict[tuple[int, int], int] = {}

    def apart(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """A pair of nodes for every pair of forms with one label that isn't counted yet."""
        ours, theirs = {a.form[i]: i for i in x}, {b.form[j]: j for j in y}
        return [(i, j) for f, i in ours.items() if a.kids[i] for g, j in theirs.items() if f != g and a.label[i] == b.label[j] and b.kids[j] and (f, g) not in counted]

    def value(i: int, j: int) -> int:
        """Nodes that two subtrees match."""
        if a.label[i] != b.label[j]:
            return 0
        if a.form[i] == b.form[j]:
            return a.size[i]
        return counted[a.form[i], b.form[j]] if a.kids[i] and b.kids[j] else 1

    def weigh(x: list[int], y: list[int], texts: bool) -> list[np.ndarray]:
        """A row of weights per element of ``x``; made once per form unless ``texts`` count."""
        if len(x) * len(y) <= _CELLS:
            rows = [[value(i, j) for j in y] for i in x]
            if not texts:
                return rows
            own = [(b.text[j], b.whole[j]) for j in y]
            return [[w and w * _FULL + (t == a.text[i] != 0) + (s == a.whole[i]) for w, (t, s) in zip(row, own, strict=True)] for i, row in zip(x, rows, strict=True)]
        made: dict[int, np.ndarray] = {}
        out = []
        text, whole = (np.array([v[j] for j in y], np.int64) for v in (b.text, b.whole)) if texts else (None, None)
        for i in x:
            f = a.form[i]
            if f not in made:
                made[f] = np.array([value(i, j) for j in y], np.int64)
            w = made[f]
            if texts:
                w = w * _FULL + (w > 0) * ((text == a.text[i]) * bool(a.text[i]) + (whole == a.whole[i]))
            out.append(w)
        return out

    def count(i: int, j: int) -> None:
        todo = [(i, j)]
        while todo:
            i, j = todo[-1]
            key = (a.form[i], b.form[j])
            if key in counted:
                todo.pop()
            elif more := apart(a.kids[i], b.kids[j]):
                todo += more
            else:
                counted[key] = 1 + int(_last(weigh(a.kids[i], b.kids[j], False)))

    def table(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        # equal subtrees at either end may be matched at once: no other match of theirs is larger
        lo = 0
        while lo < min(len(x), len(y)) and a.whole[x[lo]] == b.whole[y[lo]]:
            lo += 1
        hi = 0
        while hi < min(len(x), len(y)) - lo and a.whole[x[-1 - hi]] == b.whole[y[-1 - hi]]:
            hi += 1
        found = [(x[k], y[k]) for k in range(lo)] + [(x[-1 - k], y[-1 - k]) for k in range(hi)]
        x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
        if x and y:
            for i, j in apart(x, y):
                count(i, j)
            found += [(x[i], y[j]) for i, j in _best(weigh(x, y, True), len(y))]
        return found

    pairs: dict[int, int] = {}
    todo = [(0, 0)] if a.label and b.label and a.label[0] == b.label[0] else []
    while todo:
        i, j = todo.pop()
        pairs[j] = i
        if a.kids[i] and b.kids[j]:
            todo += table(a.kids[i], b.kids[j])
    return pairs


def _last(weights: list[np.ndarray]) -> int:
    """The weight of the best match; two rows are kept."""
    if isinstance(weights[0], list):
        return _rows(weights, [0] * (len(weights[0]) + 1))[-1][-1]
    last = np.zeros(len(weights[0]) + 1, np.int64)
    for w in weights:
        row = last.copy()
        np.maximum(last[1:], last[:-1] + w, out=row[1:])
        last = np.maximum.accumulate(row)
    return last[-1]


def slots(pivot: Shape, page: Shape, pairs: dict[int, int]) -> dict[int, int]:
    """Characters of a page's varying text by pivot node; text of nodes that the pivot lacks
    counts for the node above them, links don't count."""
    out: dict[int, int] = {}
    top = [-1] * len(page.label)
    for j, n in enumerate(page.length):
        i = pairs.get(j, -1)
        top[j] = i if i >= 0 else top[page.parent[j]] if page.parent[j] >= 0 else -1
        if n and top[j] >= 0 and not page.flags[j] & _LINK and not (i >= 0 and pivot.text[i] == page.text[j]):
            out[top[j]] = out.get(top[j], 0) + n
    return out


def region(pivot: Shape, chars: dict[int, int], held: float) -> int:
    """The pivot node that holds most of the varying text; 0 is the root."""
    total = [chars.get(i, 0) for i in range(len(pivot.label))]
    for i in range(len(total) - 1, 0, -1):
        total[pivot.parent[i]] += total[i]
    at = 0
    while not pivot.flags[at] & _WHOLE and not any(pivot.flags[k] & _HEADING and total[k] for k in pivot.kids[at]):
        inside = [k for k in pivot.kids[at] if pivot.flags[k] & _HOLDS and total[k] >= held * total[at] > 0]
        if not inside:
            break
        at = inside[0]
    return at


def blocks(parts: list[Node], template: set[int] = frozenset()) -> list[str]:
    """Texts of the parts' blocks in page order; ``template`` holds the ``id()`` of nodes to leave out.

    A ``header`` inside an article or a main element is the article's own and stays."""
    out: list[str] = []
    runs: list[str] = []

    def flush() -> None:
        if runs:
            if text := clean(runs):
                out.append(text)
            runs.clear()

    for part in parts:
        headed = part.tag in ("article", "main") or part.role in ("article", "main")
        todo: list[tuple[object, bool]] = [(part, False)]
        while todo:
            x, ends = todo.pop()
            if isinstance(x, str):
                runs.append(x)
            elif ends:
                flush()
            elif x is part or not dropped(x) or headed and x.tag == "header" and not (x.hidden or x.role):
                if x.tag == "br":
                    runs.append(" ")
                    continue
                if x.tag in BLOCK:
                    flush()
                    todo.append((x, True))
                hide = id(x) in template
                todo += [(k, False) for k in reversed(x.kids) if not (hide and isinstance(k, str))]
        flush()
    return out


def _host(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def templates(pages: DataFrame, wrapper: Wrapper = Wrapper()) -> DataFrame:
    """``host``, ``pivot`` (a skeleton), ``fixed`` (its template nodes) and ``slots`` (characters of
    varying text per pivot node), for hosts with ``few`` distinct pages.

    ``pages`` has ``host`` and ``html``; pages without a host take no part.
    """
    small_batches(pages.sparkSession, rows=256)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([skeleton(tree(h))[0] for h in b.column(1).to_pylist()], pa.binary())], ["host", "shape"])

    own = pages.where("host <> '' and html <> ''").select("host", "html")
    distinct = cut(own.mapInArrow(shapes, "host string, shape binary").distinct(), "wrap-shapes")
    pivots = distinct.groupBy("host").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("shape").alias("h"), "shape")).alias("p"))
    pivots = cut(pivots.where(F.col("n") >= wrapper.few).select("host", "n", F.col("p.shape").alias("pivot")), "wrap-pivots")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[bytes, Shape | None] = (b"", None)
        for b in batches:
            sums: dict[tuple[str, int], list[int]] = {}
            for r in b.to_pylist():
                if r["pivot"] != known[0]:
                    known = (r["pivot"], Shape(r["pivot"]))
                a, page = known[1], Shape(r["shape"])
                pairs = align(a, page)
                for j, i in pairs.items():
                    if a.text[i]:
                        s = sums.setdefault((r["host"], i), [0, 0, 0])
                        s[0] += 1
                        s[1] += a.text[i] == page.text[j]
                for i, n in slots(a, page, pairs).items():
                    sums.setdefault((r["host"], i), [0, 0, 0])[2] += n
            columns = [pa.array([h for h, _ in sums], pa.string()), pa.array([i for _, i in sums], pa.int32()), *[pa.array([s[k] for s in sums.values()], pa.int64()) for k in range(3)]]
            yield pa.RecordBatch.from_arrays(columns, ["host", "node", "hits", "equal", "chars"])

    counts = distinct.join(pivots, "host").select("host", "shape", "pivot").mapInArrow(matched, "host string, node int, hits long, equal long, chars long")
    counts = counts.groupBy("host", "node").agg(*[F.sum(c).alias(c) for c in ("hits", "equal", "chars")])
    fixed = (F.col("n") >= wrapper.least) & (F.col("hits") > 0) & (F.col("hits") >= wrapper.matched * F.col("n")) & (F.col("equal") >= wrapper.equal * F.col("hits"))
    per = counts.join(pivots.select("host", "n"), "host").groupBy("host").agg(F.sort_array(F.collect_list(F.when(fixed, F.col("node")))).alias("fixed"), F.sort_array(F.collect_list(F.when(F.col("chars") > 0, F.struct("node", "chars")))).alias("slots"))
    return cut(per.join(pivots.select("host", "pivot"), "host").select("host", "pivot", "fixed", "slots"), "wrap-templates")


def extract(pages: DataFrame, wrapper: Wrapper = Wrapper()) -> DataFrame:
    """Main text of every page.

    Returns ``page_id``, ``url``, ``text`` (blocks joined by two line feeds, empty
    if there is none) and ``n_chars``.  Null pages are empty; broken markup is read
    as far as it goes; pages of null or odd URLs have no template; repeated rows
    stay; an empty table gives an empty one; other columns are ignored.
    """
    small_batches(pages.sparkSession, rows=256)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), _host(F.col("url").cast("string")).alias("host"))
    learned = templates(own, wrapper)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[bytes, Shape | None, int] = (b"", None, 0)
        for b in batches:
            texts = []
            for page, pivot, fixed, varying in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                root, hide, parts = tree(page), set(), None
                if pivot is not None:
                    if pivot != known[0]:
                        shape = Shape(pivot)
                        known = (pivot, shape, region(shape, {s["node"]: s["chars"] for s in varying}, wrapper.held))
                    data, nodes = skeleton(root)
                    gone, shape = set(fixed), Shape(data)
                    pairs = align(known[1], shape)
                    hide = {id(nodes[j]) for j, i in pairs.items() if i in gone and shape.text[j] == known[1].text[i]}
                    parts = [nodes[j] for j, i in pairs.items() if i == known[2] > 0]
                texts.append("\n\n".join(blocks(parts or main_part(root), hide)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    both = own.join(learned, "host", "left").select("page_id", "url", "html", "pivot", "fixed", "slots")
    return both.mapInArrow(run, "page_id long, url string, text string, n_chars long")
