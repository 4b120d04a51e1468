"""Writing in blocks: the same block once, a refused block row by row, partials compacted.

A block is a run of rows of one part in a fixed order, so rows that are sent again make
the same blocks, whatever batch they come in.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import bars
from tidemark.sources import snapshots

#: Rows of a block at most, parts that symbols are dealt to, and digests that are remembered.
SIZE, PARTS, REMEMBERED = 5_000, 8, 100


def numbered(rows: DataFrame, key: str, order: Sequence[str], size: int = SIZE, parts: int = PARTS) -> DataFrame:
    """``rows`` with ``part`` (a hash of ``key``) and ``block``: runs of ``size`` rows of a part by ``order``."""
    placed = rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return placed.withColumn("block", F.floor((place - 1) / size).cast("int"))


def digests(blocks: DataFrame) -> DataFrame:
    """``part``, ``block``, ``digest``: count and two sums over hashes of all columns' texts."""
    own = [c for c in blocks.columns if c not in ("part", "block")]
    said = F.to_json(F.struct(*own))
    one, two = F.xxhash64(F.lit(1), said), F.xxhash64(F.lit(2), said)
    sums = blocks.groupBy("part", "block").agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(two.cast("decimal(38,0)")).alias("s"))
    return sums.select("part", "block", F.sha1(F.concat_ws(":", "n", "x", "s")).alias("digest"))


class Ledger:
    """The last blocks of each table, by content, with the batch that wrote them."""

    def __init__(self, spark: SparkSession, path: str, remembered: int = REMEMBERED):
        self.spark, self.remembered = spark, remembered
        self.table = snapshots.Table(spark, path)

    def fresh(self, blocks: dict[str, DataFrame], batch: int) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
        """Of each table's numbered rows those of blocks that no other batch wrote, and the names and
        digests of these; what this batch itself has noted is written again, as its files are."""
        each = [digests(rows).select(F.lit(name).alias("name"), "part", "block", "digest") for name, rows in blocks.items()]
        found = reduce(DataFrame.unionByName, each).collect()  # a row per block
        known = self.table.read()
        known = set() if known is None else {(r.name, r.digest) for r in known.where(F.col("batch") != batch).select("name", "digest").collect()}  # of bounded number
        out = {}
        for name, rows in blocks.items():
            if sent := [(r.part, r.block) for r in found if r.name == name and (name, r.digest) in known]:
                rows = rows.join(F.broadcast(self.spark.createDataFrame(sent, "part int, block int")), ["part", "block"], "left_anti")
            out[name] = rows.drop("part", "block")
        return out, sorted({(r.name, r.digest) for r in found} - known)

    def note(self, found: list[tuple[str, str]], batch: int) -> None:
        """Remember a batch's blocks after its rows are written; the oldest of each table go."""
        versions, known = self.table.versions(), self.table.read()
        rows = self.spark.createDataFrame([(*x, batch) for x in found], "name string, digest string, batch long")
        rows = rows if known is None else rows.unionByName(known.where(F.col("batch") != batch))
        place = F.row_number().over(Window.partitionBy("name").orderBy(F.col("batch").desc(), "digest"))
        kept = rows.withColumn("n", place).where(F.col("n") <= self.remembered).drop("n")
        self.table.replace(kept.coalesce(1), base=versions[-1] if versions else 0)


#: Errors of the way to a sink, after which the same block is sent again.
TRANSIENT = (ConnectionError, TimeoutError)
SENT = "sent long, tries long, row string, error string"


def deliver(rows: DataFrame, send: Callable[[list[dict]], None], size: int = SIZE, transient: tuple[type[BaseException], ...] = TRANSIENT, waits: Sequence[float] = (0.5, 1, 2, 4)) -> DataFrame:
    """Send rows to a sink in blocks, from the tasks that hold them; returns one row per block (``sent``,
    ``tries``) and one per row that the sink refuses (``row`` as JSON, ``error``).

    ``send`` takes a block or raises.  After a ``transient`` error the whole block is sent
    again, with a pause, and the task fails after the last one.  Any other error is the
    data's: the block is halved, first half first, until a single row is refused, and all
    others are written.  Nothing happens before an action on the result; a task that Spark
    runs again sends again, so a sink should know blocks by their contents.
    """

    def attempt(block: list[dict]) -> int:
        for tries, wait in enumerate((*waits, None), 1):
            try:
                send(block)
                return tries
            except transient:
                if wait is None:
                    raise
                time.sleep(wait)
        raise AssertionError

    def isolate(block: list[dict]) -> Iterator[tuple]:
        todo, sent, tries = [block], 0, 0
        while todo:
            now = todo.pop()
            try:
                tries += attempt(now)
                sent += len(now)
            except transient:
                raise
            except Exception as e:  # noqa: BLE001 - whatever the sink says of its data
                tries += 1
                if len(now) == 1:
                    yield None, None, pd.Series(now[0]).to_json(date_format="iso", default_handler=str), f"{type(e).__name__}: {e}"
                else:
                    todo += [now[len(now) // 2 :], now[: len(now) // 2]]
        yield sent, tries, None, None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        for part in parts:
            held += part.to_dict("records")
            while len(held) >= size:
                yield pd.DataFrame(list(isolate(held[:size])), columns=["sent", "tries", "row", "error"], dtype=object)
                held = held[size:]
        if held:
            yield pd.DataFrame(list(isolate(held)), columns=["sent", "tries", "row", "error"], dtype=object)

    return rows.mapInPandas(run, SENT)


class Partials:
    """Partial bars of batches, compacted in levels behind a manifest.

    A batch writes a folder of its own.  ``compact`` merges folders of batches that can't
    be written again into one of level 1, and as many of one level into one of the next,
    so a reader opens a number of folders that grows with the logarithm of the batches.
    The manifest is swapped last; folders that it no longer names stay until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ("symbol", "slot"), fan: int = 8):
        self.spark, self.root, self.keys, self.fan = spark, root.rstrip("/"), list(keys), fan
        self.manifest = snapshots.Table(spark, f"{self.root}/manifest")

    def add(self, batch: int, partials: DataFrame) -> None:
        partials.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def _levels(self) -> list[tuple[int, str, int, int]]:
        """Compacted folders: level, name, first and last batch."""
        rows = self.manifest.read()
        return [] if rows is None else [tuple(r) for r in rows.select("level", "name", "since", "until").orderBy("since").collect()]  # a row per folder

    def _batches(self, after: int) -> list[int]:
        fs, path = self.manifest._fs()
        found = [s.getPath().getName() for s in fs.listStatus(path(self.root))] if fs.exists(path(self.root)) else []
        numbers = [int(n[6:]) for n in found if n.startswith("batch=") and fs.exists(path(f"{self.root}/{n}/_SUCCESS"))]
        return sorted(n for n in numbers if n > after)

    def folders(self) -> list[str]:
        """What makes up the table now: each batch in one folder only."""
        levels = self._levels()  # first: a compaction may end meanwhile, its batches stay
        live = self._batches(max((x[3] for x in levels), default=-1))
        return [f"{self.root}/{x[1]}" for x in levels] + [f"{self.root}/batch={n}" for n in live]

    def _merged(self, folders: Sequence[str]) -> DataFrame:
        return bars.combine(reduce(DataFrame.unionByName, [self.spark.read.parquet(f) for f in folders]), self.keys)

    def read(self) -> DataFrame | None:
        """Final bars of all batches; none yet: None."""
        now = self.folders()
        return bars.merge(reduce(DataFrame.unionByName, [self.spark.read.parquet(f) for f in now]), self.keys) if now else None

    def compact(self) -> int:
        """Merge what is due; returns how many folders were written.  The newest batch stays as it
        is, since its query may write it again."""
        versions, levels, made = self.manifest.versions(), self._levels(), 0
        live = self._batches(max((x[3] for x in levels), default=-1))[:-1]
        todo = [(0, f"batch={n}", n, n) for n in live[: len(live) // self.fan * self.fan]]
        levels += todo
        level = 0
        while (same := [x for x in levels if x[0] == level]) or level == 0:
            for at in range(0, len(same) // self.fan * self.fan, self.fan):
                some = same[at : at + self.fan]
                name = f"level={level + 1}/{some[0][2]}-{some[-1][3]}-{(versions or [0])[-1] + 1}"
                self._merged([f"{self.root}/{x[1]}" for x in some]).write.mode("overwrite").parquet(f"{self.root}/{name}")
                levels = [x for x in levels if x not in some] + [(level + 1, name, some[0][2], some[-1][3])]
                made += 1
            level += 1
        if made:
            rows = self.spark.createDataFrame(sorted(levels, key=lambda x: x[2]), "level int, name string, since long, until long")
            self.manifest.replace(rows.coalesce(1), base=versions[-1] if versions else 0)
        return made

    def vacuum(self) -> int:
        """Delete folders of batches and levels that are part of another one; returns how many."""
        fs, path = self.manifest._fs()
        levels, gone = self._levels(), 0
        kept, upto = {x[1] for x in levels}, max((x[3] for x in levels), default=-1)
        for s in fs.listStatus(path(self.root)):
            name = s.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) <= upto:
                gone += fs.delete(s.getPath(), True)
            elif name.startswith("level="):
                for x in fs.listStatus(s.getPath()):
                    if f"{name}/{x.getPath().getName()}" not in kept:
                        gone += fs.delete(x.getPath(), True)
        return gone
