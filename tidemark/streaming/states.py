"""State of the live path as stateful processors: sighted contents, last stamps, latest columns.

State lies in a store on the checkpoint's path, a value per content or column, and is
touched per entry; nothing is rewritten per batch but what the batch brings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

#: How long a content's state stays after its last sighting, and a symbol's after its last delta.
IDLE_MS, DAY_MS = 3_600_000, 86_400_000
CHANGES = "symbol string, k string, v string, ms long"


def begin(spark: SparkSession, writer: DataStreamWriter, once: bool) -> StreamingQuery:
    """Start a query with state: ``once`` for what is there now, or else every second.

    Operators on the processing clock ask for batches without data for ever; a query that
    is to end gets none, so state expires with its next data.  The query keeps the setting
    that it starts with, the session gets its own back.
    """
    if not once:
        return writer.trigger(processingTime="1 second").start()
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


class Accept(StatefulProcessor):
    """Contents of a symbol: each is passed on when it hasn't been sighted for ``window_ms``.

    Every sighting renews the window.  A content's entry goes ``idle_ms`` of the
    processing clock after its last sighting, so a symbol that falls silent costs
    nothing but its last stamp.  Stamps rise strictly.
    """

    def __init__(self, window_ms: int, idle_ms: int = IDLE_MS):
        self.window_ms, self.idle_ms = window_ms, max(idle_ms, window_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "content string", "at long", self.idle_ms)
        self.last = handle.getValueState("last", "stamp long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(["received_ms", "pos"], kind="stable")
        before = {c: found[0] if (found := self.seen.getValue((c,))) else None for c in batch["key"].unique()}
        # the sighting before each row: the last one in the batch, or else the stored one
        prior = batch.groupby("key", sort=False)["received_ms"].shift()
        prior = prior.fillna(batch["key"].map(before).astype("float64"))
        fresh = batch[prior.isna() | (batch["received_ms"] - prior >= self.window_ms)]
        for content, at in batch.groupby("key", sort=False)["received_ms"].last().items():
            self.seen.updateValue((content,), (int(at),))
        if len(fresh):
            last = self.last.get()[0] if self.last.exists() else -1
            # a stamp is the time, or one more than the last: a running maximum once the ordinal is taken off
            place = pd.Series(range(len(fresh)), index=fresh.index)
            stamps = (fresh["received_ms"] - place).clip(lower=last + 1).cummax() + place
            self.last.update((int(stamps.iloc[-1]),))
            out = fresh[["received_ms", "pos", "event", "body"]].assign(symbol=key[0], stamp=stamps)
            yield out

    def close(self) -> None:
        pass


class Latest(StatefulProcessor):
    """A symbol's columns: of each the value with the greatest time, ties to the greater value, so a
    batch may come again.  A symbol goes ``ttl_ms`` of the processing clock after its last
    delta, as a whole.  Passes on what changed."""

    def __init__(self, ttl_ms: int = DAY_MS):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.columns = handle.getMapState("columns", "k string", "v string, ms long")
        self.until = handle.getValueState("until", "at long")

    def _renew(self, now: int) -> None:
        if self.until.exists():
            self.handle.deleteTimer(self.until.get()[0])
        self.until.update((now + self.ttl_ms,))
        self.handle.registerTimer(now + self.ttl_ms)

    def _put(self, rows: pd.DataFrame) -> list[tuple]:
        best: dict[str, tuple] = {}
        for k, v, ms in rows[["k", "v", "ms"]].itertuples(index=False):
            best[k] = max(best.get(k, (-1, "")), (int(ms), v))
        changed = []
        for k, (ms, v) in best.items():
            old = self.columns.getValue((k,))
            if old is None or (old[1], old[0]) < (ms, v):
                self.columns.updateValue((k,), (v, ms))
                changed.append((k, v, ms))
        return changed

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self._put(initialState)
        self._renew(timerValues.getCurrentProcessingTimeInMs())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        changed = self._put(pd.concat(list(rows)))
        self._renew(timerValues.getCurrentProcessingTimeInMs())
        if changed:
            yield pd.DataFrame([(key[0], *c) for c in changed], columns=["symbol", "k", "v", "ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.columns.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def exploded(deltas: DataFrame, column: str = "delta") -> DataFrame:
    """``symbol``, ``ms``, ``k``, ``v`` of maps of columns; null values don't count."""
    return deltas.select("symbol", "ms", F.explode(column).alias("k", "v")).where("v is not null")


def changes(deltas: DataFrame, boot: DataFrame | None = None, ttl_ms: int = DAY_MS) -> DataFrame:
    """Changed columns of a stream of ``deltas`` (``symbol``, ``ms``, map ``delta``).

    State begins with ``boot`` (``symbol``, map ``state``; as old as can be) where a
    query begins; a restarted query has its own.
    """
    initial = None
    if boot is not None:
        initial = boot.select("symbol", F.lit(0).cast("long").alias("ms"), F.explode("state").alias("k", "v")).where("v is not null").groupBy("symbol")
    return exploded(deltas).groupBy("symbol").transformWithStateInPandas(Latest(ttl_ms), CHANGES, "Update", "ProcessingTime", initial)


def entries(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """A map variable of a query's state as of its last batch: ``symbol``, ``key``, ``value``."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()
    return rows.select(F.col("key.symbol").alias("symbol"), F.col("user_map_key").alias("key"), F.col("user_map_value").alias("value"))


def current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``symbol``, ``ms`` and the map ``state`` of all symbols that haven't expired."""
    rows = entries(spark, checkpoint, "columns").select("symbol", F.col("key.k").alias("k"), "value.v", "value.ms")
    return rows.groupBy("symbol").agg(F.max("ms").alias("ms"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("state"))
