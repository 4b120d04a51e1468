"""The live path: capture files to accepted records, typed rows, partial bars, latest state.

Late rows are never cut off: bars are partial aggregates per batch that merge on
read, so no watermark is set.  A batch writes to paths named by its id and a replay
of it overwrites them, which makes the sink exactly-once; a block of rows that another
batch has written already isn't written again.
"""

from __future__ import annotations

import random
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators import bars, dedup
from tidemark.sources import frames, snapshots
from tidemark.streaming import blocks, states

ACCEPTED = "received_ms long, pos int, event string, body string, symbol string, stamp long"
WINDOW_MS = 600_000


def capture(spark: SparkSession, path: str, files: int = 16) -> DataFrame:
    """Capture lines as a stream, so many files a batch (the rate limit that back-pressure needs)."""
    rows = spark.readStream.schema("r long, p string").option("maxFilesPerTrigger", files).json(path)
    return rows.select(F.col("r").alias("received_ms"), F.col("p").alias("packet"))


def accepted(packets: DataFrame, window_ms: int = WINDOW_MS, idle_ms: int = states.IDLE_MS) -> DataFrame:
    """Deduplicated, stamped records of a stream; per symbol it equals :func:`frames.accept` on all rows.

    State is an entry per content sighted, kept for ``idle_ms`` after the last sighting,
    and one stamp per symbol.
    """
    rows = frames.records(packets).withColumn("body", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("fields")))))
    rows = rows.withColumn("symbol", frames.symbol(F.col("event"), F.col("fields"))).where("symbol is not null")
    keyed = rows.select("received_ms", "pos", "event", "body", "symbol", F.sha1(F.concat_ws("\x00", "event", "body")).alias("key"))
    return keyed.groupBy("symbol").transformWithStateInPandas(states.Accept(window_ms, idle_ms), ACCEPTED, "Append", "ProcessingTime")


def write_batch(root: str, rows: DataFrame, batch: int) -> None:
    """Typed tables, quarantine and partial bars of one batch of accepted records, without the
    blocks that one of the last batches has written."""
    spark, ledger = rows.sparkSession, blocks.Ledger(rows.sparkSession, f"{root}/blocks")
    rows = rows.withColumn("fields", F.from_json("body", "map<string,string>")).persist()
    good, bad = zip(*[frames.normalize(rows, e) for e in frames.EVENTS], strict=True)
    fresh, found = ledger.fresh({e: blocks.numbered(g, "symbol", ["received_at", "symbol"]) for e, g in zip(frames.EVENTS, good, strict=True)}, batch)
    for event, some in fresh.items():
        some.write.mode("overwrite").parquet(f"{root}/{event}/batch={batch}")
    refused = reduce(DataFrame.unionByName, bad)
    refused.withColumn("fields", F.to_json("fields")).write.mode("overwrite").parquet(f"{root}/quarantine/batch={batch}")
    trades = spark.read.parquet(f"{root}/t/batch={batch}").withColumn("slot", F.date_trunc("minute", "ts"))
    partial_bars(spark, root).add(batch, bars.partials(trades, ["symbol", "slot"], ["ts", "seq", "received_at"]))
    ledger.note(found, batch)  # after all rows are written: a batch that fails before writes them again
    rows.unpersist()


def partial_bars(spark: SparkSession, root: str) -> blocks.Partials:
    return blocks.Partials(spark, f"{root}/bars")


def start(packets: DataFrame, root: str, checkpoint: str, window_ms: int = WINDOW_MS, once: bool = True) -> StreamingQuery:
    writer = accepted(packets, window_ms).writeStream.foreachBatch(lambda df, n: write_batch(root, df, n)).option("checkpointLocation", checkpoint)
    return states.begin(packets.sparkSession, writer, once)


def minute_bars(spark: SparkSession, root: str) -> DataFrame | None:
    """Final bars over the partial ones of all batches, compacted or not."""
    return partial_bars(spark, root).read()


def boot_state(boot: DataFrame, fresh: DataFrame, symbols: DataFrame) -> DataFrame:
    """State to start from: the directory's columns overlaid by fresh ones, for symbols of the catalogue only.

    ``boot`` and ``fresh`` have ``symbol`` and the map ``state``; a fresh symbol replaces its row.
    """
    rows = fresh.select("symbol", "state").unionByName(boot.select("symbol", "state").join(fresh.select("symbol"), "symbol", "left_anti"))
    return rows.join(symbols.select("symbol"), "symbol", "left_semi")


def published(event: str, deltas: DataFrame) -> DataFrame:
    """What subscribers get per delta: ``channel`` and ``message`` (JSON of the symbol and the columns sent)."""
    message = F.to_json(F.map_concat(F.create_map(F.lit("symbol"), F.col("symbol")), F.map_from_entries(F.array_sort(F.map_entries("delta")))))
    return deltas.select(F.concat_ws(":", F.lit("rt:pub"), F.lit(event), "symbol").alias("channel"), message.alias("message"))


def latest_state(table: snapshots.Table, deltas: DataFrame, now_ms: int, ttl_ms: int = states.DAY_MS, tries: int = 5) -> int:
    """Merge deltas (``symbol``, ``ms``, ``delta``) into the state table: newer columns win, old symbols go.

    Columns that a delta doesn't carry stay; returns the new version.  If another writer
    comes in between, the merge is made again from what that one wrote.
    """
    for i in range(tries):
        versions, old = table.versions(), table.read()
        cols = states.exploded(deltas)
        if old is not None:
            cols = cols.unionByName(states.exploded(old, "state"))
        newest = dedup.latest(cols, ["symbol", "k"], ["ms", "v"])
        state = newest.groupBy("symbol").agg(F.max("ms").alias("ms"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("state"))
        try:
            return table.replace(state.where(F.col("ms") >= now_ms - ttl_ms), base=versions[-1] if versions else 0)
        except snapshots.Conflict:
            time.sleep(random.uniform(0.2, 1) * min(i + 1, 5))
    raise snapshots.Conflict(f"{tries} other writers in a row")
