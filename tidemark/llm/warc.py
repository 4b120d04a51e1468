"""WARC archives, index first.

Archives are made of per-record gzip members, so every record is a byte range of
its own.  They are kept in the shared folder as a table of consecutive blocks
(``archive``, ``at``, ``data``), which any store that Spark reaches can hold; the
bytes of an archive's blocks in order are a plain ``.warc.gz`` file.  The index has
offset, length, URL and payload digest of every record.  A read joins selected
index rows to blocks only after sorting them by offset and merging ranges that
lie within a gap of each other, so a block is fetched once for all its records.
The table is written in small row groups, in order of archive and offset: a selection
from few blocks names them to the scan, which skips all others by their statistics.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

BLOCK = 256 * 1024
ARCHIVE = 64 * BLOCK
#: Bytes of a row group, and how many blocks a selection may name to the scan.
ROW_GROUP, NAMED = 16 * BLOCK, 1000
GAP = 4096
_DATE = "1970-01-01T00:00:00Z"
_BLOCKS = "archive string, at long, data binary, records array<struct<offset:bigint,length:bigint,page_id:bigint,url:string,digest:string,record_type:string>>"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit has no payload of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + payload if kind == "response" else http
    name = lambda n: f"<urn:page:{'none' if n is None else n}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """Type, ids, digest and payload of a record that ``record`` or another writer made."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[: int(fields["content-length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    ident = lambda x: None if x is None or x == "<urn:page:none>" else int(x.removeprefix("<urn:page:").removesuffix(">"))
    return {
        "page_id": ident(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "refers_to": ident(fields.get("warc-refers-to")),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "payload_bytes": int(fields["x-payload-length"]), "payload": payload if fields["warc-type"] == "response" else None,
    }


def revisits(pages: DataFrame, least: int = 0, id_col: str = "page_id", body_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload`` and ``first``: the response that a row revisits, or null.

    Of rows with equal payloads of at least ``least`` bytes, one with the smallest
    id is the response.  Rows of that same id repeat it and are responses too.
    """
    payload = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    long = F.octet_length("payload") >= least
    first = cut(rows.where(long).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-first")
    again = (F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "sha", "left").select("page_id", "url", "payload", F.when(again, F.col("first")).alias("first"))


def write(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write one record per row of :func:`revisits`; returns the blocks and the index."""
    small_batches(rows.sparkSession, rows=256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, archive, at, have, listed, size = TaskContext.get().partitionId(), 0, 0, [], [], 0
        schema = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("data", pa.binary()), ("records", pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])))])

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"archive": f"{part:06d}-{archive:06d}", "at": at, "data": b"".join(have), "records": listed}], schema)

        for b in batches:
            for r in b.to_pylist():
                kind, digest = "response" if r["first"] is None else "revisit", sha1_base32(r["payload"])
                made = record(kind, r["page_id"], r["url"], r["payload"], digest, r["first"])
                listed.append({"offset": at + size, "length": len(made), "page_id": r["page_id"], "url": r["url"], "digest": digest, "record_type": kind})
                have.append(made)
                size += len(made)
                if size >= BLOCK:
                    yield block()
                    at, have, listed, size = at + size, [], [], 0
                    if at >= ARCHIVE:
                        archive, at = archive + 1, 0
        if have:
            yield block()

    both = cut(rows.mapInArrow(run, _BLOCKS), "warc-archives", **{"parquet.block.size": ROW_GROUP})
    index = both.select("archive", F.col("at").alias("block"), F.inline("records"))
    return both.select("archive", "at", "data"), cut(index, "warc-index")


def ranges(selected: DataFrame, gap: int = GAP) -> DataFrame:
    """Merge the byte ranges of selected index rows: sorted by offset, gaps up to ``gap`` bridged.

    Returns ``archive``, ``block``, ``start``, ``stop`` and ``records`` (offset and
    length of each record in the range).  A range stays in one block, so that the
    records of a range, like its bytes, are bounded.
    """
    w = Window.partitionBy("archive", "block").orderBy("offset")
    fresh = (F.col("offset") > F.lag(F.col("offset") + F.col("length")).over(w) + gap).cast("int")
    runs = selected.select("*", F.coalesce(fresh, F.lit(1)).alias("fresh")).select("*", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return runs.groupBy("archive", "block", "run").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")).drop("run")


def read(blocks: DataFrame, selected: DataFrame, gap: int = GAP) -> DataFrame:
    """Read the selected index rows' records back: ids, type, digest, length and ``payload``.

    ``payload`` is null for a revisit; ``intact`` is false if a response's payload
    doesn't have the digest that its header names.
    """
    small_batches(blocks.sparkSession, rows=64)
    wanted = ranges(selected, gap)
    few = selected.select("archive", "block").distinct().limit(NAMED + 1).collect()
    if len(few) <= NAMED:
        blocks = blocks.where(F.col("archive").isin(sorted({r[0] for r in few})) & F.col("at").isin(sorted({r[1] for r in few})))
    data = blocks.join(wanted.withColumnRenamed("block", "at"), ["archive", "at"])
    piece = F.expr("substring(data, cast(start - at + 1 as int), cast(stop - start as int))")
    asked = data.select(piece.alias("bytes"), F.transform("records", lambda r: F.struct((r["offset"] - F.col("start")).alias("o"), r["length"].alias("n"))).alias("records"))
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "intact"]
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                out = []
                for x in r["records"]:
                    f = parse(r["bytes"][x["o"] : x["o"] + x["n"]])
                    p = f["payload"]
                    out.append({k: f.get(k) for k in names} | {"intact": p is None or (sha1_base32(p) == f["payload_digest"] and len(p) == f["payload_bytes"])})
                yield pa.RecordBatch.from_pylist(out, schema)

    return asked.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, intact boolean")


def archive(pages: DataFrame, least: int = 0) -> tuple[DataFrame, DataFrame]:
    """Write all pages; returns blocks and index.

    Null payloads are empty ones, null URLs are left out of the record, null ids
    never become a revisit's response unless all ids of a payload are null (then
    all are responses); repeated rows give repeated records; an empty table gives
    empty tables; other columns are ignored.
    """
    return write(revisits(pages, least))
