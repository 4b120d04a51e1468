"""ISO base media containers in a binary column: write, walk, index, read back.

``pack`` writes a payload losslessly as the samples of one track (``ftyp``,
``moov`` with full sample tables, ``mdat``).  ``walk`` goes through nested boxes of
any such file; ``index`` decodes the sample tables of all tracks, and the runs of
movie fragments, into codec, duration and the byte range of every keyframe.  Neither
touches the payload's bytes: they read box headers and tables only.  A file whose
boxes or tables contradict each other or its length is refused, before memory is
taken for what it claims to hold.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

#: Fixed values of the format: boxes that hold boxes, with the bytes before these.
NESTED = {b"moov": 0, b"trak": 0, b"edts": 0, b"mdia": 0, b"minf": 0, b"dinf": 0, b"stbl": 0, b"mvex": 0, b"moof": 0, b"traf": 0, b"udta": 0, b"meta": 4}
SAMPLE, RATE, CHUNK, KEY_EVERY = 192, 8000, 64, 32


class Broken(ValueError):
    """A file whose boxes or tables contradict its length or each other."""


#: Boxes nest some ten deep in real files.
DEEPEST = 64


def walk(data: bytes | memoryview) -> Iterator[tuple[str, int, int]]:
    """Yield ``(path, body start, body end)`` of every box, depth first, in file order."""
    todo = [(0, len(data), "", 0)]
    while todo:
        start, end, path, depth = todo.pop()
        if start == end:
            continue
        if end - start < 8:
            raise Broken(f"{end - start} stray bytes at {start}")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - start < 16:
                raise Broken(f"a long box header is cut at {start}")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        elif size == 0:
            size = end - start
        if size < body - start or start + size > end:
            raise Broken(f"a box at {start} has size {size}")
        name = f"{path}/{kind.decode('latin-1')}"
        yield name, body, start + size
        todo.append((start + size, end, path, depth))
        if kind in NESTED:
            if depth == DEEPEST or body + NESTED[kind] > start + size:
                raise Broken(f"a box at {start} is too deep or too short")
            todo.append((body + NESTED[kind], start + size, name, depth + 1))


@dataclass
class Track:
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    number: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def seconds(self) -> float:
        return self.duration / self.timescale if self.timescale else 0.0

    def keyframes(self) -> list[tuple[int, int]]:
        """``(offset, length)`` of every keyframe in the file."""
        return list(zip(self.offsets[self.keys].tolist(), self.sizes[self.keys].tolist(), strict=True))


def _numbers(data: bytes, at: int, end: int, n: int, kind: str = ">u4") -> np.ndarray:
    if at + n * np.dtype(kind).itemsize > end:
        raise Broken(f"a table at {at} is cut")
    return np.frombuffer(data, kind, n, at).astype(np.int64)


def _word(data: bytes, at: int, end: int, kind: str = ">I") -> int:
    if at + struct.calcsize(kind) > end:
        raise Broken(f"a field at {at} is cut")
    return struct.unpack_from(kind, data, at)[0]


def _table(data: bytes, at: int, end: int, columns: int, kind: str = ">u4") -> np.ndarray:
    n = _word(data, at + 4, end)
    return _numbers(data, at + 8, end, n * columns, kind).reshape(n, columns)


def _inside(data: bytes, offsets: np.ndarray, sizes: np.ndarray) -> None:
    if len(offsets) and (offsets.min() < 0 or int((offsets + sizes).max()) > len(data)):
        raise Broken("a sample lies outside the file")


def index(data: bytes) -> list[Track]:
    """The tracks of a file by its sample tables and fragment runs alone; :class:`Broken` if they don't fit."""
    tracks: list[Track] = []
    parts: dict[str, tuple[int, int]] = {}
    defaults: dict[int, tuple[int, int, int]] = {}
    fragment: list[int] = [0, 0, 0]  # where the fragment starts, where its run starts, where the next data starts
    head: dict[str, int] = {}

    def close() -> None:
        if parts:
            tracks.append(_track(data, parts))
            parts.clear()

    try:
        for path, at, end in walk(data):
            name = path.rpartition("/")[2]
            if path == "/moov/trak":
                close()
            elif path.startswith("/moov/trak/"):
                parts[name] = (at, end)
            elif path == "/moov/mvex/trex":
                defaults[_word(data, at + 4, end)] = tuple(_word(data, at + k, end) for k in (12, 16, 20))
            elif path == "/moof":
                close()
                fragment[:] = [at - 8, at - 8, at - 8]
            elif path == "/moof/traf/tfhd":
                head = _fragment_head(data, at, end, defaults, fragment)
            elif path == "/moof/traf/trun":
                track = next((t for t in tracks if t.number == head.get("track")), None)
                if track is None:
                    raise Broken("a fragment of no track")
                _run(data, at, end, track, head)
                fragment[2] = head["next"]
        close()
    except (struct.error, IndexError, OverflowError) as e:
        raise Broken(str(e)) from e
    return tracks


def _fragment_head(data: bytes, at: int, end: int, defaults: dict, fragment: list[int]) -> dict[str, int]:
    """Track, base and sample defaults of a fragment of a track."""
    flags = _word(data, at, end) & 0xFFFFFF
    head = {"track": _word(data, at + 4, end)}
    at += 8
    duration, size, sync = defaults.get(head["track"], (0, 0, 0))
    base = fragment[0] if flags & 0x20000 else fragment[2]
    for bit, kind in ((0x1, ">Q"), (0x2, ">I"), (0x8, ">I"), (0x10, ">I"), (0x20, ">I")):
        if flags & bit:
            value = _word(data, at, end, kind)
            at += struct.calcsize(kind)
            base, duration, size, sync = (value if bit == 0x1 else base, value if bit == 0x8 else duration, value if bit == 0x10 else size, value if bit == 0x20 else sync)
    return head | {"base": base, "next": base, "duration": duration, "size": size, "flags": sync}


def _run(data: bytes, at: int, end: int, track: Track, head: dict[str, int]) -> None:
    """Append the samples of a run to its track."""
    flags, n = _word(data, at, end) & 0xFFFFFF, _word(data, at + 4, end)
    at += 8
    start = head["next"]
    if flags & 0x1:
        start = head["base"] + _word(data, at, end, ">i")
        at += 4
    first = head["flags"]
    if flags & 0x4:
        first = _word(data, at, end)
        at += 4
    named = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
    if n > len(data):
        raise Broken("more samples than bytes")
    columns = _numbers(data, at, end, n * len(named)).reshape(n, len(named)) if named else np.zeros((n, 0), np.int64)
    of = lambda bit, value: columns[:, named.index(bit)] if bit in named else np.full(n, value, np.int64)
    sizes, sync = of(0x200, head["size"]), of(0x400, head["flags"]).copy()
    if flags & 0x4 and n and 0x400 not in named:
        sync[0] = first
    offsets = start + np.cumsum(sizes) - sizes
    _inside(data, offsets, sizes)
    keys = np.flatnonzero(sync & 0x10000 == 0) + len(track.sizes)
    track.sizes, track.offsets, track.keys = (np.append(x, y) for x, y in ((track.sizes, sizes), (track.offsets, offsets), (track.keys, keys)))
    track.duration += int(of(0x100, head["duration"]).sum())
    head["next"] = int(start + sizes.sum())


def _sizes(data: bytes, parts: dict[str, tuple[int, int]]) -> np.ndarray:
    if "stsz" in parts:
        at, end = parts["stsz"]
        each, n = _word(data, at + 4, end), _word(data, at + 8, end)
        if each * n > len(data):
            raise Broken("samples beyond the file's length")
        return np.full(n, each, np.int64) if each else _table(data, at + 4, end, 1)[:, 0]
    if "stz2" in parts:
        at, end = parts["stz2"]
        bits, n = _word(data, at + 4, end) & 255, _word(data, at + 8, end)
        if bits in (8, 16):
            return _numbers(data, at + 12, end, n, f">u{bits // 8}")
        if bits != 4:
            raise Broken(f"sample sizes of {bits} bits")
        pairs = _numbers(data, at + 12, end, (n + 1) // 2, ">u1")
        return np.stack([pairs >> 4, pairs & 15], axis=1).reshape(-1)[:n]
    return np.zeros(0, np.int64)


def _track(data: bytes, parts: dict[str, tuple[int, int]]) -> Track:
    t = Track()
    if "tkhd" in parts:
        at, end = parts["tkhd"]
        t.number = _word(data, at + (20 if _word(data, at, end, ">B") == 1 else 12), end)
    if "mdhd" in parts:
        at, end = parts["mdhd"]
        long = _word(data, at, end, ">B") == 1
        t.timescale, t.duration = (_word(data, at + 20, end), _word(data, at + 24, end, ">Q")) if long else (_word(data, at + 12, end), _word(data, at + 16, end))
    if "stsd" in parts:
        at, end = parts["stsd"]
        if end - at >= 16:
            t.codec = bytes(data[at + 12 : at + 16]).decode("latin-1")
    t.sizes = _sizes(data, parts)
    n = len(t.sizes)
    if "stts" in parts and not t.duration:
        t.duration = sum(a * b for a, b in _table(data, *parts["stts"], 2).tolist())
    chunks = _table(data, *parts["stco"], 1)[:, 0] if "stco" in parts else _table(data, *parts["co64"], 1, ">u8")[:, 0] if "co64" in parts else np.zeros(0, np.int64)
    if n:
        runs = _table(data, *parts["stsc"], 3) if "stsc" in parts else np.zeros((0, 3), np.int64)
        if not len(runs) or not len(chunks) or runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any() or runs[-1, 0] > len(chunks):
            raise Broken("samples without chunks")
        per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1)))
        upto = np.cumsum(np.minimum(per, n))
        if upto[-1] < n:
            raise Broken("fewer samples in chunks than sizes")
        chunk = np.searchsorted(upto, np.arange(n), side="right")
        before = np.cumsum(t.sizes) - t.sizes
        first = np.minimum(upto - np.minimum(per, n), n - 1)
        t.offsets = chunks[chunk] + before - before[first][chunk]
        _inside(data, t.offsets, t.sizes)
    t.keys = _table(data, *parts["stss"], 1)[:, 0] - 1 if "stss" in parts else np.arange(n)
    if len(t.keys) and not 0 <= t.keys.min() <= t.keys.max() < n:
        raise Broken("a keyframe that is no sample")
    return t


def _box(kind: bytes, *body: bytes) -> bytes:
    size = 8 + sum(map(len, body))
    return b"".join([struct.pack(">I4s", size, kind), *body])


def _full(kind: bytes, *body: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *body)


def pack(payload: bytes) -> bytes:
    """A file whose only track holds ``payload`` as unsigned 8-bit samples.

    A sample of the track is ``SAMPLE`` bytes, a chunk ``CHUNK`` samples, and every
    ``KEY_EVERY``-th sample is a keyframe.  ``payload`` is a positive multiple of ``SAMPLE``.
    """
    n, rest = divmod(len(payload), SAMPLE)
    if rest or not n:
        raise ValueError("the payload must be a positive multiple of the sample size")
    per = [CHUNK] * (n // CHUNK) + [n % CHUNK] * bool(n % CHUNK)
    runs = [(i + 1, k, 1) for i, k in enumerate(per) if not i or k != per[i - 1]]
    unity = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    length = n * SAMPLE

    def head(first: int) -> bytes:
        chunks = [first + i * CHUNK * SAMPLE for i in range(len(per))]
        wide = chunks[-1] >= 1 << 32
        entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
        keys = range(1, n + 1, KEY_EVERY)
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, SAMPLE)),
            _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", *r) for r in runs]),
            _full(b"stsz", struct.pack(">II", SAMPLE, n)),
            _full(b"co64" if wide else b"stco", struct.pack(f">I{len(chunks)}{'Q' if wide else 'I'}", len(chunks), *chunks)),
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">QQIQI", 0, 0, RATE, length, 0x55C40000), version=1), _full(b"hdlr", struct.pack(">I4s", 0, b"soun"), bytes(13)), _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl))
        trak = _box(b"trak", _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, length), bytes(8), struct.pack(">hhhH", 0, 0, 0x100, 0), unity, bytes(8), version=1, flags=3), mdia)
        mvhd = _full(b"mvhd", struct.pack(">QQIQIH", 0, 0, RATE, length, 0x10000, 0x100), bytes(10), unity, bytes(24), struct.pack(">I", 2), version=1)
        return _box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isommp42") + _box(b"moov", mvhd, trak)

    data = struct.pack(">I4s", 8 + len(payload), b"mdat") if len(payload) < (1 << 32) - 8 else struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload))
    first = len(head(0)) + len(data)
    return b"".join([head(first), data, payload])


def unpack(data: bytes) -> bytes:
    """The payload of the first track, read back sample by sample through its tables."""
    t = index(data)[0]
    if not len(t.offsets):
        return b""
    view = memoryview(data)
    ends = t.offsets + t.sizes
    runs = np.flatnonzero(np.append(True, t.offsets[1:] != ends[:-1]))
    last = np.append(runs[1:], len(ends)) - 1
    return b"".join(view[a:b] for a, b in zip(t.offsets[runs].tolist(), ends[last].tolist(), strict=True))


def padded(text: bytes | None) -> bytes:
    text = text or b""
    return text + b" " * (-len(text) % SAMPLE if text else SAMPLE)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``media``, a container with the text as its payload.

    Null texts count as empty, and an empty text is stored as one sample of blanks;
    repeated rows stay; other columns are ignored.
    """
    small_batches(docs.sparkSession, rows=256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array([pack(padded(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_bytes long, media binary")


_TRACKS = "array<struct<codec:string,seconds:double,keyframes:array<struct<offset:bigint,length:bigint>>>>"
_FOUND = f"tracks {_TRACKS}, error string, payload_bytes long, payload_sha256 string, tail_crc32 long"


def _features(data: bytes | None, payload: bool) -> dict:
    try:
        tracks = index(data or b"")
        if not tracks:
            raise Broken("no track")
        out = {"tracks": [{"codec": t.codec, "seconds": t.seconds, "keyframes": [{"offset": o, "length": n} for o, n in t.keyframes()]} for t in tracks], "error": None}
        if payload:
            p = unpack(data)
            out |= {"payload_bytes": len(p), "payload_sha256": hashlib.sha256(p).hexdigest(), "tail_crc32": zlib.crc32(p[-16:])}
        return out
    except (ValueError, struct.error, IndexError, OverflowError) as e:
        return {"tracks": None, "error": str(e) or type(e).__name__}


def features(rows: DataFrame, media_col: str = "media", payload: bool = False) -> DataFrame:
    """Add what the containers' tables say, and with ``payload`` digests of the bytes read back.

    Adds ``tracks`` (codec, seconds and byte ranges of keyframes of every track, in file
    order), ``error`` and, null unless asked for, ``payload_bytes``, ``payload_sha256``,
    ``tail_crc32`` of the first track.  Null or broken containers give nulls and an
    ``error``; existing columns of these names are replaced, all others are kept.
    """
    small_batches(rows.sparkSession, rows=256)
    names = ("tracks", "error", "payload_bytes", "payload_sha256", "tail_crc32")

    @F.pandas_udf(_FOUND)
    def run(media: pd.Series) -> pd.DataFrame:
        found = [_features(m, payload) for m in media]
        return pd.DataFrame({k: pd.Series([f.get(k) for f in found], dtype="Int64" if k in ("payload_bytes", "tail_crc32") else object) for k in names})

    kept = [c for c in rows.columns if c not in names]
    return rows.select(*kept, run(F.col(media_col)).alias("__f")).select(*kept, "__f.*")
