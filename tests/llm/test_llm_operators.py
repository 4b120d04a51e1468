"""The training-data operators against brute force, and on odd tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, media, mixing, pieces, quality, quotes, simhash, surrogates, url_lists, warc, wrappers
from tidemark.llm.html_blocks import main_part, tree
from tidemark.llm.queries import MODEL, queries

W = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "a b c d e f g h i j k l", "en", "s", 3),
    (1, "a b c d e f g h i j k l", "en", "s", 3),
    (None, None, None, None, None),
    (None, "null id text here", "en", None, 1),
    (2, "", "x", None, 0),
    (3, " \t\n ", None, "s", 0),
    (4, "Ünïcödé ▁ \x00 é" * 3, "fr", "t", 9),
    (5, "word " * 4000, "en", "s", 20000),
    (6, "one\ntwo\none\n\none", "en", "t", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    # columns that clash with names used inside the operators
    return spark.createDataFrame(ODD, DOCS).withColumns({"fp": F.lit(1), "size": F.lit("x"), "entities": F.lit(7), "rk": F.lit(0), "g": F.lit("z"), "order": F.lit(1), "start": F.lit(None).cast("int")})


def words(t):
    return W.findall(t or "")


# --- SimHash -------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def closure(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_masks_cover_every_pair_of_positions():
    for radius in (1, 2):
        kept = simhash.masks(radius)
        assert len(kept) == 2 ** (radius + 1) - 1
        for i in range(64):
            for j in range(64):
                assert any(not m >> i & 1 and not m >> j & 1 for m in kept) or radius == 1 and i != j


@pytest.mark.parametrize("radius", [1, 2])
def test_links_equal_brute_force(spark, radius):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = {s for s in seeds}
    for s in seeds:
        x = s
        for _ in range(rng.randrange(25)):
            for _ in range(rng.choice((1, 2, 3))):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in values)
    got = {r.node: r.root for r in components.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius)).collect()}
    want = closure(signed, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= radius)
    assert {x: got.get(x, x) for x in signed} == want


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(80)) and len(got) == 141


def test_simhash_groups_on_odd_table(spark, odd):
    got = simhash.groups(odd).collect()
    assert len(got) == len(ODD)
    prints = {brute_fingerprint(t) for _, t, *_ in ODD}
    assert Counter(r.fingerprint for r in got) == Counter(f"{brute_fingerprint(t):016x}" for _, t, *_ in ODD) and len(prints) < len(ODD)
    zero = [r.component_id for r in got if r.fingerprint == "0" * 16]
    assert zero == [2] * len(zero) and len(zero) == 3
    assert simhash.groups(odd.limit(0)).count() == 0


# --- quality -------------------------------------------------------------------


def test_counters(spark, odd):
    got = Counter(tuple(r)[:6] for r in quality.counters(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    want = Counter()
    for i, t, *_ in ODD:
        w, t = words(t), t or ""
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        covered = {p for k, g in enumerate(grams) if n[g] > 1 for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if W.search(x)]
        want[i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)] += 1
    assert got == want


def test_outliers_equal_numpy(spark):
    rng = random.Random(5)
    rows = []
    for i in range(160):
        n = rng.randrange(12, 80)
        bad = i % 9 == 0
        t = " ".join(f"w{rng.randrange(10**rng.randrange(2, 6))}" + ("###" if bad and rng.random() < 0.9 else "") for _ in range(n))
        rows.append((i, t, "en", "a" if i % 2 else "b"))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    rules = quality.Rules()
    stats = {}
    for i, t, _, s in rows:
        w = words(t)
        n = len(w)
        raw = (1 + sum(map(len, w)) / n, 1 + 100 * sum(t.count(c) for c in "#*$%&|<>") / n, 1.0, 1.0)
        stats[i] = (s, np.floor(np.log(raw) * 10000 + 0.5))
    floors = np.diag(np.square(rules.floors))
    for s in "ab":
        ids = [i for i in stats if stats[i][0] == s]
        q = np.array([stats[i][1] for i in ids])
        coarse = np.floor(q / 10) * 10
        centre, scatter = np.sort(coarse, axis=0)[math.ceil(len(ids) / 2) - 1] / 10000, floors
        for _ in range(rules.steps):
            d = np.einsum("ij,jk,ik->i", q / 10000 - centre, np.linalg.inv(scatter), q / 10000 - centre)
            bins = np.floor(np.log1p(d) * rules.bins)
            near = q[bins <= np.sort(bins)[math.ceil(len(ids) * rules.share) - 1]] / 10000
            centre = near.mean(axis=0)
            scatter = rules.consistency * (near.T @ near / len(near) - np.outer(centre, centre)) + floors
        d = np.einsum("ij,jk,ik->i", q / 10000 - centre, np.linalg.inv(scatter), q / 10000 - centre)
        for i, x in zip(ids, d, strict=True):
            assert got[i].distance == pytest.approx(x, rel=1e-6, abs=1e-9) and got[i].kept == (x <= rules.cut)
    assert sum(not r.kept for r in got.values()) == 18


def test_quality_on_odd_table(spark, odd):
    got = quality.judge(odd).collect()
    assert len(got) == len(ODD) and all(r.distance is None for r in got) and {r.doc_id for r in got if r.kept} == {1}
    assert quality.judge(odd.limit(0)).count() == 0


# --- mixing --------------------------------------------------------------------


def filled(sizes, weights):
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        new = {s for s in sizes if s not in full and weights[s] * rest / total > 3 * sizes[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in full else weights[s] * rest / total for s in sizes}
        full |= new


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a", "b", "c", "d", None]) if i % 40 else "tiny") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.Mix(block=16, range_rows=8, chunk=8)
    got = mixing.mixed(docs, mix).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = filled(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    for s in order:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(want[s]) and abs(sum(r.taken for r in own) - want[s]) <= 0.51
        assert all(r.taken <= 3 * r.size for r in own)
    again = mixing.mixed(docs.repartition(7), mix).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_schedule_interleaves(spark):
    goals = spark.createDataFrame([("a", 33), ("b", 1), (None, 90)], "source string, goal long")
    got = mixing.slots(goals, mixing.Mix(block=7, chunk=5)).orderBy("time").collect()
    for s, n in (("a", 5), ("b", 1), (None, 13)):
        assert [r.block for r in got if r.source == s] == list(range(n))  # ranks ascend with time
    assert len({r.time for r in got}) == 19
    for k in range(1, 20):  # low discrepancy: every prefix is close to proportion
        assert abs(sum(r.source is None for r in got[:k]) - k * 13 / 19) < 2


def test_mixing_on_odd_table(spark, odd):
    got = mixing.mixed(odd).collect()
    assert len(got) == len(ODD) and all((r.taken == 0) == (r.size == 0) or r.size for r in got)
    assert mixing.mixed(odd.limit(0)).count() == 0
    assert mixing.mixed(odd.where("text is null or doc_id in (2, 3)")).where("taken <> 0 or target <> 0").count() == 0


# --- surrogates ----------------------------------------------------------------


def test_surrogates(spark):
    rows = [
        (1, "Mr. John Smith met Mrs. Jane Doe; mail a.b@x-y.example.com, A.b@x-y.example.com"),
        (2, "call +1 (743) 555-3824 or +49 151 2345678 from 10.0.0.1, 4111 1111 1111 1111 4111111111111112 123-45-6789 DE89370400440532013000"),
        (3, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" again 10.0.0.1 г-жа Анна и г-н Петров'),
        (4, "clean text with 12 numbers, 3.14 and 2024-01-02, version 1.2.3"),
        (5, None),
        (5, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("entities", F.lit(3))
    got = {r.doc_id: r for r in surrogates.replace(df).collect()}
    a, b, c = (got[i].text for i in (1, 2, 3))
    for _, t in rows[:3]:
        for x in re.findall(r"\S+@\S+\w|\d{4}(?: ?\d{4}){3}|[0-9a-f]{40}|10\.0\.0\.1|555-3824|123-45-6789|John|Jane|Анна|Петров", t):
            assert x not in a + b + c
    assert got[4].text == rows[3][1] and got[4].n_entities == 0
    m = re.fullmatch(r"Mr\. ([A-Z]\w+) [A-Z]\w+ met Mrs\. ([A-Z]\w+) [A-Z]\w+; mail \w\.\w@\w-\w\.\w+\.com, [A-Z]\.\w@\w-\w\.\w+\.com", a)
    assert m and m[1].endswith("en") and m[2].endswith("a")
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+49 \d{3} \d{7} from \d+\.\d+\.\d+\.\d+, 4\d{3} \d{4} \d{4} \d{4} 4\d{15} \d{3}-\d\d-\d{4} DE\d{20}", b)
    luhn = lambda s: sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(s))) % 10 == 0
    cards = [x.replace(" ", "") for x in re.findall(r"(?<!\d)4\d{3}(?: ?\d{4}){3}(?!\d)", b)]
    assert [luhn(x) for x in cards] == [True, False]
    assert re.search(r"from (\S+),", b)[1] in c  # one address, one surrogate
    assert re.search(r"г-жа [А-Я][а-я]+а и г-н [А-Я][а-я]+ен", c)
    other = {r.doc_id: r.text for r in surrogates.replace(df, key="another").collect()}
    assert other[1] != a


def test_surrogate_collisions_are_drawn_again(spark):
    found = spark.createDataFrame([(f"{a:03d}-{b:02d}-{c:04d}",) for a in range(4) for b in range(5) for c in range(60)], "value string").select(F.lit("ssn").alias("kind"), "value", F.lit(None).cast("string").alias("gender"))
    tight = found.unionByName(spark.createDataFrame([("name", x, None) for x in ("Ab", "Cd", "Ef")], "kind string, value string, gender string"))
    got = surrogates.assign(tight).collect()
    assert len(got) == len({(r.kind, r.surrogate) for r in got}) == 1203
    assert not {r.surrogate for r in got} & {r.value for r in got}


def test_surrogates_on_odd_table(spark, odd):
    got = surrogates.replace(odd)
    assert Counter(r.text for r in got.collect()) == Counter(t for _, t, *_ in ODD) and "fp" in got.columns
    assert surrogates.replace(odd.limit(0)).count() == 0


# --- SentencePiece -------------------------------------------------------------


def brute_viterbi(chunk, table, unknown):
    best = [(0.0, -1, -1)]
    for e in range(1, len(chunk) + 1):
        top = None
        for s in range(max(0, e - 16), e):
            hit = table.get(chunk[s:e]) or (unknown if e - s == 1 else None)
            if hit and (top is None or best[s][0] + hit[1] > top[0]):
                top = (best[s][0] + hit[1], s, hit[0])
        best.append(top)
    out, e = [], len(chunk)
    while e:
        out.append((best[e][2], chunk[best[e][1]]))
        e = best[e][1]
    return [i for p, c in reversed(out) for i in ([3 + b for b in c.encode()] if p == 0 else [p])]


def test_encoding(spark, odd):
    model = pieces.Model.load(MODEL)
    table = {p: (i, s) for p, i, s in model.matching}
    texts = [(10, "Hello  world\nfoo  été 漢字 the ☃ end "), (11, "   lead"), (12, "x" * 300 + " " + "thntblereof" * 30), (13, "a\tb\r\nc"), (14, " ")]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    got = {(r.doc_id, r.rk): r.ids for r in pieces.gather(pieces.encode(df, model)).collect()}
    want = Counter()
    for i, t in [(i, t) for i, t, *_ in ODD] + texts:
        if t:
            chunks = re.findall(model.chunk_pattern(), "▁" + t.replace(" ", "▁"))
            want[i, tuple(x for c in chunks for x in brute_viterbi(c, table, (0, model.unknown_score)))] = 1
    assert Counter((i, tuple(ids)) for (i, _), ids in got.items()) == want
    rows = pieces.digests(df, model).collect()
    assert len(rows) == len(ODD) + len(texts) and sum(r.n_tokens for r in rows if r.doc_id == 1) == 2 * next(len(k[1]) for k in want if k[0] == 1)
    assert all(r.exact for r in rows if r.doc_id != 4) and not next(r for r in rows if r.doc_id == 4).exact  # its text has the blank mark
    assert pieces.encode(df.limit(0), model).count() == 0


def test_long_chunks_without_a_blank(spark):
    model = pieces.Model.load(MODEL)
    rng = random.Random(9)
    texts = ["".join(rng.choices("etaoinshrdlu", k=6_000)), "".join(chr(rng.randrange(0x3041, 0x3094)) + rng.choice(["", "☃", "𝄞"]) for _ in range(600))]
    some = texts[0][:1500]
    df = spark.createDataFrame(list(enumerate([*texts, some])), "doc_id long, text string")
    rows = {r.doc_id: r for r in pieces.digests(df, model).collect()}
    assert all(r.exact and r.n_chunks == 1 for r in rows.values()) and rows[0].n_tokens > 1_000
    table = {p: (i, s) for p, i, s in model.matching}
    got = pieces.gather(pieces.encode(df.where("doc_id = 2"), model)).first().ids
    assert got == brute_viterbi("▁" + some, table, (0, model.unknown_score))


def test_words_as_the_library_does(spark):
    import sentencepiece

    with open(MODEL, "rb") as f:
        raw = f.read()
    at = raw.index(b"\x06tok_v0\x18\x02")
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[: at + 8] + b"\x01" + raw[at + 9 :])  # read as a unigram model
    model = pieces.Model.load(MODEL)
    some = "the bank raised rates yesterday andthtion erthing Zukunft développement información 2024 internationalization".split()
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    score = lambda ids: sum(library.get_score(i) for i in ids)
    for r in pieces.gather(pieces.encode(df, model)).collect():
        assert score(r.ids) == max(score(x) for x in library.nbest_encode_as_ids(some[r.doc_id], 8)) and library.decode(r.ids) == some[r.doc_id]


def test_decode_joins_back(spark):
    model = pieces.Model.load(MODEL)
    df = spark.createDataFrame([(1, [3 + b for b in "é".encode()] + [265]), (2, [3 + 0xC3]), (3, []), (4, None)], "k long, ids array<int>")
    assert {r.k: r.text for r in pieces.decode(df, model, ["k"]).collect()} == {1: "éhe", 2: "�", 3: "", 4: ""}


# --- media ---------------------------------------------------------------------


@pytest.mark.parametrize("n", [192, 192 * 64, 192 * 65, 192 * 200])
def test_media_round_trip(n):
    payload = random.Random(n).randbytes(n)
    data = media.pack(payload)
    t = media.index(data)[0]
    assert media.unpack(data) == payload and t.codec == "raw " and t.seconds == n / 8000
    keys = t.keyframes()
    assert len(keys) == -(-n // 192 // 32) and all(data[o : o + k] == payload[i * 32 * 192 : i * 32 * 192 + k] for i, (o, k) in enumerate(keys))


def test_media_reads_other_writers_and_refuses_broken_files():
    box = lambda kind, body, wide=False: (len(body) + (16 if wide else 8) if not wide else 1).to_bytes(4, "big") + kind + ((len(body) + 16).to_bytes(8, "big") if wide else b"") + body
    u = lambda *xs: b"".join(x.to_bytes(4, "big") for x in xs)
    stsd = box(b"stsd", u(0, 1) + box(b"avc1", bytes(78)))
    stbl = stsd + box(b"stts", u(0, 1, 5, 10)) + box(b"stsc", u(0, 2, 1, 2, 1, 2, 3, 1)) + box(b"stsz", u(0, 0, 5, 3, 4, 5, 6, 7)) + box(b"stco", u(0, 2, 0, 100)) + box(b"stss", u(0, 2, 1, 4))
    data = box(b"moov", box(b"trak", box(b"mdia", box(b"mdhd", u(0, 0, 0, 10, 50)) + box(b"minf", box(b"stbl", stbl))), wide=True)) + (0).to_bytes(4, "big") + b"mdat" + bytes(200)
    t = media.index(data)[0]
    assert t.codec == "avc1" and t.seconds == 5 and t.offsets.tolist() == [0, 3, 100, 105, 111] and t.keyframes() == [(0, 3), (105, 6)]
    assert [p for p, *_ in media.walk(data)][-1] == "/mdat"
    for cut in (5, 30, 150):
        with pytest.raises(ValueError):
            list(media.walk(data[:cut]))


def test_media_columns(spark, odd):
    got = media.features(media.store(odd), payload=True).collect()
    want = Counter()
    for i, t, *_ in ODD:
        p = media.padded((t or "").encode())
        want[i, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    bad = spark.createDataFrame([(b"nonsense!",), (None,)], "media binary")
    assert all(r.error and r.tracks is None for r in media.features(bad).collect())
    assert media.features(media.store(odd.limit(0))).count() == 0


def box(kind, *body):
    return (8 + sum(map(len, body))).to_bytes(4, "big") + kind + b"".join(body)


def u(*xs):
    return b"".join(x.to_bytes(4, "big") for x in xs)


def test_broken_containers_are_errors_not_crashes():
    rng = random.Random(6)
    base = media.pack(rng.randbytes(192 * 70))
    seen = Counter()
    for _ in range(3000):
        data = bytearray(base)
        for _ in range(rng.randrange(1, 4)):
            data[rng.randrange(800)] ^= 1 << rng.randrange(8)
        found = media._features(bytes(data[: rng.randrange(len(data))] if rng.random() < 0.3 else data), True)
        seen[found["error"] is None] += 1
    assert min(seen.values()) > 500
    nested = b""
    for _ in range(1200):
        nested = box(b"moov", nested)
    trak = lambda *stbl: box(b"moov", box(b"trak", box(b"mdia", box(b"minf", box(b"stbl", *stbl)))))
    cases = [nested, box(b"moov", box(b"trak", box(b"mdia", box(b"mdhd")))), trak(box(b"stsz", u(0, 7, 2**32 - 1))), trak(box(b"stsz", u(0, 1, 2)), box(b"stco", u(0, 1, 0)), box(b"stsc", u(0, 2, 1, 1, 1, 9, 1, 1))), trak(box(b"stsz", u(0, 1, 2)), box(b"stco", u(0, 1, 0)), box(b"stsc", u(0, 1, 1, 2**32 - 1, 1)), box(b"stss", u(0, 1, 3)))]
    for data in cases:
        assert media._features(data, True)["error"]


def test_all_tracks_compact_sizes_and_fragments():
    stbl = lambda codec, *rest: box(b"stbl", box(b"stsd", u(0, 1), box(codec, bytes(78))), *rest)
    trak = lambda n, *parts: box(b"trak", box(b"tkhd", u(0, 0, 0, n)), box(b"mdia", box(b"mdhd", u(0, 0, 0, 10, 50)), box(b"minf", *parts)))
    sound = trak(1, stbl(b"mp4a", box(b"stz2", u(0, 4, 3), bytes([0x12, 0x30])), box(b"stsc", u(0, 1, 1, 3, 1)), box(b"stco", u(0, 1, 0))))
    video = trak(7, stbl(b"avc1"))
    moov = box(b"moov", sound, video, box(b"mvex", box(b"trex", u(0, 7, 1, 2, 9, 0x10000))))
    trun = box(b"trun", u(0x205, 3, 100, 0, 4, 5, 6))  # sizes, data offset, flags of the first
    moof = box(b"moof", box(b"traf", box(b"tfhd", u(0x20000, 7)), trun, box(b"trun", u(0, 2))))
    data = moov + moof + box(b"mdat", bytes(200))
    a, v = media.index(data)
    assert (a.codec, a.sizes.tolist(), a.offsets.tolist(), a.keyframes()) == ("mp4a", [1, 2, 3], [0, 1, 3], [(0, 1), (1, 2), (3, 3)])
    at = len(moov) + 100
    assert (v.codec, v.sizes.tolist(), v.offsets.tolist(), v.keyframes()) == ("avc1", [4, 5, 6, 9, 9], [at, at + 4, at + 9, at + 15, at + 24], [(at, 4)])
    assert v.seconds == (50 + 5 * 2) / 10 and media._features(data, False)["tracks"][1]["codec"] == "avc1"


# --- WARC ----------------------------------------------------------------------


def test_warc(spark):
    rows = [(i, f"http://h/{i} x", "<p>%d</p>" % (i % 7)) for i in range(-3, 40)] + [(None, "http://n", "<p>0</p>"), (50, None, None), (51, "u", ""), (None, None, "only null"), (None, "v", "only null"), (5, "http://h/5 x", "<p>5</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(0))
    blocks, index = warc.archive(pages)
    got = warc.read(blocks, index).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        h = h or ""
        f = first.get(h)
        again = f is not None and i != f
        want[i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if again else "response", f if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want and all(r.intact for r in got)
    some = index.where("page_id in (3, 5, 39)")
    assert sorted(r.page_id for r in warc.read(blocks, some).collect()) == [3, 5, 5, 39]
    wide, narrow = warc.ranges(index, gap=1 << 20).count(), warc.ranges(index.where("page_id % 5 = 0"), gap=0).count()
    assert wide == index.select("archive", "block").distinct().count() and narrow > 3
    assert zlib.decompress(blocks.orderBy("archive", "at").first().data, 31).startswith(b"WARC/1.1\r\n")
    plan = warc.read(blocks, some)._jdf.queryExecution().toString()
    assert re.search(r"(In|EqualTo)\(archive", plan) and re.search(r"(In|EqualTo)\(at", plan)  # the scan skips other blocks
    assert warc.archive(pages.limit(0))[1].count() == 0
    assert all(r.record_type == "response" for r in warc.archive(pages, least=10**6)[1].collect())


# --- wrappers ------------------------------------------------------------------


def brute_match(a, b):
    """Largest simple tree match by plain recursion over elements."""
    if a.label != b.label:
        return 0
    x, y = [[k for k in n.kids if not isinstance(k, str)] for n in (a, b)]
    grid = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            grid[i + 1][j + 1] = max(grid[i][j + 1], grid[i + 1][j], grid[i][j] + brute_match(x[i], y[j]))
    return 1 + grid[-1][-1]


def test_tree_matching_is_largest():
    rng = random.Random(4)

    def page(depth=0):
        return "".join(f"<{t}>{rng.choice(['', 'x', 'y', 'zz'])}{page(depth + 1) if depth < 3 else ''}</{t}>" for t in rng.choices(["div", "ul", "section"], k=rng.randrange(4)))

    for _ in range(150):
        a, b = tree(page()), tree(page())
        pairs = wrappers.align(wrappers.Shape(wrappers.skeleton(a)[0]), wrappers.Shape(wrappers.skeleton(b)[0]))
        assert len(pairs) == brute_match(a, b)


def test_long_sibling_lists_and_deep_pages_are_matched_whole():
    rng = random.Random(8)
    for n, m in ((700, 400), (300, 900)):
        x, y = ([rng.choice("abcdefgh") for _ in range(k)] for k in (n, m))
        made = lambda tags: wrappers.Shape(wrappers.skeleton(tree("<body>" + "".join(f"<x-{t}></x-{t}>" for t in tags)))[0])
        last = [0] * (m + 1)
        for a in x:
            row = [0]
            for k, b in enumerate(y):
                row.append(max(last[k + 1], row[k], last[k] + (a == b)))
            last = row
        assert len(wrappers.align(made(x), made(y))) == last[-1] + 2
    deep = tree("<body>" + "<div>" * 5000 + "down here")
    shape = wrappers.Shape(wrappers.skeleton(deep)[0])
    assert len(wrappers.align(shape, shape)) == 5002 and wrappers.blocks(main_part(deep)) == ["down here"]


def test_regions_stand_in_for_tags(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    # tags and names that say nothing of their roles
    bare = F.replace(F.regexp_replace("html", r"<(/?)(?:nav|footer|article|header|aside)\b", "<$1div"), F.lit(' class="ad"'), F.lit(""))
    hosts = pages.select("page_id", wrappers._host(F.col("url")).alias("host"), "html").groupBy("host").agg(F.count_distinct("html").alias("n"), F.collect_list("page_id").alias("ids")).collect()
    enough = {i for h in hosts if h.n >= 5 for i in h.ids}
    want = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    with_, without = ({r.page_id: r.text for r in wrappers.extract(pages.withColumn("html", bare), w).collect()} for w in (wrappers.Wrapper(), wrappers.Wrapper(few=10**9, least=10**9)))
    same = sum(with_[i] == want[i] for i in enough)
    assert len(enough) > 100 and same >= 0.97 * len(enough) and not any(without[i] == want[i] for i in enough)


def test_main_text(spark):
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><div id="main-content"><h2>T &amp;amp; x&nbsp;y</h2>intro <b>bold</b>
      text<ul><li>one<li>two</ul><div class="comments"><p>I hate</p></div><div class="cookie-notice">c</div><form>f</form><p>end<br>line</p><table><tr><td>a<td>b</table></div><aside>s</aside><script>var x="</p>";</script><!-- n --></body>"""
    rows = [(1, "http://a/1", page), (2, None, None), (3, "u", ""), (4, "http://a/4", "<p>cut <b>off"), (1, "http://a/1", page)]
    rows += [(10 + i, f"https://H.org/{i}", f"<body><div class=box><p>Welcome to us</p></div><div><p>para {i} a</p><p>para {i} b</p><p>Subscribe now</p></div></body>") for i in range(12)]
    got = {r.page_id: r for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    assert got[1].text == "T &amp; x y\n\nintro bold text\n\none\n\ntwo\n\nend line\n\na\n\nb" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[4].text == "cut off"
    assert all(got[10 + i].text == f"para {i} a\n\npara {i} b" for i in range(12))
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- URL lists -----------------------------------------------------------------


def test_url_lists(spark):
    e = [("host", "a.x.org", "block", "2024-01-10"), ("host", "a.x.org", "remove", "2024-02-10"), ("host", "a.x.org", "block", "2025-02-10"), ("domain", "x.org", "allow", "2024-01-20"), ("domain", "x.org", "block", "2024-01-20"), ("domain", "x.org", "block", "2024-01-20"), ("prefix", "a.x.org/ok", "allow", "2024-01-01"), ("junk", "z", "block", "2024-01-01"), ("host", None, "block", "2024-01-01")]
    entries = spark.createDataFrame(e, "kind string, value string, action string, day string").select("kind", "value", "action", F.col("day").cast("timestamp_ntz").alias("since"))
    c = [(1, "http://a.x.org/p", "2024-01-09 23:00:00"), (2, "http://u@A.x.org:8/p", "2024-01-10 00:00:00"), (3, "http://a.x.org/p", "2024-02-10 00:00:00"), (4, "http://b.x.org/", "2024-01-25 00:00:00"), (5, "http://a.x.org/ok/1", "2026-01-01 00:00:00"), (6, "http://a.x.org/okay", "2026-01-01 00:00:00"), (7, None, "2026-01-01 00:00:00"), (8, "http://a.x.org/", None), (9, "nonsense", "2026-01-01 00:00:00"), (6, "http://a.x.org/okay", "2026-01-01 00:00:00")]
    captures = spark.createDataFrame(c, "id int, url string, t string").select("id", "url", F.col("t").cast("timestamp_ntz").alias("fetched"), F.lit(1).alias("blocked"), F.lit(2).alias("kind"))
    got = url_lists.evaluate(captures, entries).collect()
    assert {r.id: (r.blocked, r.rule_kind, r.n_active) for r in got} == {1: (False, None, 0), 2: (True, "host", 1), 3: (True, "domain", 1), 4: (True, "domain", 1), 5: (False, "prefix", 3), 6: (True, "host", 2), 7: (False, None, 0), 8: (False, None, 0), 9: (False, None, 0)}
    assert len(got) == 10 and url_lists.evaluate(captures.limit(0), entries).count() == 0 and url_lists.evaluate(captures, entries.limit(0)).where("blocked").count() == 0


# --- quotations ----------------------------------------------------------------


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there my friend.\nHow are you doing today?\n\nSecond paragraph goes here now."),
        (1, 1, "assistant", "On Monday, Bob wrote:\n> Hello there my friend.\n> How are you doing today?\n\nI am fine thank you."),
        (1, 2, "user", "Al wrote:\n> On Monday, Bob wrote:\n>> hello there, my friend\n>> How are you doing today\n>\n> I am fine thank you.\n\nGreat to hear that"),
        (2, 0, "user", "> I am fine thank you.\nquoted across now ok"),
        (2, 1, "user", None),
        (2, 1, "user", ""),
        (None, 5, "user", "> Great to hear that"),
        (3, 0, "user", "> Great to hear that\n\nDeep one here now"),
        (3, 1, "user", "> nobody ever said this thing\n> Yes\nfine"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("own", F.lit(1))
    linked = quotes.link(df).persist()
    got = {(r.conv_id, r.turn): tuple(r)[3:5] + tuple(r)[6:] for r in linked.collect()}
    quoted = {(r.conv_id, r.turn): [tuple(q) for q in r.quoted] for r in linked.collect()}
    assert quoted[1, 2] == [(1, 1, 1), (2, 1, 0)] and quoted[1, 1] == [(1, 1, 0)] and quoted[3, 1] == []
    assert got[1, 0] == (rows[0][3], 0, None, None, 1, 0, 0) and got[1, 1] == ("I am fine thank you.", 1, 1, 0, 1, 0, 1)
    assert got[1, 2] == ("Great to hear that", 2, 1, 1, 1, 0, 2) and got[2, 0] == ("quoted across now ok", 1, 1, 1, 1, 0, 2)
    assert got[3, 0] == ("Deep one here now", 1, 1, 2, 1, 0, 3) and got[3, 1] == ("fine", 1, None, None, 3, 1, 0) and got[None, 5][:3] == ("", 1, None)
    chat = {(r.root_conv, r.root_turn, r.part): [(m.conv_id, m.turn) for m in r.messages] for r in quotes.chats(linked, 3).collect()}
    assert chat == {(1, 0, 0): [(1, 0), (1, 1), (1, 2)], (1, 0, 1): [(2, 0), (3, 0)], (2, 1, 0): [(2, 1), (2, 1)], (3, 1, 0): [(3, 1)]} and linked.count() == len(rows)
    placed = {(r.conv_id, r.turn): r.place for r in quotes.threads(linked).collect()}
    assert placed == {(1, 0): 1, (1, 1): 2, (1, 2): 3, (2, 0): 4, (2, 1): 1, (None, 5): 1, (3, 0): 5, (3, 1): 1}
    assert [(p.v, p.t) for p in quotes.parse(df).where("turn = 2").first().passages] == [(2, "hello there, my friend\nHow are you doing today"), (1, "\nI am fine thank you.")]
    assert quotes.link(df.limit(0)).count() == 0


def test_a_deeper_quote_names_the_thread(spark):
    long = "\n".join(f"line {i} of the text" for i in range(20000))
    rows = [(1, 0, "u", "the very first words here"), (1, 1, "u", "what came after them"), (1, 2, "u", "> what was changed since then\n>> the very first words here\n\nok then my friend"), (2, 0, "u", long), (2, 1, "u", "\n".join("> " + x for x in long.split("\n")) + "\nso long a quote")]
    got = {(r.conv_id, r.turn): r for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    r = got[1, 2]
    assert (r.reply_conv, r.reply_turn, r.depth, [tuple(q) for q in r.quoted]) == (1, 0, 1, [(2, 1, 0)]) and r.content == "ok then my friend"
    assert (got[2, 1].reply_turn, got[2, 1].n_quotes, got[2, 1].content) == (0, 1, "so long a quote")


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
