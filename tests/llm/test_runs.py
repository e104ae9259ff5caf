"""Periodic runs, importance resampling and web archives against brute force, on
awkward rows and on empty tables."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import struct
import zipfile
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm import QUERIES, periodic, resample, warc
from tessera.llm.common import table
from tessera.session import shared_dir

from .fixtures import EXTRA, SF, awkward_docs, empty_docs, words


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# 11 ------------------------------------------------------------------------
def plain_runs(w, least=24, periods=3):
    """By definition: of every lag the maximal stretches, without those whose smallest
    period is smaller."""
    number = {}
    ids = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    n, out = len(ids), []
    for q in range(1, n // periods + 1):
        same = np.r_[False, ids[:n - q] == ids[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            part = ids[s:e + q]
            if len(part) < max(least, periods * q):
                continue
            if not any((part[:-d] == part[d:]).all() for d in range(1, q)):
                out.append((s, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 30)), max_size=6),
       st.integers(2, 26), st.integers(2, 4))
def test_runs_of_repeated_pieces(pieces, least, periods):
    w = [x for piece, times in pieces for x in piece * times]
    assert periodic.word_runs(w, least, periods) == plain_runs(w, least, periods)


def test_runs_on_random_words():
    r = random.Random(4)
    for size, letters in ((400, "ab"), (900, "a"), (700, "abcdefgh"), (30, "ab"), (23, "a"), (24, "a")):
        w = [r.choice(letters) for _ in range(size)]
        assert periodic.word_runs(w) == plain_runs(w)
        block = [r.choice(letters) for _ in range(r.randint(5, 60))]
        w = w + block * 7 + w[:50] + block[:9] * 4
        runs = periodic.word_runs(w)
        assert runs == plain_runs(w) and periodic.collapse(w, runs) == plain_collapsed(w, runs)


def test_runs_of_a_very_long_text(monkeypatch):
    block = [str(i) for i in range(9_999)]
    w = block * 20 + ["x"] * 60_000 + ["a", "b", "a", "b", "c"] * 9_000
    want = [(0, 199_980, 9_999), (199_980, 60_000, 1), (259_980, 45_000, 5)]
    assert periodic.word_runs(w) == want
    monkeypatch.setattr(periodic, "PAIRS", 1 << 12)  # many portions of lags
    assert periodic.word_runs(w[:30_000] + w[199_000:210_000]) == plain_runs(w[:30_000] + w[199_000:210_000])[:2]


def test_segments_are_split_until_stable():
    w = list("abcabcabc") + ["once"] + list("ab") * 20 + ["twice"] + list("xyz") * 9 + ["twice"]
    ids = np.array([hash(x) for x in w])
    assert periodic.frequent_segments(ids, 3, 24) == [(10, 50), (51, 78)]
    assert periodic.frequent_segments(ids[:9], 3, 24) == [] and periodic.frequent_segments(ids[:0], 3, 24) == []


def test_detect(spark):
    rep = "one two three four five six seven eight nine ten "
    extra = spark.createDataFrame([(50, "start " + rep * 4 + "end", "", "", 1), (51, "a " * 24, "", "", 1),
                                   (52, "a " * 23, "", "", 1), (50, "start " + rep * 4 + "end", "", "", 1)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = awkward_docs(spark, extra=False).unionByName(extra).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("x"))
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.detect(docs).collect())
    want = Counter()
    for i, t in rows_of(docs, "doc_id", "text"):
        w = (t or "").encode().split()
        runs = plain_runs(w) if len(w) < 20_000 else []
        want[i, len(w), tuple(runs), b" ".join(plain_collapsed(w, runs)).decode()] += 1
    assert got == want and got[50, 42, ((1, 40, 10),), "start " + rep + "end"] == 2
    assert periodic.detect(empty_docs(spark)).collect() == []


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def test_periodic_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs, some = rows_of(table(spark, SF, "documents"), "doc_id", "text"), 0
    assert len(got) == len(docs)
    for i, t in docs:
        w = planted(i, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        runs = plain_runs(w)
        r = got[i]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == (
            (*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(plain_collapsed(w, runs)).encode()).hexdigest()
        some += bool(runs)
    assert some > 5


# 12 ------------------------------------------------------------------------
PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType())])


def pages(spark):
    big = "é" + "x" * 1200
    rows = [(1, "http://a.example.com/x?y=1", big), (2, "http://b.example.com/", big), (3, None, big), (3, None, big),
            (4, "http://a.example.com/\r\nx", "y" * 998 + "é"), (5, "http://a", "y" * 998 + "é"),
            (6, "no url at all", "z" * 999), (7, "http://[bad", "z" * 999), (8, "http://c/é", None), (9, "http://c/", ""),
            (None, "http://d/", big), (None, None, "only" * 400), (10, "http://e/", "a\r\n\r\nb\x00" * 300),
            (11, "http://f/", "".join(random.Random(1).choices("abcdefgh", k=17 << 20))), (-12, "", "w" * 5000)]
    df = spark.createDataFrame(rows, PAGES)
    for c in (*EXTRA, "payload", "digest", "size", "shared", "first", "key", "refers_to", "value"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def plain_records(rows, least=1000):
    body = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in body:
        if len(b) >= least and i is not None:
            first[b] = max(first.get(b, i), i)
    out = Counter()
    for i, b in body:
        older = b in first and (i is None or i < first[b])
        out[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if older else "response", first[b] if older else None] += 1
    return out


def read_digests(spark, folder):
    got = warc.read(spark, folder)
    return Counter((r.page_id if r.page_id is None else int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                    None if r.refers_to is None else int(r.refers_to)) for r in got.collect())


@pytest.mark.parametrize("large", [False, True])
def test_archives_round_trip(spark, monkeypatch, large):
    if large:  # digests beyond the bound: few hot ones by broadcast, the others by a shuffle join
        for name, value in (("FEW_GROUPS", 0), ("HOT_ROWS", 3), ("HOT_COPIES", 2)):
            monkeypatch.setattr(warc, name, value)
    df, folder = pages(spark).repartition(3, "page_id"), shared_dir(spark, "warc")
    rows = rows_of(df, "page_id", "url", "html")
    warc.write(df, folder)
    assert read_digests(spark, folder) == plain_records(rows)
    payloads = {r.page_id: r.payload for r in warc.read(spark, folder).where("record_type = 'response'").collect()}
    for i, _, h in rows:
        if str(i) in payloads:
            assert bytes(payloads[str(i)]) == (h or "").encode()
    some = warc.read(spark, folder, spark.createDataFrame([(3,), (8,), (77,)], "page_id long"))
    assert sorted(r.page_id for r in some.collect()) == ["3", "3", "8"]


def test_archives_are_sound_packages(spark, tmp_path):
    folder = shared_dir(spark, "warc")
    warc.write(table(spark, SF, "pages").limit(40).coalesce(2), folder)
    files = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    seen = 0
    for path in files:
        with zipfile.ZipFile(re.sub("^file:/*", "/", path)) as z:
            assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            raw = gzip.decompress(z.read(warc.DATA))
            lines = gzip.decompress(z.read(warc.INDEX)).decode().splitlines()
            assert raw.count(b"WARC/1.1\r\n") == len(lines) and lines == sorted(lines)
            seen += len(lines)
    assert seen == 40


def made(members, mode=zipfile.ZIP_STORED, comment=b"", zip64=False):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", mode) as z:
        z.comment = comment
        for name, data in members.items():
            with z.open(name, "w", force_zip64=zip64) as m:
                m.write(data)
    return f.getvalue()


def test_packages_by_other_writers(spark):
    one = warc.record(5, "http://x/", b"hello", 5, hashlib.sha1(b"hello").hexdigest(), None, warc.DATE)
    two = warc.record(6, None, b"", 5, hashlib.sha1(b"hello").hexdigest(), "urn:page:5", warc.DATE)
    line = lambda at, n, i: f'x {warc.DATE} {{"offset": {at}, "length": {n}, "page": "urn:page:{i}"}}\n'
    index = gzip.compress((line(0, len(one), 5) + line(len(one), len(two), 6)).encode())
    members = {"fuzzy.json": b"{}" * 9, warc.DATA: one + two, warc.INDEX: index}
    for comment in (b"", b"note PK\x05\x06 " + bytes(40), bytes(60_000)):
        for zip64 in (False, True):
            data = made(members, comment=comment, zip64=zip64)
            file = io.BytesIO(data)
            assert data[slice(*(lambda m: (m[1], m[1] + m[2]))(warc.directory(file, len(data))["fuzzy.json"]))] == b"{}" * 9
            found = list(warc.index_lines(file, len(data)))
            got = [warc.parse_record(r) for r in warc.range_read(file, [f[:2] for f in found])]
            assert [(g["page_id"], g["record_type"], g["payload_bytes"], g["refers_to"]) for g in got] == [
                ("5", "response", 5, None), ("6", "revisit", 5, "5")]
    for bad in (made(members, zipfile.ZIP_DEFLATED), made({warc.DATA: one}), data[:-7], b"", b"no package at all" * 9):
        with pytest.raises(ValueError):
            list(warc.index_lines(io.BytesIO(bad), len(bad)))


def test_zip64_places_beyond_four_gigabytes():
    """A sparse package: the data member begins behind 5 GB that nothing reads."""
    class Sparse(io.RawIOBase):
        def __init__(self, parts, length):
            self.parts, self.length, self.at, self.reads = parts, length, 0, 0

        def seek(self, at, whence=0):
            self.at = at

        def read(self, n=-1):
            self.reads += n
            out = bytearray(n)
            for begin, data in self.parts:
                a, b = max(begin, self.at), min(begin + len(data), self.at + n)
                if a < b:
                    out[a - self.at:b - self.at] = data[a - begin:b - begin]
            return bytes(out)

    package = warc.Package()
    first = package.open("big.bin")
    package.members[-1]["size"] = 5 << 30
    package.at += 5 << 30
    rest = package.open(warc.DATA) + package.put(b"abc\0") + package.end()
    begin = len(first) + (5 << 30)
    file = Sparse([(0, first), (begin, rest)], begin + len(rest))
    found = warc.directory(file, file.length)
    assert found["big.bin"] == (0, len(first), 5 << 30)
    method, at, size = found[warc.DATA]
    file.seek(at)
    assert (method, file.read(size)) == (0, b"abc\0") and at > 5 << 30 and file.reads < 1 << 20


def test_damaged_payload_is_an_error():
    raw = gzip.decompress(warc.record(5, "u", b"hello", 5, hashlib.sha1(b"hello").hexdigest(), None, warc.DATE))
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(raw.replace(b"hello", b"hullo")))
    assert base64.b32encode(hashlib.sha1(b"hello").digest()) in raw
    assert struct.unpack("<I", warc.record(1, None, b"", 0, "00" * 20, None, warc.DATE)[-4:])[0] < 1 << 24


def test_archives_of_an_empty_table(spark):
    folder = shared_dir(spark, "warc")
    warc.write(spark.createDataFrame([], PAGES), folder)
    assert warc.read(spark, folder).collect() == []


def test_warc_query(spark):
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in QUERIES["op12_warc_zip"](spark, SF).collect())
    assert got == plain_records(rows_of(table(spark, SF, "pages"), "page_id", "url", "html"))


# 13 ------------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, order, buckets=10_000):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def plain_draw(docs, target, order=1, percent=10, least=20):
    s, t = Counter(), Counter()
    bags = [(i, *plain_features(x, order)) for i, x in docs]
    for _, _, f in bags:
        s.update(f)
    for x in target:
        t.update(plain_features(x, order)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float((t[b] + 1) * (big_s + 10_000)) / float((s[b] + 1) * (big_t + 10_000))))
    out = []
    for i, n, f in bags:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f)) // len(f) if f else 0
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[:len(able) * percent // 100]


@pytest.mark.parametrize("order", [1, 3])
@pytest.mark.parametrize("make", [lambda s: table(s, SF, "documents"), awkward_docs, empty_docs])
def test_resampling(spark, make, order):
    docs = make(spark)
    target = table(spark, SF, "benchmark").unionByName(spark.createDataFrame(
        [(None, words(30, 3)), (7, None), (8, ""), (9, "One TWO é")], "item_id long, text string"))
    got = resample.resample(docs, target, order=order, percent=40).collect()
    want, drawn = plain_draw(rows_of(docs, "doc_id", "text"), [r.text for r in target.collect()], order, 40)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[4]) for r in drawn]


def test_resampling_without_target_and_equal_rows(spark):
    docs = spark.createDataFrame([(1, words(30, 5))] * 300 + [(2, words(30, 6))] * 20, "doc_id long, text string")
    got = resample.resample(docs, spark.createDataFrame([], "item_id long, text string"))
    assert sorted(r.rank for r in got.collect() if r.rank) == list(range(1, 33))
    want, drawn = plain_draw(rows_of(docs, "doc_id", "text"), [])
    assert Counter((r.doc_id, r.score) for r in got.collect() if r.rank) == Counter((r[0], r[4]) for r in drawn)


def test_ngrams_of_a_part_of_a_batch():
    import pyarrow as pa
    texts = [words(k % 40, k) + " One TWO É" for k in range(200)] + [""]
    for kind in (pa.string(), pa.large_string()):
        for at in (0, 70, 199):
            for n, (owner, bucket) in enumerate(resample.hashed_ngrams(pa.array(texts, kind).slice(at), 2, 10_000), 1):
                want = [(k, b) for k, t in enumerate(texts[at:]) for b in plain_features(t, n)[1][-max(plain_features(t, n)[0] - n + 1, 0):]
                        if plain_features(t, n)[0] >= n]
                assert list(zip(owner.tolist(), bucket.tolist())) == want


def test_resampling_of_batches_beyond_a_slice(spark):
    rows = [(k, words(30, k) + " A" * 1_200_000) for k in range(12)] + [(k, words(40, k)) for k in range(12, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = resample.resample(docs, docs.where("doc_id > 50"), percent=40).collect()
    want, drawn = plain_draw(rows, [t for k, t in rows if k > 50], percent=40)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    assert [r.doc_id for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == [r[0] for r in drawn]


def test_resampling_query(spark):
    want, drawn = plain_draw(rows_of(table(spark, SF, "documents"), "doc_id", "text"),
                             [r.text for r in table(spark, SF, "benchmark").collect()])
    ranks = {r[0]: k for k, r in enumerate(drawn, 1)}
    assert Counter(map(tuple, QUERIES["op13_importance_resampling"](spark, SF).collect())) == Counter(
        (i, f, w, s, ranks.get(i)) for i, _, f, w, s in want)
