"""Web archives: WARC records in ZIP packages, read by ranges.

Format.  An archive is a ZIP package with two stored members.  ``archive/data.warc.gz``
holds WARC 1.1 records, each a gzip member of its own; ``indexes/index.cdx.gz`` holds one line for
each record, in order of the URL: key, date, and offset, length, digest and id as JSON.  Sizes lie in
data descriptors and ZIP64 fields, so an archive is written in one pass.  Of records with equal payloads of at
least ``least`` bytes the one with the largest id is a response, the others are revisits: HTTP headers
and a reference, no payload.

Writing.  A task turns its pages into pieces of its archive; Spark's own text writer puts the pieces
into one file for each task, so its commit protocol covers lost executors and any
store that Spark can write.  That writer ends each row with a separator; as a gzip member ends with the high byte of its size, and ZIP
headers with zero bytes, each piece ends with a zero byte anyway, and that byte is the separator.
(A member of 16 MB or more is followed by an empty one, which ends with zero.)

Reading, the method.  No member is extracted.  Of each archive the end record, the ZIP64 locator and record and the
central directory are read from its last bytes; local headers tell where stored members begin.  The index gives each
record's range.  Ranges are dealt over tasks in blocks of neighbouring records, each block a
few range reads; a selection of ids reads only its own records.  Payloads are checked against their digests.

Scale.  Copies are found by an aggregate over (digest, id), which combines before the shuffle;
its groups of two or more go back to the pages by broadcast if they are measured to be small.  Otherwise only digests of more
copies than the bounded table allows are broadcast and their pages keep out of the shuffle join, so no digest is a hot key.
A task holds the index lines of its own archive, and while reading one block of records.

Defined results.  A null body is an empty payload.  Null URLs have no target line.  A null id is smaller than any other.
Rows that repeat the largest id of their payload are all responses.  An empty table writes no archive, and reading none gives
no rows.  Very large bodies are one record each.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, materialize, small_side

# Fixed values of the formats.
LOCAL, DESCRIPTOR, CENTRAL, END, END64, LOCATOR = (b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02", b"PK\x05\x06",
                                                   b"PK\x06\x06", b"PK\x06\x07")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx.gz"
DATE = "2000-01-01T00:00:00Z"
BLOCK = 4 << 20
LINES = 5_000
_FULL, _FULL16 = 0xFFFFFFFF, 0xFFFF


# --- records -----------------------------------------------------------------


def record_name(page_id) -> str:
    return f"urn:page:{'' if page_id is None else quote(str(page_id), safe='')}"


def page_of(name: str | None) -> str | None:
    """The id in a record's name; null if there is none."""
    return None if name is None else unquote(name.strip("<>").removeprefix("urn:page:")) or None


def record(page_id, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """A WARC record as gzip.  ``digest`` is the payload's SHA-1 in hex, ``refers_to``
    the name of the response if the payload is left out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{record_name(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{refers_to}>"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _zeroed(gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0))


def _zeroed(member: bytes) -> bytes:
    return member if member[-1] == 0 else member + gzip.compress(b"", mtime=0)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def parse_record(member: bytes) -> dict:
    """Headers and payload of one record.  A response whose payload does not have
    the digest that it names is damaged, which is an error."""
    raw = gzip.decompress(member)
    top = raw.index(b"\r\n\r\n")
    head = _headers(raw[:top])
    block = raw[top + 4:top + 4 + int(head["content-length"])]
    cut = block.index(b"\r\n\r\n")
    payload = block[cut + 4:]
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    if head["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {head['warc-record-id']}")
    return {"page_id": page_of(head["warc-record-id"]), "url": head.get("warc-target-uri"),
            "record_type": head["warc-type"], "payload_digest": digest,
            "payload_bytes": int(_headers(block[:cut])["content-length"]),
            "refers_to": page_of(head.get("warc-refers-to")),
            "payload": payload if head["warc-type"] == "response" else None}


def sort_key(url: str | None) -> str:
    """Host names from the right, then the path: pages of a site lie together."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:  # no URL
        return re.sub(r"\s", "+", url)
    return re.sub(r"\s", "+", f"{host}){parts.path}{'?' + parts.query if parts.query else ''}")


# --- packages: writing ---------------------------------------------------------


class Package:
    """A ZIP package as a stream of pieces, each ending with a zero byte.  Members
    are stored; sizes and checksums follow them."""

    def __init__(self):
        self.at, self.members = 0, []

    def _piece(self, data: bytes) -> bytes:
        self.at += len(data)
        return data

    def _close(self) -> bytes:
        """The descriptor of the member that is open."""
        if not self.members or self.members[-1]["closed"]:
            return b""
        m = self.members[-1]
        m["closed"] = True
        return DESCRIPTOR + struct.pack("<IQQ", m["crc"], m["size"], m["size"])

    def open(self, name: str) -> bytes:
        data = self._close()
        self.members.append({"name": name.encode(), "at": self.at + len(data), "crc": 0, "size": 0, "closed": False})
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # version 4.5, sizes behind the data, stored, 1980-01-01
        return self._piece(data + LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, _FULL, _FULL,
                                                      len(name), len(extra)) + name.encode() + extra)

    def put(self, data: bytes) -> bytes:
        m = self.members[-1]
        m["crc"], m["size"] = zlib.crc32(data, m["crc"]), m["size"] + len(data)
        return self._piece(data)

    def end(self) -> bytes:
        out = self._close()
        start = self.at + len(out)
        for m in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, m["size"], m["size"], m["at"])
            out += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 33, m["crc"], _FULL, _FULL, len(m["name"]),
                                         len(extra), 0, 0, 0, 0, _FULL) + m["name"] + extra
        n, size = len(self.members), self.at + len(out) - start
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start)
        out += LOCATOR + struct.pack("<IQI", 0, start + size, 1)
        return self._piece(out + END + struct.pack("<HHHHIIH", 0, 0, _FULL16, _FULL16, _FULL, _FULL, 0))


def archive(rows, date: str = DATE):
    """The pieces of an archive of (page_id, url, payload, size, digest, refers_to)
    rows; nothing for no rows."""
    package, lines = Package(), []
    for page_id, url, payload, size, digest, refers_to in rows:
        if not package.members:
            yield package.open(DATA)
        begin = package.members[-1]["size"]
        data = record(page_id, url, payload, size, digest, refers_to, date)
        yield package.put(data)
        about = {"offset": begin, "length": len(data), "digest": digest, "page": record_name(page_id), "url": url}
        lines.append(f"{sort_key(url)} {date} {json.dumps(about, ensure_ascii=False)}\n")
    if package.members:
        yield package.open(INDEX)
        lines.sort()
        for i in range(0, len(lines), LINES):
            yield package.put(_zeroed(gzip.compress("".join(lines[i:i + LINES]).encode(), 6, mtime=0)))
        yield package.end()


FEW_GROUPS, HOT_COPIES, HOT_ROWS = 100_000, 10_000, 50_000  # rows of some 100 bytes


def with_references(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` with ``refers_to``, the largest id with the same payload, where that
    is larger than the row's own; null elsewhere."""
    rows = rows.withColumn("shared", F.when(F.col("size") >= least, F.col("digest")))
    groups = (rows.where("shared is not null").groupBy("shared")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
              .where("copies > 1 and first is not null"))
    groups = materialize(groups, "copies")
    size = groups.agg(F.sum("copies").alias("rows"), F.count("*").alias("n")).first()
    if size["n"] <= FEW_GROUPS:
        joined = rows.join(F.broadcast(groups.select("shared", "first")), "shared", "left")
    else:
        hot_from = max(HOT_COPIES, size["rows"] // HOT_ROWS)  # so at most HOT_ROWS digests are hot
        hot = groups.where(F.col("copies") > hot_from).select("shared", F.col("first").alias("hot_first"))
        cold = groups.where(F.col("copies") <= hot_from).select(F.col("shared").alias("key"), F.col("first").alias("cold_first"))
        known = rows.join(small_side(hot), "shared", "left")
        # a page that needs no join is spread by its id, under a key that is no digest
        alone = F.concat(F.lit("-"), F.xxhash64("page_id", "digest").cast("string"))
        key = F.when(F.col("hot_first").isNull() & F.col("shared").isNotNull(), F.col("shared")).otherwise(alone)
        joined = known.withColumn("key", key).join(cold, "key", "left").withColumn("first", F.coalesce("hot_first", "cold_first"))
    older = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first")))
    return joined.select("page_id", "url", "payload", "size", "digest", F.when(older, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, *, least: int = 1000, id_col: str = "page_id", url: str = "url",
          body: str = "html", date: str = DATE) -> None:
    """Write an archive for each task into the new ``folder``."""
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest"))

    def run(batches):
        def each():
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, link, data, size, digest, first = (c[i].as_py() for c in batch.columns)
                    yield page_id, link, data, size, digest, None if first is None else record_name(first)
        held, n = [], 0
        for piece in archive(each(), date):
            held.append(piece[:-1])  # the writer's separator is the zero byte
            n += len(piece)
            if n >= BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["piece"])
                held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["piece"])

    pieces = with_references(rows, least).mapInArrow(run, "piece binary")
    (pieces.select(F.col("piece").cast("string").alias("value")).write.option("lineSep", "\x00")
     .option("maxRecordsPerFile", 0).option("compression", "none").text(folder))


# --- packages: reading ---------------------------------------------------------


def open_file(path: str):
    """A file of any store that Arrow reads, for reading at places."""
    from pyarrow.fs import FileSystem
    path = re.sub(r"^file:/*", "/", path)
    system, name = FileSystem.from_uri(path)
    return system.open_input_file(name)


def _at(file, begin: int, size: int) -> bytes:
    file.seek(begin)
    data = file.read(size)
    if len(data) < size:
        raise ValueError("archive ends too early")
    return data


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """``values`` with those that are all ones taken from the ZIP64 field, in order."""
    while len(extra) >= 4:
        kind, size = struct.unpack_from("<HH", extra)
        if kind == 1:
            field = extra[4:4 + size]
            for i, v in enumerate(values):
                if v == _FULL and len(field) >= 8:
                    values[i], field = struct.unpack_from("<Q", field)[0], field[8:]
            break
        extra = extra[4 + size:]
    return values


def directory(file, length: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, begin of the data, size) of every member, from the end record, the ZIP64
    records if there are any, the central directory and the local headers."""
    tail = min(length, 22 + _FULL16 + 20)
    data = _at(file, length - tail, tail)
    at = data.rfind(END)
    while at >= 0 and (len(data) < at + 22 or len(data) - at - 22 != struct.unpack_from("<H", data, at + 20)[0]):
        at = data.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP package")
    n, size, start = struct.unpack_from("<HII", data, at + 10)
    place = length - tail + at
    if at >= 20 and data[at - 20:at - 16] == LOCATOR:
        end64 = struct.unpack_from("<Q", data, at - 12)[0]
        big = _at(file, end64, 56)
        if big[:4] != END64:
            raise ValueError("no ZIP64 end record where the locator points")
        n, size, start = struct.unpack_from("<QQQ", big, 32)
        place = end64
    if start + size > place:
        raise ValueError("central directory lies outside the package")
    central, at, found = _at(file, start, size), 0, {}
    for _ in range(n):
        if central[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", central, at + 10)
        packed, plain, name_n, extra_n, note_n = struct.unpack_from("<IIHHH", central, at + 20)
        offset, = struct.unpack_from("<I", central, at + 42)
        name = central[at + 46:at + 46 + name_n].decode()
        extra = central[at + 46 + name_n:at + 46 + name_n + extra_n]
        plain, packed, offset = _zip64(extra, [plain, packed, offset])
        local = _at(file, offset, 30)
        if local[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        name_n2, extra_n2 = struct.unpack_from("<HH", local, 26)
        found[name] = (method, offset + 30 + name_n2 + extra_n2, packed)
        at += 46 + name_n + extra_n + note_n
    return found


def index_lines(file, length: int):
    """(begin, length, page name) of each record of an archive, places in the package."""
    members = directory(file, length)
    for name in (DATA, INDEX):
        if name not in members:
            raise ValueError(f"no member {name}")
        if members[name][0]:
            raise ValueError(f"{name} is compressed: records cannot be read by ranges")
    _, data, _ = members[DATA]
    _, begin, size = members[INDEX]
    for line in gzip.decompress(_at(file, begin, size)).decode().split("\n"):
        if line:
            about = json.loads(line.split(" ", 2)[2])
            yield data + about["offset"], about["length"], about["page"]


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """(path, begin, length, page_id string) of every record, from the indexes."""
    def run(batches):
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(path) as file:
                    rows = list(index_lines(file, length)) if length else []
                for i in range(0, len(rows), LINES):
                    some = rows[i:i + LINES]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(some)), pa.array([r[0] for r in some], pa.int64()),
                         pa.array([r[1] for r in some], pa.int64()), pa.array([page_of(r[2]) for r in some], pa.string())],
                        ["path", "begin", "length", "page_id"])

    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return files.mapInArrow(run, "path string, begin long, length long, page_id string")


RECORD = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
                    ("payload", pa.binary())])


def read(spark: SparkSession, folder: str, wanted: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload) of every
    record, or of those whose id is in the column ``page_id`` of ``wanted``.  Revisits
    have no payload, and without ``payloads`` nothing has one.  Ids are strings."""
    rows = entries(spark, folder)
    if wanted is not None:
        ids = wanted.select(F.col("page_id").cast("string").alias("page_id")).distinct()
        rows = rows.join(small_side(ids), "page_id", "leftsemi")
    rows = checkpointed(rows)
    size = rows.agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // (16 * BLOCK)))
    blocks = (rows.withColumn("block", F.floor(F.col("begin") / BLOCK)).repartition(tasks, "path", "block")
              .groupBy("path", "block").agg(F.sort_array(F.collect_list(F.struct("begin", "length"))).alias("ranges")))

    def run(batches):
        for batch in batches:
            for path, ranges in zip(batch.column(0), batch.column(1)):
                with open_file(path.as_py()) as file:
                    found = [parse_record(r) for r in range_read(file, [(r["begin"], r["length"]) for r in ranges.as_py()])]
                if not payloads:
                    for r in found:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(found, RECORD)

    return blocks.select("path", "ranges").mapInArrow(run, """page_id string, url string, record_type string,
        payload_digest string, payload_bytes long, refers_to string, payload binary""")


def range_read(file, ranges: list[tuple[int, int]], gap: int = 64 << 10):
    """The bytes of ascending (begin, length) ranges.  Ranges that lie within ``gap``
    of each other are fetched together, up to a block and one record."""
    i = 0
    while i < len(ranges):
        begin, end, j = ranges[i][0], sum(ranges[i]), i + 1
        while j < len(ranges) and ranges[j][0] <= end + gap and end - begin < BLOCK:
            end = max(end, sum(ranges[j]))
            j += 1
        data = _at(file, begin, end - begin)
        for b, n in ranges[i:j]:
            yield data[b - begin:b - begin + n]
        i = j
