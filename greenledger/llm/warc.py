"""WARC archives: pages written as records, read back by segment reassembly.

Writing. Of pages with equal payloads of at least ``least`` bytes, the one with
the largest id becomes a ``response`` record, the others ``revisit`` records that
refer to it; all other pages are responses. A response's block is an HTTP
message in chunked transfer framing. Blocks over ``segment`` bytes are cut into a
first record and ``continuation`` records, which name the first as their
origin; the last one states the total length. A task strings its records
together into archives of some ``archive`` bytes, one gzip file each, so no file
grows with the data.

Reading. A task parses whole archives record by record (by ``Content-Length``,
never by searching for a separator). Only segmented records move: they are grouped by
origin, ordered by segment number and joined if every number occurs once and
the lengths add up to the stated total. Then the HTTP head is split off, the
chunks are decoded, and length and SHA-1 of the payload are compared with the
record. Revisits find their response by record id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.common import fresh_path, numbered, written

LEAST = 1000
SEGMENT, CHUNK, ARCHIVE = 16 << 10, 4 << 10, 16 << 20
DATE = "2000-01-01T00:00:00Z"
END = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, record_type string, page_id string, target_uri string, refers_to_record string, "
          "payload_digest string, origin string, number int, total long, block binary, problem string")
PAGE = ("record_id string, record_type string, page_id string, target_uri string, refers_to_record string, "
        "payload_bytes long, payload_digest string, payload binary, problem string")


# ---------------------------------------------------------------- records as bytes

def record(kind: str, record_id: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without the two line ends that close it; None fields are left out."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields, ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8") + END + block


def named(*parts) -> str:
    """A record id that a repeated task gives again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, '/'.join(map(str, parts)))}>"


def field_text(value) -> str | None:
    """A value fit for a header line: control characters, blanks and % as %XX."""
    return None if value is None else re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", str(value))


def digest_field(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int) -> bytes:
    """``body`` in chunked transfer framing."""
    cut = [body[i:i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in cut) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of a chunked message: sizes in hex, extensions ignored, trailers
    allowed. ValueError if the framing is broken or cut off."""
    out, at = [], 0
    while True:
        end = data.find(END, at)
        size_text = data[at:end].split(b";")[0].strip()
        if end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size_text):
            raise ValueError("broken chunk size")
        size, at = int(size_text, 16), end + 2
        if not size:
            break
        if data[at + size:at + size + 2] != END:
            raise ValueError("broken chunk")
        out.append(data[at:at + size])
        at += size + 2
    if data[at:at + 2] != END and not data[at:].endswith(END + END):
        raise ValueError("broken trailer")
    return b"".join(out)


def payload_of(block: bytes) -> bytes:
    """Body of an HTTP message, out of its transfer framing."""
    head, mark, body = block.partition(END + END)
    if not mark:
        raise ValueError("no HTTP head")
    fields = [line.split(b":", 1) for line in head.split(END)[1:] if b":" in line]
    codings = [v.strip().lower() for k, v in fields if k.strip().lower() == b"transfer-encoding"]
    return unchunked(body) if b"chunked" in codings else body


def page_records(key: str, page_id, url, payload: bytes, refers_to: str | None, segment: int, chunk: int) -> list[bytes]:
    """All records of one page; ``refers_to`` is the record id that a revisit repeats."""
    about = [("WARC-Target-URI", field_text(url)), ("X-Page-ID", field_text(page_id)),
             ("WARC-Payload-Digest", digest_field(payload))]
    own = named(key)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    about.append(("Content-Type", "application/http; msgtype=response"))
    if refers_to is not None:
        return [record("revisit", own, [*about, ("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to)], head)]
    block = head + chunked(payload, chunk)
    if len(block) <= segment:
        return [record("response", own, about, block)]
    cut = [block[i:i + segment] for i in range(0, len(block), segment)]
    out = [record("response", own, [*about, ("WARC-Segment-Number", "1")], cut[0])]
    for n, part in enumerate(cut[1:], 2):
        total = str(len(block)) if n == len(cut) else None
        out.append(record("continuation", named(key, n), [
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n)), ("WARC-Segment-Total-Length", total)], part))
    return out


def inflated(data: bytes) -> bytes:
    """An archive's bytes: gzip members one after the other, or plain."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        out.append(member.flush())
        if not member.eof:
            raise ValueError("gzip member cut off")
        data = member.unused_data
    return b"".join(out)


def records_of(data: bytes):
    """(fields in lower case, block) of every record of an archive; after a
    broken place one pair ({}, reason), and no more from that archive."""
    try:
        data = inflated(data)
    except (ValueError, zlib.error) as exc:
        yield {}, str(exc)
        return
    at = 0
    while at < len(data):
        end = data.find(END + END, at)
        lines = data[at:max(end, at)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = fields.get("content-length", "")
        if end < 0 or not lines[0].startswith("WARC/") or not size.isascii() or not size.isdigit():
            yield {}, f"no record at byte {at}"
            return
        start = end + 4
        at = start + int(size)
        if data[at:at + 4] != END + END:
            yield {}, f"record at byte {start} is cut off"
            return
        yield fields, data[start:at]
        at += 4


# ---------------------------------------------------------------- Spark side

def _archives(segment: int, chunk: int, archive: int):
    def run(batches):
        held, size = [], 0

        def closed():
            info = record("warcinfo", named(hashlib.sha256(held[0]).hexdigest()), [("Content-Type", "application/warc-fields")],
                          b"format: WARC File Format 1.1\r\n")
            return pa.RecordBatch.from_arrays([pa.array([(END + END).join([info, *held])], pa.large_binary())], ["archive"])
        for batch in batches:
            for key, page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                for r in page_records(key, page_id, url, payload, refers_to and named(refers_to), segment, chunk):
                    held.append(r)
                    size += len(r)
                    if size >= archive:
                        yield closed()
                        held, size = [], 0
        if held:
            yield closed()
    return run


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                least: int = LEAST, segment: int = SEGMENT, chunk: int = CHUNK, archive: int = ARCHIVE) -> None:
    """Write every row of ``pages`` as a record into archives under ``path``.

    A null payload counts as empty; a null uri or id leaves its field out, and a null
    id is smaller than every other. Of rows that share the largest id and the
    payload, one is the response. Payloads are strings (written in UTF-8) or
    binary. Other columns are ignored, whatever their names. An empty table
    writes no record. Payloads move only if the table of repeated ones is too
    large to be broadcast.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    # One row is one record: its number is fixed once it is written.
    base = written(numbered(pages.select(
        F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"),
        F.sha2(payload, 256).alias("sha"), F.length(payload).cast("long").alias("size")), "row"), "warc-pages")
    large = base.filter(F.col("size") >= least).groupBy("sha", "size").agg(
        F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = written(large.filter("n > 1").select("sha", "size", F.col("last.row").alias("first")), "warc-repeated")
    key = F.concat_ws("/", F.lit(path), F.col("row").cast("string"))
    # Equal payloads are one hot key: their rows are split, the other side has one row a key.
    records = base.join(repeated, ["sha", "size"], "left").select(
        key.alias("key"), F.col("id").cast("string").alias("id"), "uri", "payload",
        F.when(F.col("first") != F.col("row"), F.concat_ws("/", F.lit(path), F.col("first").cast("string"))).alias("refers_to"))
    # One row is one file, closed by the two line ends that end its last record.
    (records.mapInArrow(_archives(segment, chunk, archive), "archive binary").select(F.col("archive").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def _number(text: str | None):
    return int(text) if text and text.isascii() and text.isdigit() else None


def _parsed(batches):
    limit, rows, size = 8 << 20, [], 0
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"number": pa.int32(), "total": pa.int64(), "block": pa.binary()}

    def out():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names)
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for f, block in records_of(content.as_py()):
                if not f:
                    rows.append((None,) * 10 + (f"{path}: {block}",))
                    continue
                kind = f.get("warc-type")
                if kind not in ("response", "revisit", "continuation"):
                    continue
                own = f.get("warc-record-id")
                origin = f.get("warc-segment-origin-id") if kind == "continuation" else own
                rows.append((own, kind, f.get("x-page-id"), f.get("warc-target-uri"), f.get("warc-refers-to"),
                             f.get("warc-payload-digest"), origin, _number(f.get("warc-segment-number")),
                             _number(f.get("warc-segment-total-length")), block, None))
                size += len(block)
                if size >= limit:
                    yield out()
                    rows, size = [], 0
    if rows:
        yield out()


def joined(parts: list[dict], total: int | None) -> bytes:
    """The block of a record from its (number, block) segments; ValueError if
    a number is missing or twice, or the total length is missing or another."""
    if parts[0]["number"] is None and len(parts) == 1:
        return parts[0]["block"]
    parts = sorted(parts, key=lambda p: p["number"] or 0)
    if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("segments missing or repeated")
    block = b"".join(p["block"] for p in parts)
    if total != len(block):
        raise ValueError("segments don't add up to the total length")
    return block


def _decoded(with_payload: bool):
    names = [f.split()[0] for f in PAGE.split(", ")]

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                payload = problem = None
                if r["problem"]:
                    problem = r["problem"]
                elif r["record_type"] is None:
                    problem = "segments without a first record"
                else:
                    try:
                        block = joined(r["parts"], r["total"])
                        if r["record_type"] == "response":  # a revisit may keep a head without its body
                            payload = payload_of(block)
                            if r["payload_digest"] not in (None, digest_field(payload)):
                                problem = "payload digest differs"
                    except ValueError as exc:
                        problem = str(exc)
                whole = None if problem else payload
                out.append((r["record_id"], r["record_type"], r["page_id"], r["target_uri"], r["refers_to_record"],
                            None if whole is None else len(whole), None if whole is None else hashlib.sha1(whole).hexdigest(),
                            whole if with_payload else None, problem))
            kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kinds.get(n, pa.string())) for i, n in enumerate(names)], names)
    return run


def read_pages(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Responses and revisits of the archives under ``path`` (gzip, whole or per
    record, or plain; other record types are skipped), one row per record: record_id, record_type,
    page_id, target_uri, refers_to_record, payload_bytes, payload_digest, payload, problem.

    A revisit has no payload of its own: its length, digest and payload are null
    here. ``problem`` says what is wrong with a record: broken framing, missing or
    repeated segments, a wrong total length or digest, segments without a first
    record, or, in a row of its own, an archive that breaks off. Such rows
    have null lengths and digests; the others are not affected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    records = files.mapInArrow(_parsed, RECORD)
    part = F.struct("number", "block")
    about = ["record_id", "record_type", "page_id", "target_uri", "refers_to_record", "payload_digest"]
    single = records.filter("number IS NULL").select(*about, F.array(part).alias("parts"), "total", "problem")
    # The segments of one record: as many as the record is long, whatever the data.
    first = F.col("record_type") != "continuation"
    whole = records.filter("number IS NOT NULL").groupBy("origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in about[1:]], F.collect_list(part).alias("parts"),
        F.max("total").alias("total"), F.max("problem").alias("problem"))
    whole = whole.select(F.col("origin").alias("record_id"), *about[1:], "parts", "total", "problem")
    return single.unionAll(whole).mapInArrow(_decoded(with_payload), PAGE)


def resolved(read: DataFrame) -> DataFrame:
    """``read_pages`` rows with what revisits repeat: payload_bytes and payload_digest
    of the response they refer to, and its page_id as ``refers_to``. A
    revisit whose response is not there gets a ``problem``."""
    own = read.filter("record_type = 'response'").select(
        F.col("record_id").alias("_of"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"))
    again = F.col("record_type") == "revisit"
    lost = again & F.col("problem").isNull() & F.col("_of").isNull()
    joined_ = read.join(own, F.when(again, F.col("refers_to_record")) == F.col("_of"), "left")
    return joined_.select(
        "record_id", "record_type", "page_id", "target_uri",
        F.when(again, F.col("_page")).alias("refers_to"),
        F.when(again, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(lost, "response of the revisit not found").otherwise(F.col("problem")).alias("problem"))


def archived(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", **sizes) -> DataFrame:
    """``pages`` written as archives into a new folder of the shared one and read back:
    ``id_col``, payload_bytes, payload_digest, record_type, refers_to of every
    row. An archive of this job's own that does not read back whole is an error."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_pages(pages, path, id_col, uri_col, payload_col, **sizes)
    read = written(read_pages(spark, path, with_payload=False).drop("payload"), "warc-read")
    kind = pages.schema[id_col].dataType
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).otherwise(F.col("record_type"))
    plain = lambda c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))).cast(kind)
    return resolved(read).select(plain("page_id").alias(id_col), "payload_bytes", "payload_digest",
                                 sound.alias("record_type"), plain("refers_to").alias("refers_to"))
