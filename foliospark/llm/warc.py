"""WARC archives: writing with revisits and segments, reading with reassembly.

Writing. Of records with equal payloads of at least `least` bytes, that with the largest id is a response and the others revisit it.
A response carries an HTTP message in chunked transfer coding; messages longer than a segment go on in continuation records
(WARC-Segment-Origin-ID, WARC-Segment-Number, and WARC-Segment-Total-Length on the last one). Archives are written by Spark's text
writer, whose line separator is the end of a WARC record, so they go to any file system under Spark's commit protocol. An archive
has at most `records` records of at most a segment each, which bounds what a reading task holds.

Reading. Archives come through the binaryFile source, a task holds one and decompresses it piece by piece. A record whose message is in
one piece is decoded where it is read; segments are grouped by the id of their origin, put in order by segment number, checked to be
complete and of the stated total length, joined, and freed of chunked framing. Payloads are checked against the digest in the header.
Archives are read once: what is left of a decoded record is its length and digest.

Defined cases: a null payload is empty. A null page_id counts as an id before all others and is written as -. Repeated rows are
records of their own. Segments that are missing or of another total length, broken chunks and wrong digests give a row whose
`fault` says so, with null payload. So does a part of an archive that is no WARC record, a record without type, id or valid length, one
that is cut off, and a damaged or cut gzip stream: that row has the kind `damaged`, and reading goes on at the next record, if one is
found. Names that are not of this writer give a null page_id. An empty table writes and reads nothing. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, over_arrow, scratch_path

LEAST, SEGMENT, CHUNK, RECORDS = 1000, 16_384, 4096, 512
_END, _GAP = "\r\n\r\n", b"\r\n\r\n"
_URN, _NONE = "urn:page:", "-"
#: Bytes that are decompressed at a time, and that a batch of rows may hold.
_PIECE, _BATCH = 1 << 20, 1 << 23


def record_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(of_id, of_digest, refers_to) of the pages that revisit another. Only ids and digests are shuffled; a hot digest meets a partial maximum and a skew-splittable join."""
    keys = pages.select("page_id", "digest").where(F.col("bytes") >= least)
    last = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first"), F.bool_or(F.col("page_id").isNull()).alias("unnamed"))
    last = last.where("first < refers_to or unnamed").select(F.col("digest").alias("of_digest"), "refers_to")
    found = keys.join(last, F.col("digest") == F.col("of_digest")).where("page_id < refers_to or page_id is null and refers_to is not null")
    return found.select(F.col("page_id").alias("of_id"), "of_digest", "refers_to").distinct()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError if the framing is broken. Extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size is missing")
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if size < 0 or framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(framed[at : at + size])
        at += size + 2


def _header(kind: str, name: str, block: bytes, **more: object) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *(f"{k.replace('_', '-')}: {v}" for k, v in more.items()), "WARC-Date: 2025-01-01T00:00:00Z", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _GAP + block


def records_of(key: int | None, row: int, url: str | None, payload: bytes, refers_to: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The WARC records of one page, without the separator at their ends. `row` tells repeated rows apart."""
    digest, name = "sha1:" + hashlib.sha1(payload).hexdigest(), f"{_URN}{_NONE if key is None else key}:{row}"
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    if refers_to is not None:
        more = {"WARC_Target_URI": uri, "WARC_Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC_Refers_To": f"<{_URN}{refers_to}>", "WARC_Payload_Digest": digest}
        yield _header("revisit", name, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n", **more)
        return
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [message[i : i + segment] for i in range(0, len(message), segment)]
    more = {"WARC_Target_URI": uri, "WARC_Payload_Digest": digest}
    yield _header("response", name, pieces[0], **more, **({"WARC_Segment_Number": 1} if len(pieces) > 1 else {}))
    for k, piece in enumerate(pieces[1:], 2):
        last = {"WARC_Segment_Total_Length": len(message)} if k == len(pieces) else {}
        yield _header("continuation", f"{name}:{k}", piece, WARC_Target_URI=uri, WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Number=k, **last)


class Damaged(ValueError):
    """A part of an archive that cannot be read; `at` is its place in the decompressed archive."""

    def __init__(self, at: int, why: str) -> None:
        super().__init__(why)
        self.at = at


def pieces(content: bytes) -> Iterator[bytes | Damaged]:
    """The decompressed archive, piece by piece, member after member; a fault at its end if the stream is damaged."""
    left, at, out = memoryview(content), 0, 0
    unpack = zlib.decompressobj(31)
    try:
        while at < len(left) or unpack.unconsumed_tail:
            fed = unpack.unconsumed_tail or left[at : at + _PIECE]
            at += 0 if unpack.unconsumed_tail else len(fed)
            piece = unpack.decompress(fed, _PIECE)
            out += len(piece)
            if piece:
                yield piece
            if unpack.eof:
                at -= len(unpack.unused_data)
                unpack = zlib.decompressobj(31)
                if at >= len(left):
                    return
        if content:
            yield Damaged(out, "the gzip stream is cut off")
    except zlib.error as e:
        yield Damaged(out, f"the gzip stream is damaged: {e}")


def parse(content: Iterator[bytes | Damaged]) -> Iterator[tuple[dict[str, str], bytes] | Damaged]:
    """(headers in lower case, block) of every record of an archive, and its faults. Holds a record and a piece."""
    held, at, fault = bytearray(), 0, None

    def more() -> bool:
        nonlocal fault
        piece = next(content, None)
        if isinstance(piece, Damaged):
            fault = piece
        elif piece is not None:
            held.extend(piece)
        return isinstance(piece, bytes)

    def drop(n: int) -> None:
        nonlocal at
        del held[:n]
        at += n

    def find(what: bytes, lo: int = 0) -> int:
        """Where it begins, from `lo` on; -1 if it does not come any more."""
        while (found := held.find(what, lo)) < 0:
            lo = max(lo, len(held) - len(what) + 1)
            if not more():
                return -1
        return found

    def skip(why: str) -> Damaged:
        """Goes to the next record that begins behind this place."""
        out, end = Damaged(at, why), find(_GAP + b"WARC/", 1)
        drop(end + len(_GAP) if end >= 0 else len(held))
        return out

    while held or more():
        while len(held) < 5 and more():
            pass
        if not held.startswith(b"WARC/"):
            if held.strip(b"\r\n"):
                yield skip("no WARC record")
            else:
                drop(len(held))
            continue
        end = find(_GAP)
        if end < 0:
            yield skip("the WARC header is cut off")
            continue
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in bytes(held[:end]).decode("utf-8", "replace").split("\r\n")[1:])}
        size = fields.get("content-length", "")
        lacking = [k for k in ("warc-type", "warc-record-id") if k not in fields]
        if lacking or not re.fullmatch("[0-9]{1,18}", size):
            yield skip(f"the WARC header lacks {lacking[0]}" if lacking else "the content length is missing or no number")
            continue
        whole = end + 4 + int(size)
        while len(held) < whole and more():
            pass
        if len(held) < whole:
            yield skip("the record is cut off")
            continue
        yield fields, bytes(held[end + 4 : whole])
        drop(whole)
        while len(held) < 4 and more():
            pass
        if held[:4] == _GAP:
            drop(4)
        elif held:
            yield skip("the record's end is missing")
    if fault is not None:
        yield fault


def write_archives(pages: DataFrame, path: str, least: int = LEAST, segment: int = SEGMENT, records: int = RECORDS) -> None:
    """Gzipped WARC archives of (page_id, url, html)."""
    raw = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), raw.alias("payload"))
    told = rows.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("bytes"))
    revisits = record_types(told, least)
    placed = rows.withColumn("digest", F.sha1("payload"))
    placed = placed.join(revisits, F.col("page_id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest")), "left").select("page_id", "url", "payload", "refers_to")

    def make():
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal row
            out = []
            for key, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += records_of(key, part << 33 | row, url, payload, refers, segment)
                row += 1
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

        return work

    over_arrow(placed, "value binary", make).select(F.col("value").cast("string").alias("value")).write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def _decoded(message: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    """(payload, fault) of an HTTP message."""
    head, gap, body = message.partition(_GAP)
    if not gap:
        return None, "HTTP header is cut off"
    try:
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError as e:
        return None, f"chunked framing: {e}"
    if digest and digest.lower() != "sha1:" + hashlib.sha1(payload).hexdigest():
        return None, "payload digest differs"
    return payload, None


_RECORD = "kind string, name string, origin string, segment int, total long, refers_to string, digest string, block binary, payload binary, payload_bytes long, payload_digest string, fault string"
_TYPES = [pa.string()] * 3 + [pa.int32(), pa.int64()] + [pa.string()] * 2 + [pa.binary()] * 2 + [pa.int64()] + [pa.string()] * 2


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("[0-9]{1,9}", text) else None


def _row(found: tuple[dict[str, str], bytes] | Damaged, payloads: bool) -> tuple:
    if isinstance(found, Damaged):
        return ("damaged", None, None, None, None, None, None, None, None, None, None, f"at byte {found.at}: {found}")
    h, block = found
    bare = lambda k: h.get(k, "").strip("<>") or None
    kind, name, segment = h["warc-type"].lower(), bare("warc-record-id"), h.get("warc-segment-number")
    first = (kind, name, bare("warc-segment-origin-id") or name, _number(segment), _number(h.get("warc-segment-total-length")), bare("warc-refers-to"), h.get("warc-payload-digest"))
    if kind == "continuation" or segment is not None:
        return (*first, block, None, None, None, None)
    if kind != "response":
        return (*first, None, None, None, None, None)
    payload, fault = _decoded(block, h.get("warc-payload-digest"))
    shown = (None, None) if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
    return (*first, None, payload if payloads else None, *shown, fault)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of all archives. Segments carry their block; responses in one piece their payload (if asked for), its length and digest, or a fault."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = [f.split()[0] for f in _RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=names)
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for found in parse(pieces(content.as_py())):
                    rows.append(_row(found, payloads))
                    held += 1000 + len(rows[-1][7] or b"") + len(rows[-1][8] or b"")
                    if held > _BATCH:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    return files.mapInArrow(run, _RECORD)


def _joined(pieces: list[dict], total: int | None) -> tuple[bytes | None, str | None]:
    """(message, fault) of the segments of one record."""
    ordered = sorted(pieces, key=lambda p: (p["segment"] is None, p["segment"]))
    if [p["segment"] for p in ordered] != list(range(1, len(ordered) + 1)):
        return None, "segments are missing or repeated"
    message = b"".join(p["block"] for p in ordered)
    return (message, None) if total == len(message) else (None, "total length differs")


def reassembled(records: DataFrame, payloads: bool = True) -> DataFrame:
    """(name, payload, payload_bytes, payload_digest, fault) of every response. Only segments are shuffled, by the id of their origin; a group is one payload."""
    shown = ["name", "payload", "payload_bytes", "payload_digest", "fault"]
    parts = records.where(F.col("block").isNotNull()).groupBy(F.col("origin").alias("name")).agg(
        F.max(F.when(F.col("segment") == 1, F.col("digest"))).alias("digest"), F.collect_list(F.struct("segment", "block")).alias("pieces"), F.max("total").alias("total")
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for name, digest, pieces, total in zip(*(batch.column(c).to_pylist() for c in ("name", "digest", "pieces", "total")), strict=True):
                message, fault = _joined(pieces, total)
                payload, fault = (None, fault) if fault else _decoded(message, digest)
                told = (None, None) if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
                out.append((name, payload if payloads else None, *told, fault))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()), strict=True)], names=shown)

        return work

    joined = over_arrow(parts, "name string, payload binary, payload_bytes long, payload_digest string, fault string", make)
    return joined.unionByName(records.where("kind = 'response' and block is null").select(*shown))


def _page(name: Column) -> Column:
    """The page of a name of this writer, as it is written."""
    return F.regexp_extract(name, f"^{_URN}(-?[0-9]+|-)(:|$)", 1)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, fault) of all pages of the archives; a revisit has its response's payload."""
    records = materialise(read_records(spark, path, payloads=False).drop("payload").withColumn("payload", F.lit(None).cast("binary")), "records")
    found = materialise(reassembled(records, payloads=False).select(_page(F.col("name")).alias("page"), "payload_bytes", "payload_digest", "fault"), "responses", small=True)
    revisits = records.where("kind = 'revisit'").select(_page(F.col("name")).alias("page"), _page(F.col("refers_to")).alias("refers"), F.substring("digest", 6, 40).alias("told"))
    of = found.where("fault is null").select(F.col("page").alias("of_page"), F.col("payload_digest").alias("of_digest"), "payload_bytes").distinct()
    met = revisits.join(of, (F.col("refers") == F.col("of_page")) & (F.col("told") == F.col("of_digest")), "left")
    met = met.select("page", "payload_bytes", F.col("of_digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers", F.when(F.col("of_page").isNull(), "the response is missing").alias("fault"))
    unread = records.where("kind = 'damaged'").select(F.lit("").alias("page"), F.lit(None).cast("long").alias("payload_bytes"), F.lit(None).cast("string").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit("").alias("refers"), "fault")
    both = found.select("page", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit("").alias("refers"), "fault").unionByName(met).unionByName(unread)
    return both.select(F.expr("try_cast(page as bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.expr("try_cast(refers as bigint)").alias("refers_to"), "fault")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(load(spark, sf_dir, "pages"), path)
    return read_pages(spark, path).where("record_type != 'damaged'").drop("fault")


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""
