"""WARC archives of pages, and a reader that salvages damaged ones.

*Writing.* Every record is a gzip member of its own. A task joins members to
pieces of about ``FILE_BYTES`` and Spark's text writer makes each a file, with an
empty member as separator, so that each file is a valid ``.warc.gz`` stream. Of
records with equal payloads of at least ``LEAST_REVISIT`` bytes, that with the
smallest page id is the response and the others are revisits that name it;
smaller ones are all responses. Payloads are not moved to find that out: ids and
digests are counted, and only digests that occur twice are joined.

*Reading.* A file is read member by member, or, where it is not compressed,
record by record. A member or record that fails a check (member checksum,
version line, header, length, end mark, block digest) is not trusted: the reader
searches for the next member or version line at which a valid record starts, and
logs the bytes between as a quarantined gap with the reason. Later records are
thus recovered. The same search runs inside a member: a damaged record costs only
itself, and its bytes of the decompressed content are logged. Of a member whose
data break or whose checksum differs, the records before the last one found are
recovered if their block digests hold.

Defined results: a null html is an empty payload; a null url an empty target.
Rows that repeat the smallest page id of a payload are all responses; a null id
counts as the largest and is read back as null. Extra columns are not read.
"""

import base64
import gzip
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import work_folder

LEAST_REVISIT = 100
#: Bytes of a written file, about; a file is read by one task.
FILE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = b"\r\n\r\n"
_NO_RECORD = gzip.compress(b"", mtime=0)
_MEMBER = b"\x1f\x8b\x08"
_BITE = 1 << 13
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r?\n")
_VERSION = re.compile(rb"WARC/\d\.\d\r?\n")


def _identifier(page_id, digest):
    name = hashlib.md5(f"{page_id}/{digest}".encode()).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"


def build_record(page_id, url, payload, digest, first, date=DATE):
    """Bytes of one record. ``first`` is the page id of the response that this one revisits, or None."""
    block = _HTTP + (payload if first is None else b"")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _identifier(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c.group()):02X}", url or "")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if first is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _identifier(first, digest)),
            ("X-Refers-To-Page-ID", str(first)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + _END


def _members(file_bytes):
    def members(batches):
        joined, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(5)]):
                joined.append(gzip.compress(build_record(*(v.as_py() for v in row)), 6, mtime=0))
                size += len(joined[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(joined)], pa.binary())], ["members"])
                    joined, size = [], 0
        if joined:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(joined)], pa.binary())], ["members"])

    return members


def write_archives(pages: DataFrame, folder: str, file_bytes=FILE_BYTES) -> None:
    """Write ``page_id, url, html`` as files of gzip members below ``folder``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_REVISIT
    firsts = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Written before it is joined, so that Spark can split a digest that is very common.
    kept = work_folder(spark, "revisits")
    firsts.where("n > 1").select("digest", "first").write.parquet(kept)
    named = rows.join(spark.read.parquet(kept), "digest", "left")
    again = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    files = named.select("page_id", "url", "payload", "digest", again.alias("first")).mapInArrow(_members(file_bytes), "members binary")
    writer = files.select(F.col("members").cast("string")).write.option("maxRecordsPerFile", 1)
    # Members are bytes: the separator is given as Latin-1, the values are written as they are.
    writer.option("encoding", "ISO-8859-1").option("lineSep", _NO_RECORD.decode("latin-1")).text(folder)


class BadRecord(ValueError):
    """What is wrong with the bytes at a place."""


def parse_record(data, at=0):
    """``(headers, block, end)`` of the record at a place of uncompressed bytes; checks all there is to check."""
    version = _VERSION.match(data, at)
    if not version:
        raise BadRecord("no version line")
    stop = data.find(_END, version.end() - 2)
    if stop < 0:
        raise BadRecord("header without end")
    headers = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("broken header line")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdecimal() or "warc-type" not in headers:
        raise BadRecord("no length or type")
    start = stop + len(_END)
    end = start + int(headers["content-length"])
    if data[end : end + len(_END)] != _END:
        raise BadRecord("length does not meet the end mark")
    block = data[start:end]
    if digest_holds(headers, block) is False:
        raise BadRecord("block digest differs")
    return headers, block, end + len(_END)


def digest_holds(headers, block):
    """Whether the block digest of a record is right, in hex or base32; None without one that is known."""
    kind, _, value = headers.get("warc-block-digest", "").partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("sha1", "sha256", "sha512", "md5") or not value.strip():
        return None
    found, value = hashlib.new(kind, block).digest(), value.strip().lower()
    return value in (found.hex(), base64.b32encode(found).decode().lower(), base64.b32encode(found).decode().rstrip("=").lower())


def read_member(data, at):
    """``(content, end, problem)`` of the gzip member at a place; of a broken one what could be read, and no end."""
    machine, parts, bite_size = zlib.decompressobj(31), [], _BITE
    while not machine.eof:
        # Bounded bites: what a member leaves over is copied.
        bite = data[at : at + bite_size]
        if not bite:
            return b"".join(parts), None, "member without end"
        before = machine.copy()
        try:
            parts.append(machine.decompress(bite))
        except zlib.error:
            if bite_size == 1:
                return b"".join(parts), None, "member checksum or data"
            machine, bite_size = before, max(1, bite_size // 16)  # Closer to the byte at which the data break.
            continue
        at += len(bite)
    return b"".join(parts), at - len(machine.unused_data), None


def inner_records(content):
    """Yields ``(offset, length, headers, block, reason)`` of a member's content: records, and gaps up to the next valid one."""
    at, gap, reason = 0, None, None
    while at < len(content):
        try:
            headers, block, end = parse_record(content, at)
        except BadRecord as problem:
            if gap is None:
                gap, reason = at, str(problem)
            following = _VERSION.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if gap is not None:
            yield gap, at - gap, None, None, reason
            gap = None
        yield at, end - at, headers, block, None
        at = end
    if gap is not None:
        yield gap, len(content) - gap, None, None, reason


def _recovered(content):
    """Records of a broken member's content that can be trusted: digest right, and not the last that was found."""
    found = [row for row in inner_records(content) if row[2] is not None]
    return [row for row in found[:-1] if digest_holds(row[2], row[3])]


def salvage(data):
    """Yields ``(offset, length, headers, block, reason, inner offset, inner length)``.

    Records have reason None, gaps headers None. Offset and length tell the
    member, plain record or gap in the file; inside a member the inner ones tell the
    place in its content.
    """
    at, gap, reason, saved = 0, None, None, []
    while at < len(data):
        rows = None
        if data.startswith(_MEMBER, at):
            content, end, problem = read_member(data, at)
            if problem is None:
                rows = [(h, b, r, inner, size) for inner, size, h, b, r in inner_records(content)]
                if rows and all(row[0] is None for row in rows):
                    rows, problem = None, rows[0][2]
            else:
                saved += [(h, b, None, inner, size) for inner, size, h, b, _ in _recovered(content)]
        else:
            try:
                headers, block, end = parse_record(data, at)
                rows = [(headers, block, None, None, None)]
            except BadRecord as found:
                problem = str(found)
        if rows is None:
            if gap is None:
                gap, reason = at, problem
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, None, None, reason, None, None
            for row in saved:
                yield gap, at - gap, *row
            gap, saved = None, []
        for row in rows:
            yield at, end - at, *row
        at = end
    if gap is not None:
        yield gap, len(data) - gap, None, None, reason, None, None
        for row in saved:
            yield gap, len(data) - gap, *row


def _read(batches):
    names = ["path", "offset", "length", "headers", "block", "gap_reason", "inner_offset", "inner_length"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for path, data in zip(batch.column(0), batch.column(1)):
            rows, size = [], 0
            for row in salvage(data.as_py()):
                rows.append((path.as_py(), *row))
                size += len(row[3] or b"")
                if size > 8_000_000:
                    yield _record_batch(rows, names, kinds)
                    rows, size = [], 0
            yield _record_batch(rows, names, kinds)


def _record_batch(rows, names, kinds):
    columns = list(zip(*rows)) or [[]] * len(names)
    columns = [[None if v is None else list(v.items()) for v in c] if n == "headers" else c for n, c in zip(names, columns)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records and gaps of all files: ``path, offset, length, headers, block, gap_reason, inner_offset, inner_length``.

    ``headers`` (lower-case names) and ``block`` are null for a quarantined gap,
    ``gap_reason`` is null for a record. The inner columns tell the place in the
    content of a member. A file is one row here, so it must be below 2 GB.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    schema = "path string, offset bigint, length bigint, headers map<string,string>, block binary, gap_reason string,"
    schema += " inner_offset bigint, inner_length bigint"
    return files.mapInArrow(_read, schema)


def pages_of(records: DataFrame) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of records of pages."""
    head = lambda name: F.col("headers")[name]
    payload = F.expr(f"substring(block, {len(_HTTP) + 1})")
    response = head("warc-type") == "response"
    return records.where("gap_reason is null").select(
        head("x-page-id").cast("bigint").alias("page_id"),
        head("warc-target-uri").alias("url"),
        head("warc-type").alias("record_type"),
        head("x-refers-to-page-id").cast("bigint").alias("refers_to"),
        F.when(response, F.octet_length(payload).cast("bigint"))
        .otherwise(head("x-payload-length").cast("bigint"))
        .alias("payload_bytes"),
        F.when(response, F.sha2(payload, 256))
        .otherwise(F.regexp_replace(head("warc-payload-digest"), "^sha256:", ""))
        .alias("payload_digest"),
        F.when(response, payload).alias("payload"),
    )
