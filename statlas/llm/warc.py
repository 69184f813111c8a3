"""WARC archives: written with one gzip member per record, and read back by byte ranges.

Writing goes through Spark's text writer and its commit protocol, so a lost executor leaves no half
record: a member's last byte is the high byte of its length, zero below 16 MiB, and the writer's line
separator supplies it. (A larger record is followed by an empty member, which ends in zero too.) Equal
payloads are stored once: all but one record of a digest are revisits.

Reading splits files into ranges. A task looks for gzip magic in its range, accepts a candidate if it
decodes to a WARC header, and owns the records that start inside, reading past the end of its range
to finish the last one. Within a record it does not search, so magic inside compressed data is met only
at the beginning of a range, where the header test refuses it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.llm._util import cut, prepare

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
#: Digests with several records up to this number are broadcast (about 60 bytes each); more are joined by an exchange.
BROADCAST_DIGESTS = 400_000
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, uncompressed; a revisit if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}" if re.search(r"[^\x21-\x7e]", url) else f"WARC-Target-URI: {url}")
        if re.search(r"[^\x21-\x7e]", url):  # kept as it was, for a reader that asks
            head.append(f"X-Target-URI-Base64: {base64.b64encode(url.encode()).decode()}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 5) -> bytes:
    """raw as gzip, ending in a zero byte."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(raw) + packer.flush()
    return out if out.endswith(b"\0") else out + EMPTY_MEMBER


def payload_of(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, payload, sha1) with refers_to: the largest page_id with an equal payload, null for that one itself."""
    wanted = pages.where(F.length("payload") >= min_bytes)
    shared = wanted.groupBy("sha1").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null")
    shared = cut(shared.select(F.col("sha1").alias("_sha1"), "holder"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to")
    if shared.count() <= BROADCAST_DIGESTS:
        both = pages.join(F.broadcast(shared), (F.col("sha1") == F.col("_sha1")) & (F.length("payload") >= min_bytes), "left")
        return both.select("page_id", "url", "payload", "sha1", refers)
    ids = wanted.select("page_id", "sha1").distinct().join(shared, F.col("sha1") == F.col("_sha1")).select(F.col("page_id").alias("_id"), F.col("sha1").alias("_of"), "holder")
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_of"))  # by page, so no digest makes a hot key
    return pages.join(ids, same, "left").select("page_id", "url", "payload", "sha1", refers)


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write pages (page_id, url, html) to a folder of archives; a null html is an empty payload.

    Of records with equal payloads of at least min_bytes, that with the largest page_id is a response and the others
    are revisits. Rows that share page_id and payload are all written alike. A null page_id counts as the
    smallest; if all of a group are null, all are responses. An empty table writes no records.
    """
    prepare(pages.sparkSession)
    base = pages.select(F.col("page_id").cast("long"), "url", payload_of(F.col("html")).alias("payload"))
    rows = references(base.withColumn("sha1", F.unhex(F.sha1("payload"))), min_bytes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, sha1, refers in zip(*batch.columns, strict=True):
                body = payload.as_py()
                raw = record(page_id.as_py(), url.as_py(), body, len(body), digest32(sha1.as_py()), refers.as_py())
                out.append(member(raw)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    packed = rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    packed.write.option("lineSep", "\0").text(path)


class _Source:
    """Bytes of a file from a position on, read as they are needed."""

    def __init__(self, file: pa.NativeFile, start: int, size: int) -> None:
        self.file, self.size, self.base, self.data = file, size, start, b""
        file.seek(start)

    def upto(self, end: int) -> bool:
        """Have the bytes before end; False if the file ends earlier."""
        while self.base + len(self.data) < min(end, self.size):
            more = self.file.read(max(READ_BYTES, end - self.base - len(self.data)))
            if not more:
                break
            self.data += more
        return self.base + len(self.data) >= end

    def drop(self, before: int) -> None:
        self.data = self.data[before - self.base :]
        self.base = before

    def find(self, at: int, end: int) -> int:
        """Where the next magic starts, from at and before end; -1 if nowhere."""
        while at < end:
            self.upto(min(at + READ_BYTES, end) + len(MAGIC) - 1)
            stop = min(at + READ_BYTES, end) + len(MAGIC) - 1 - self.base
            hit = self.data.find(MAGIC, at - self.base, stop)
            if hit >= 0:
                return self.base + hit
            at = min(at + READ_BYTES, end)
            self.drop(min(at, self.base + len(self.data)))
        return -1

    def inflate(self, at: int, start: bytes = b"WARC/") -> tuple[bytes, int] | None:
        """The member at a position and where it ends; None if it is no gzip, broken off, or does not begin with start (an empty one may)."""
        unpacker, out, pos = zlib.decompressobj(31), [], at
        try:
            while not unpacker.eof:
                self.upto(pos + 1)
                chunk = self.data[pos - self.base : pos - self.base + (64 << 10)]
                if not chunk:
                    return None
                got = unpacker.decompress(chunk)
                pos += len(chunk)
                if got:
                    if not out and not got.startswith(start[: len(got)]):
                        return None
                    out.append(got)
        except zlib.error:
            return None
        return b"".join(out), pos - len(unpacker.unused_data)


def parse(raw: bytes) -> dict | None:
    """The fields of one record; None if it is no response or revisit with a block of the length it names."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    length = fields.get("content-length", "")
    if not raw.startswith(b"WARC/") or not length.isdigit() or len(rest) < int(length) or fields.get("warc-type") not in ("response", "revisit"):
        return None
    http, _, payload = rest[: int(length)].partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    named = [re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(k, "")) for k in ("warc-record-id", "warc-refers-to")]
    revisit = fields["warc-type"] == "revisit"
    url = fields.get("warc-target-uri")
    if "x-target-uri-base64" in fields:
        url = base64.b64decode(fields["x-target-uri-base64"]).decode()
    return {
        "page_id": int(named[0][1]) if named[0] else None,
        "url": url,
        "record_type": fields["warc-type"],
        "refers_to": int(named[1][1]) if revisit and named[1] else None,
        "payload": None if revisit else payload,
        "payload_bytes": int(size[1]) if revisit and size else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest32(hashlib.sha1(payload).digest()),
    }


RECORD = "file string, offset long, page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def opened(path: str) -> pa.NativeFile:
    """A file of any file system that pyarrow knows."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[5:]
    fs, at = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return fs.open_input_file(at)


def records_in(path: str, start: int, end: int, size: int) -> Iterator[dict]:
    """The records of a file that start in [start, end)."""
    with opened(path) as file:
        source, at = _Source(file, start, size), start
        while (at := source.find(at, end)) >= 0:
            got = source.inflate(at)
            if got is None:
                at += 1
                continue
            raw, after = got
            found = parse(raw) if raw else None
            if found:
                yield {"file": path, "offset": at} | found
            at = after
            source.drop(min(at, source.base + len(source.data)))


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The response and revisit records of the archives at path (a file, folder or pattern). Files that hold none give no rows."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    n = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start")).repartition(int(n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for found in records_in(row["path"], row["start"], min(row["start"] + range_bytes, row["length"]), row["length"]):
                    held.append(found)
                    size += len(found["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, _ARROW)

    return ranges.mapInArrow(run, RECORD)
