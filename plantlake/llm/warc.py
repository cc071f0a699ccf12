"""WARC archives through a chunked record table.

Writing: payloads are cut into chunk rows (record, chunk number, bytes) before
anything is shuffled, and each task streams its chunk rows, in order, into
archives under the shared folder (one gzip member per record, as is usual; one
file per task, a new one after ``archive_bytes``), carrying the digest from
chunk to chunk; Arrow batches are bounded in bytes by Spark, so no step holds a
record.  Only ``pages`` itself has a payload as one value.  Records with equal
payloads (equal SHA-1 and length) are written once, as the response of the
smallest id; the others are revisits that refer to it.  Which they are is
found on digests alone and stands as one row before a page's chunks, so the
chunk rows are shuffled once, by payload and id, and a payload that a third of
all rows share meets in no task.

Reading: each archive is streamed into rows (record, chunk number, bytes)
of at most ``chunk_bytes`` payload bytes.  A row carries the number of bytes
and the SHA-1 of the payload up to and including its chunk, so the last chunk
of a record has the digest of the whole payload and no step ever holds a whole
record.  A response whose digest is not the declared one is an error.

Edge cases: a null payload is empty; an empty payload has one empty chunk; a
null id sorts behind all others and never hides them; rows with the same id
and payload are all responses or all revisits; a null url has no target
field; an empty table writes no archive; a long payload is many chunk rows;
only the three named columns are read, so others cannot clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import atomic_output, cut, new_folder, open_input

CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 256 << 20
GZIP_LEVEL = 3
MIN_REVISIT_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records bigint, bytes bigint"
CHUNKS = ("archive string, record_no bigint, record_id string, page_id bigint, url string, record_type string, refers_to bigint, chunk_no bigint, "
          "n_bytes bigint, bytes_so_far bigint, digest_so_far string, is_last boolean, payload_bytes bigint, "
          "payload_digest string, payload binary")


def record_plan(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                min_revisit_bytes: int = MIN_REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The payloads' chunk rows (sha1, page_id, record, chunk_no, url, n_bytes, first, payload), and a row with
    ``record`` -1 per page that is a revisit: ``first`` is the id that it refers to."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload")).withColumn("sha1", F.sha1("payload")) \
        .withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
    digests = rows.select("page_id", "sha1", "n_bytes")
    firsts = digests.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("sha1", "n_bytes").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1 and first is not null")
    later = digests.join(firsts, ["sha1", "n_bytes"]).filter(~F.col("page_id").eqNullSafe(F.col("first"))) \
        .select("sha1", "page_id", "first").distinct()
    last = F.greatest(F.ceil(F.col("n_bytes") / chunk_bytes), F.lit(1)).cast("int") - 1
    pieces = F.transform(F.sequence(F.lit(0), last),
                         lambda i: F.substring(F.col("payload"), i * chunk_bytes + 1, F.lit(chunk_bytes)))
    # Behind the generator a row has its own chunk only.
    chunks = rows.withColumn("record", F.monotonically_increasing_id()).select(
        "sha1", "page_id", "record", "url", "n_bytes", F.posexplode(pieces).alias("chunk_no", "payload"))
    none = F.lit(None)
    return chunks.select(
        "sha1", "page_id", "record", "chunk_no", "url", "n_bytes", none.cast("bigint").alias("first"),
        "payload").unionByName(
        later.select("sha1", "page_id", F.lit(-1).cast("bigint").alias("record"), F.lit(0).alias("chunk_no"),
                     none.cast("string").alias("url"), F.lit(0).cast("bigint").alias("n_bytes"), "first",
                     none.cast("binary").alias("payload")))


def _urn(page_id, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{sha1}')}>"


def _header(page_id, url, n: int, sha1: str, first) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
             f"WARC-Record-ID: {_urn(page_id, sha1)}", f"WARC-Date: {DATE}",
             "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {n}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    http = _HTTP % n
    if first is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(first, sha1)}", f"X-Refers-To-Page-Id: {first}"]
    lines.append(f"Content-Length: {len(http) + (n if first is None else 0)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archive:
    """An archive that is being written: a gzip member per record, whose digest is carried from chunk to chunk."""

    def __init__(self, out):
        self.out, self.records, self.bytes, self.member = out, 0, 0, None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def begin(self, page_id, url, n: int, sha1: str, first) -> None:
        self.member, self.sha1 = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31), None if first is not None else sha1
        self.so_far = hashlib.sha1()
        self._put(self.member.compress(_header(page_id, url, n, sha1, first)))
        self.records += 1

    def chunk(self, payload) -> None:
        if self.sha1 is not None:  # a revisit has no payload
            self.so_far.update(payload)
            self._put(self.member.compress(payload))

    def end(self) -> None:
        if self.member is None:
            return
        if self.sha1 is not None and self.so_far.hexdigest() != self.sha1:
            raise ValueError("a record's chunks are not those of its payload")
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.member = None


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the ``record_plan`` rows; a manifest row per archive (computed once)."""
    names = ("sha1", "page_id", "record", "chunk_no", "url", "n_bytes", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*row, batch.column("payload")[i]) for batch in batches for i, row in enumerate(zip(
            *(batch.column(c).to_pylist() for c in names))))
        part, no, page, first = TaskContext.get().partitionId(), 0, None, None
        row = next(rows, None)
        while row is not None:
            name = f"{folder}/part-{part:06d}-{no:04d}.warc.gz"
            with atomic_output(name) as out:
                archive = _Archive(out)
                while row is not None:
                    sha1, page_id, record, chunk_no, url, n, refers_to, payload = row
                    if record < 0:  # stands before the chunks of its page
                        page, first = (sha1, page_id), refers_to
                    else:
                        if chunk_no == 0:
                            archive.end()
                            if archive.bytes >= archive_bytes:
                                break
                            archive.begin(page_id, url, n, sha1, first if page == (sha1, page_id) else None)
                        archive.chunk(memoryview(payload.as_buffer()))
                    row = next(rows, None)
                archive.end()
            if archive.records:
                yield pa.RecordBatch.from_pydict({"archive": [name], "records": [archive.records],
                                                  "bytes": [archive.bytes]})
            no += 1

    sorted_rows = plan.select(*names, "payload").repartition("sha1", "page_id") \
        .sortWithinPartitions("sha1", "page_id", "record", "chunk_no")
    return cut(sorted_rows.mapInArrow(write, MANIFEST))


def _fields(stream) -> dict[str, str] | None:
    """The next record's header fields (lower-case names), or None at the end."""
    first = stream.readline()
    if not first:
        return None
    if first.strip() != b"WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class _Lines:
    """Bounded reads and short lines over a raw input stream."""

    def __init__(self, raw):
        self.raw, self.kept = raw, b""

    def readline(self) -> bytes:
        while (end := self.kept.find(b"\n")) < 0:
            more = self.raw.read(1 << 16)
            if not more:
                line, self.kept = self.kept, b""
                return line
            self.kept += more
        line, self.kept = self.kept[:end + 1], self.kept[end + 1:]
        return line

    def read(self, n: int) -> bytes:
        out = self.kept[:n]
        self.kept = self.kept[n:]
        while len(out) < n and (more := self.raw.read(n - len(out))):
            out += more
        return out


def _number(value: str | None):
    return None if value is None else int(value)


def _records(stream: _Lines, chunk_bytes: int):
    """Chunk rows of one archive."""
    while (f := _fields(stream)) is not None:
        left = int(f["content-length"])
        while (line := stream.readline()) not in (b"\r\n", b""):
            left -= len(line)
        left -= len(line)  # the blank line behind the HTTP header
        declared, kind = f["warc-payload-digest"].removeprefix("sha1:"), f["warc-type"]
        sha, so_far, no = hashlib.sha1(), 0, 0
        while True:
            piece = stream.read(min(chunk_bytes, left - so_far))
            if not piece and so_far < left:
                raise ValueError(f"record {f['warc-record-id']} ends after {so_far} of {left} bytes")
            sha.update(piece)
            so_far += len(piece)
            last = so_far == left
            digest = base64.b32encode(sha.digest()).decode()
            if last and kind == "response" and digest != declared:
                raise ValueError(f"record {f['warc-record-id']}: digest {digest}, declared {declared}")
            yield (f["warc-record-id"], _number(f.get("x-page-id")), f.get("warc-target-uri"), kind,
                   _number(f.get("x-refers-to-page-id")), no, len(piece), so_far, digest, last,
                   int(f["x-payload-length"]), declared, piece)
            no += 1
            if last:
                break
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {f['warc-record-id']} has no end mark")


def read_chunks(manifest: DataFrame, *, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = True) -> DataFrame:
    """The archives' chunk rows (``CHUNKS``); ``payload`` is null unless asked for."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [{"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]
             for c in CHUNKS.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (n for b in batches for n in b.column("archive").to_pylist()):
            rows, size = [], 0
            with open_input(name) as raw:
                record = -1
                for row in _records(_Lines(gzip.GzipFile(fileobj=raw)), chunk_bytes):
                    record += row[5] == 0
                    rows.append((name, record, *(row if with_payload else (*row[:-1], None))))
                    size += row[6] if with_payload else 0
                    if len(rows) >= 4096 or size >= 8 * CHUNK_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    return manifest.select("archive").mapInArrow(read, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a table of chunk rows: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's size is the sum of its chunks' bytes, its digest the last chunk's; a revisit's are those of the
    full payload, from its header."""
    per = chunks.groupBy("archive", "record_no").agg(
        F.sum(F.octet_length("payload")).cast("bigint").alias("n"),
        F.max_by(F.struct("page_id", "record_type", "refers_to", "digest_so_far", "payload_bytes", "payload_digest"),
                 "chunk_no").alias("r"))
    response = F.col("r.record_type") == "response"
    return per.select("r.page_id", F.when(response, F.col("n")).otherwise(F.col("r.payload_bytes")).alias("payload_bytes"),
                      F.when(response, F.col("r.digest_so_far")).otherwise(F.col("r.payload_digest"))
                      .alias("payload_digest"), "r.record_type", "r.refers_to")


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` as archives in a new shared folder, read them back as chunk rows, and make ``records`` of them."""
    folder = new_folder(pages.sparkSession, "warc")
    return records(read_chunks(write_archives(record_plan(pages, **columns), folder)))
