"""WARC archives: a writer that turns equal payloads into revisits, and a salvage reader.

Tasks write gzip archives, one member per record, into the shared folder. A file's name carries
the attempt that wrote it, and a table names the files of the attempts that succeeded, so what a
lost executor left behind is never read.

The reader walks an archive member by member, or record by record if it isn't compressed. A
record counts if its member inflates, its version line and headers parse, its block has the
stated length and the block's and payload's digests agree. After a failed check it searches for
the next member or version line whose record does count, goes on from there, and logs the bytes
between as a gap with its reason.

Tasks open archives through Arrow's filesystems, since Spark has no writer for them: the shared
folder must be one that both can open, and `store_of` says so before any task starts.

Defined cases: a null html is an empty payload; a null url makes a record without a target; a
null page_id sorts above all others and reads back as null; rows with equal payloads and the
smallest page_id are all responses; repeated rows make a record each; other columns are not read;
an empty table gives no files and no rows. A task holds one record whole, however long it or its
headers are.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, table, written

VERSION = b"WARC/1.1"
LEAST_REVISIT = 100
#: An archive is closed once it has so many bytes.
ROLL_BYTES = 32 << 20
WINDOW = 1 << 16
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSIONS = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
#: Names that Spark and Arrow give the same stores.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest[:16]}>"


def _page_of(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+):\w*>", urn or "")
    return int(m[1]) if m else None


def make_record(page_id, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response, or a revisit of page `refers_to`, before compression."""
    digest = hashlib.sha256(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Broken(ValueError):
    """A record that fails a check."""


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and total length of the record at the start of `data`."""
    m = _VERSIONS.match(data)
    if not m:
        raise Broken("no version line")
    stop = data.find(b"\r\n\r\n")
    if stop < 0:
        raise Broken("headers don't end")
    headers = {}
    for line in data[m.end() : stop].split(b"\r\n"):
        k, colon, v = line.partition(b":")
        if not colon:
            raise Broken("a header without a colon")
        headers[k.strip().decode("utf-8", "replace").lower()] = v.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise Broken("no length")
    end = stop + 4 + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Broken("the block has another length than stated")
    block = data[stop + 4 : end]
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise Broken("the block has another digest than stated")
    _http, _, payload = block.partition(b"\r\n\r\n")
    stated = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and stated.startswith("sha256:") and stated[7:] != hashlib.sha256(payload).hexdigest():
        raise Broken("the payload has another digest than stated")
    return headers, block, end + 4


class Archive:
    """Windowed access to an archive: at most one member and one window are in memory."""

    def __init__(self, file, size: int, packed: bool = True):
        self.file, self.size, self.packed = file, size, packed

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at)) if at < self.size else b""

    def _member(self, at: int) -> tuple[bytes, int]:
        """What the member inflates to, and where it ends."""
        if self.read(at, 3) != _GZIP:
            raise Broken("no gzip member")
        z, out, p = zlib.decompressobj(31), [], at
        try:
            while not z.eof and p < self.size:
                part = self.read(p, WINDOW)
                out.append(z.decompress(part))
                p += len(part)
            if not z.eof:
                raise Broken("the member is cut off")
        except zlib.error as error:
            raise Broken(f"the member doesn't inflate: {str(error)[:60]}") from None
        return b"".join(out), p - len(z.unused_data)

    def _plain(self, at: int) -> tuple[dict, bytes, int]:
        head, stop = b"", -1
        while stop < 0:
            part = self.read(at + len(head), WINDOW)
            head += part
            if not part or not _VERSIONS.match(head):
                raise Broken("no record")
            stop = head.find(b"\r\n\r\n", max(0, len(head) - len(part) - 3))
        m = re.search(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", head[: stop + 2], re.I)
        if not m:
            raise Broken("no length")
        headers, block, used = parse_record(self.read(at, stop + 4 + int(m[1]) + 4))
        return headers, block, at + used

    def _at(self, at: int) -> tuple[list[tuple[dict | None, bytes, str]], int]:
        """Headers, block, "" of the record at a place, and where it ends. A member may hold several
        records, and gaps between them: None, b"", the reason."""
        if not self.packed or self.read(at, 1) != _GZIP[:1]:
            headers, block, end = self._plain(at)
            return [(headers, block, "")], end
        data, end = self._member(at)
        inside = Archive(io.BytesIO(data), len(data), packed=False).records()
        found = [(h, block, h is None and f"{why}: {n} bytes from {o} on in the inflated member" or "") for o, n, h, block, why in inside]
        if all(h is None for h, _, _ in found):
            raise Broken(found[0][2] if found else "the member is empty")
        return found, end

    def _candidates(self, at: int) -> Iterator[int]:
        """Places from `at` on where a member's first bytes or a version line stand."""
        keep = 10
        while at < self.size:
            part = self.read(at, WINDOW + keep)
            for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n", part):
                if m.start() < WINDOW and (self.packed or m[0] != _GZIP):
                    yield at + m.start()
            at += WINDOW

    def records(self) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
        """(offset, length, headers, block, "") of records, (offset, length, None, b"", reason)
        of gaps, in the archive's order; those in one member have its place."""
        at = 0
        while at < self.size:
            try:
                found, end = self._at(at)
            except Broken as error:
                reason = str(error)
                for there in self._candidates(at + 1):
                    try:
                        self._at(there)
                        break
                    except Broken:
                        continue
                else:
                    there = self.size
                yield at, there - at, None, b"", reason
                at = there
                continue
            for headers, block, why in found:
                yield at, end - at, headers, block, why
            at = end


def _marks(pages: DataFrame, least: int) -> DataFrame:
    """m_id, m_digest, refers_to: of each page and payload, the page it revisits, if any. Only
    digests are shuffled, and counted before the shuffle. The repeated ones are written, so that the
    join has a plain exchange on either side: Spark can then split the pages of a frequent one."""
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    seen = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size")).distinct()
    several = seen.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    several = written(several, "digests")
    marked = seen.join(several, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return marked.select(F.col("page_id").alias("m_id"), F.col("digest").alias("m_digest"), refers.alias("refers_to"))


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's filesystem for a folder that Spark names, and the folder's path in it."""
    scheme, mark, rest = folder.partition("://")
    try:
        return fs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + mark + rest)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError) as error:
        raise ValueError(f"archives need a folder that Arrow's filesystems can open, not {folder}: {error}") from None


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes a record per row of `pages` and returns path, bytes, records of each archive."""
    store_of(folder)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    texts = pages.select("page_id", F.col("url").cast("string").alias("url"), html)
    marks = _marks(pages, least).where("refers_to is not null")
    same = F.col("page_id").eqNullSafe(F.col("m_id")) & (F.sha2(F.encode("html", "UTF-8"), 256) == F.col("m_digest"))
    rows = texts.join(marks, same, "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, store, n = TaskContext.get(), None, 0
        out, path, held, count = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([held], pa.int64()), pa.array([count], pa.int64())], ["path", "bytes", "records"])

        for batch in batches:
            for row in range(batch.num_rows):
                page, url, html, refers = (batch.column(k)[row].as_py() for k in range(4))
                if out is None:
                    store, base = store_of(folder)
                    store.create_dir(base, recursive=True)
                    path, held, count, n = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{n}.warc.gz", 0, 0, n + 1
                    out = store.open_output_stream(f"{base}/{path}", compression=None)
                member = gzip_member(make_record(page, url, html.encode(), refers))
                out.write(member)
                held, count = held + len(member), count + 1
                if held >= roll:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(rows.mapInArrow(run, "path string, bytes long, records long"), "archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """path, offset, length, page_id, record_type, refers_to, url, payload, payload_bytes,
    payload_digest, gap (the reason, or null for a record) of every record and gap. A revisit's
    payload is null; its size and digest are those its headers state."""
    schema = "path string, offset long, length long, page_id long, record_type string, refers_to long, url string, payload binary, payload_bytes long, payload_digest string, gap string"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def row(path: str, at: int, n: int, headers: dict | None, block: bytes, reason: str) -> tuple:
        if headers is None:
            return (path, at, n, None, None, None, None, None, None, None, reason)
        http, _, payload = block.partition(b"\r\n\r\n")
        page, url = _page_of(headers.get("warc-record-id")), headers.get("warc-target-uri")
        if (kind := headers.get("warc-type")) != "revisit":
            return (path, at, n, page, kind, None, url, payload, len(payload), hashlib.sha256(payload).hexdigest(), None)
        size = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", http, re.I)
        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
        return (path, at, n, page, kind, _page_of(headers.get("warc-refers-to")), url, None, int(size[1]) if size else None, digest, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, base = store_of(folder)
                with store.open_input_file(f"{base}/{path}") as file:
                    rows, held = [], 0
                    for found in Archive(file, file.size()).records():
                        rows.append(row(path, *found))
                        held += len(found[3])
                        if held >= 4 << 20 or len(rows) == 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return archives.select("path").mapInArrow(run, schema)


def read_logged(archives: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Records, without their payloads, and the log of quarantined gaps, both from one written
    table. Raises, naming the log, if fewer records come back than `archives` says were written."""
    stated = archives.agg(F.count("*"), F.coalesce(F.sum("records"), F.lit(0))).first()
    # One archive per task: paths are dealt anew, as the table of archives is a small file.
    found = read_archives(archives.repartition(max(1, stated[0]), "path"), folder).drop("payload")
    found = written(found, "warc-records")
    gaps = found.where("gap is not null").select("path", "offset", "length", "gap")
    records = found.where("gap is null").drop("gap")
    if (n := records.count()) < stated[1]:
        log = scratch(archives.sparkSession, "warc-gaps")
        gaps.write.parquet(log)
        raise RuntimeError(f"{stated[1]} records were written and {n} read; the gaps are logged in {log}")
    return records, gaps


def query(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    records, _gaps = read_logged(write_archives(table(spark, sf_dir, "pages"), folder), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN strlen(p.h) >= 100 AND p.page_id <> f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(p.h) >= 100 AND p.page_id <> f.first_id THEN f.first_id END AS refers_to
FROM p JOIN f ON p.h = f.h
"""
