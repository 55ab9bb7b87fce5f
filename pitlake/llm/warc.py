"""WARC archives: writing records, and a reader that salvages damaged files.

Records go to gzip members of their own in archives in the shared folder; each writing task names the
archives it finished, and only named archives are read, so what a lost task left behind doesn't count.
Of records with equal payloads of at least MIN_REVISIT bytes the one with the smallest identifier is a
response, the others are revisits that carry its identifier, the digest and the HTTP header.

The reader walks members and records in order and checks each: the gzip checksum, the version line,
headers, block length and block digest. After a failed check it searches for the next valid gzip member
or version line, goes on there, and reports the bytes in between as a quarantined gap. It holds one
record or member at a time: an archive of many members may have any size, one that is a single gzip member
is held whole.

Null payloads are empty, null addresses are left out, null identifiers are the text "null" and come last.
Rows that repeat the identifier of a response are responses too. An empty table makes no archive. Very long
payloads are records like others. Only the three named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.plans.scratch import scratch, staged

#: Fixed values of the formats.
GZIP_MAGIC, VERSION, ID_PREFIX = b"\x1f\x8b\x08", b"WARC/1.", "urn:x-record:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 100
#: Bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
MAX_HEAD = 1 << 20
STEP = 1 << 16


class Damaged(Exception):
    """A check failed; the text says which."""


def record(headers: dict[str, str], block: bytes) -> bytes:
    headers = {
        **headers, "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def page_record(key: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID_PREFIX}{key}>", "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(33, 127))))
    if refers_to is not None:
        headers |= {"WARC-Refers-To": f"<{ID_PREFIX}{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
        return record(headers, http.encode())
    return record(headers, http.encode() + payload)


class Window:
    """Bytes of a stream by absolute position; what is dropped is gone."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.start, self.data, self.ended = read, 0, bytearray(), False

    def get(self, a: int, b: int) -> bytes:
        while not self.ended and self.start + len(self.data) < b:
            more = self.read(max(STEP, b - self.start - len(self.data)))
            self.ended = not more
            self.data += more
        return bytes(self.data[a - self.start : b - self.start])

    def drop(self, until: int) -> None:
        if until - self.start >= STEP:
            del self.data[: until - self.start]
            self.start = until


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    """Bytes of the archive that no record could be read from, and the check that failed."""

    start: int
    end: int
    reason: str


def inflate(window: Window, at: int) -> tuple[bytes, int]:
    """The member at `at` and where it ends."""
    stream, out, place = zlib.decompressobj(31), [], at
    try:
        while not stream.eof:
            piece = window.get(place, place + STEP)
            if not piece:
                raise Damaged("gzip member is cut off")
            out.append(stream.decompress(piece))
            place += len(piece)
    except zlib.error as broken:
        raise Damaged(f"gzip: {broken}") from broken
    return b"".join(out), place - len(stream.unused_data)


def plain_record(window: Window, at: int) -> Record:
    """The record whose version line is at `at`."""
    size = 4096
    while (stop := (head := window.get(at, at + size)).find(b"\r\n\r\n")) < 0:
        if len(head) < size or size > MAX_HEAD:
            raise Damaged("headers have no end")
        size *= 4
    lines = head[:stop].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", lines[0]):
        raise Damaged("version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdigit():
        raise Damaged("content length")
    start = at + stop + 4
    end = start + int(headers["content-length"])
    block = window.get(start, end)
    if len(block) < end - start:
        raise Damaged("block is cut off")
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest.lower():
        raise Damaged("block digest")
    if window.get(end, end + 4) != b"\r\n\r\n":
        raise Damaged("record has no end")
    return Record(at, end + 4, headers, block)


def next_start(window: Window, at: int) -> int:
    """The next position from `at` on where a member or a record may start, or where the stream ends."""
    overlap = len(VERSION) - 1
    while True:
        piece = window.get(at, at + STEP)
        found = [k for k in (piece.find(GZIP_MAGIC), piece.find(VERSION)) if k >= 0]
        if found:
            return at + min(found)
        if len(piece) < STEP:
            return at + len(piece)
        at += len(piece) - overlap


def salvage(window: Window) -> Iterator[Record | Gap]:
    """Records in order, and a gap wherever something had to be skipped."""
    at, bad_from, reason = 0, None, ""
    while lead := window.get(at, at + len(VERSION)):
        try:
            if lead.startswith(GZIP_MAGIC):
                data, end = inflate(window, at)
                found: list[Record | Gap] = [
                    Record(at, end, x.headers, x.block) if isinstance(x, Record)
                    else Gap(at, end, f"in member, {x.start} to {x.end}: {x.reason}")
                    for x in salvage(Window(io.BytesIO(data).read))
                ]
            elif lead == VERSION:
                found = [plain_record(window, at)]
                end = found[0].end
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as failed:
            if bad_from is None:
                bad_from, reason = at, str(failed)
                keep = at
            at = next_start(window, at + 1)
            window.drop(min(at, keep) if lead.startswith(GZIP_MAGIC) else at)
            continue
        if bad_from is not None:
            yield Gap(bad_from, at, reason)
            bad_from = None
        yield from found
        at = end
        window.drop(at)
    if bad_from is not None:
        yield Gap(bad_from, at, reason)


def payload_of(found: Record) -> tuple[bytes | None, int | None]:
    """Payload and its length; a revisit has the length only."""
    head, apart, body = found.block.partition(b"\r\n\r\n")
    if not found.headers.get("content-type", "").startswith("application/http") or not apart:
        return found.block, len(found.block)
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
    if found.headers.get("warc-type") == "revisit":
        return None, int(stated[1]) if stated else None
    return body, len(body)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


MANIFEST = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType())])
FOUND = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("gap", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()),
])
FOUND_ARROW = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gap", pa.string()),
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload", pa.binary()),
])


def with_revisits(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(key, url, payload, digest, first, refers): what each record is to say."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    order = F.struct(F.col("key").isNull(), F.col("key").alias("key"))
    shared = (
        rows.filter(F.length("payload") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min(order)["key"].alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
        .withColumnRenamed("digest", "shared")
    )
    joined = rows.join(shared, rows["digest"] == shared["shared"], "left")
    refers = F.col("shared").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return joined.select("key", "url", "payload", "digest", "first", refers.alias("refers"))


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per row into archives under `folder`; (path, records) of the finished ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        out, path, count, size = None, "", 0, 0

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

        for batch in batches:
            for row in range(batch.num_rows):
                k, u, body, digest, first, refers = (c[row].as_py() for c in batch.columns)
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, count, size = f"{folder}/{name}", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(member(record({
                        "WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
                        "Content-Type": "application/warc-fields",
                    }, b"format: WARC file version 1.1\r\n")))
                target = ("null" if first is None else str(first)) if refers else None
                data = member(page_record("null" if k is None else str(k), u, body, digest, target, date))
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return staged(with_revisits(pages, key, url, payload).mapInArrow(run, MANIFEST), "warc-manifest")


def read(archives: DataFrame) -> DataFrame:
    """Records of the archives named in `path`, and a row with `gap` (the failed check) per quarantined range.

    There are as many tasks as archives, since rows of paths are small and would otherwise be put together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = open_folder(path)
                with store.open_input_stream(place, compression=None) as source:
                    yield from rows(path, salvage(Window(source.read)))

    def rows(path: str, found: Iterator[Record | Gap]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in found:
            row = {"path": path, "start": one.start, "end": one.end}
            if isinstance(one, Gap):
                row["gap"] = one.reason
            else:
                payload, length = payload_of(one)
                h = one.headers
                row |= {
                    "record_id": h.get("warc-record-id", "").strip("<>"), "record_type": h.get("warc-type"),
                    "target_uri": h.get("warc-target-uri"), "payload_digest": h.get("warc-payload-digest"),
                    "refers_to": h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                    "payload_bytes": length, "payload": payload,
                }
                size += len(payload or b"")
            held.append(row)
            if size > 4 << 20 or len(held) >= 5000:
                yield pa.RecordBatch.from_pylist(held, FOUND_ARROW)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, FOUND_ARROW)

    tasks = max(1, archives.count())
    return archives.select("path").repartitionByRange(tasks, "path").mapInArrow(run, FOUND)


def report(pages: DataFrame) -> DataFrame:
    """Write all pages, read them back: per page what its record says, digests of responses from the payload."""
    folder = scratch(pages.sparkSession, "warc")
    found = read(write(pages, folder)).filter("gap IS NULL AND record_type IN ('response', 'revisit')")

    def number(name: str):
        return F.expr(f"try_cast(substring({name}, {len(ID_PREFIX) + 1}) AS bigint)")

    stated = F.substring_index("payload_digest", ":", -1)
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes",
        F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(stated).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


ORACLE = f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, sha256(t) AS payload_digest,
        CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to
    FROM f"""
