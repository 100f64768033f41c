"""WARC archives: written from pages, read back, and assembled into captures.

A page becomes a request, a response (or revisit) and a metadata record. The response
and the metadata name the request in WARC-Concurrent-To. Records are gzip members of
files of bounded size below one shared folder; a file has a name of its own for each
attempt, and only files that a finished task reports are read. Reading streams each
file. Assembly groups records by the identifier that they are concurrent to, in one
shuffle, and gives one nested row per capture.

Pages with equal payloads of at least ``MIN_REVISIT`` bytes are found by their digests,
which are counted per digest before the shuffle; the one with the largest id keeps its
payload. Only ids of revisiting pages are joined back to the pages.

Defined results: a null or empty payload is written with no bytes; pages without an id
are written without one and can only revisit; rows that repeat are written one by one,
all as responses if they have the largest id; a null url has no target; a record whose
partner is missing gives a capture with null parts; further records of one type in a
capture are passed over in favour of the smallest identifier; no pages give no file and
no capture; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, saved, shared_folder

MIN_REVISIT = 1000
#: Compressed bytes after which a new file begins.
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTS = ("request", "response", "revisit", "metadata")
READ_BYTES = 1 << 20


def record_id(*parts) -> str:
    """A urn made from what identifies the record."""
    digest = hashlib.md5("\x1f".join(map(str, parts)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest, version=4)}>"


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member; headers without a value are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in headers if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n")
    return data + packer.flush()


def transaction(page, url, payload: bytes, digest: str, original, place) -> bytes:
    """The records of one page; ``original``: the page whose payload it repeats."""
    url = None if url is None else "".join(url.split())
    request = record_id(page, digest, *place, "request")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url)]
    path = "/" + "/".join((url or "").split("/")[3:])
    http = f"GET {path} HTTP/1.1\r\n\r\n".encode()
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    answer = [
        *common,
        ("WARC-Concurrent-To", request),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if original is None:
        own = [("WARC-Record-ID", record_id(page, digest, "response"))]
        response = record("response", own + answer, status + payload)
    else:
        own = [
            ("WARC-Record-ID", record_id(page, digest, *place, "revisit")),
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(original, digest, "response")),
        ]
        response = record("revisit", own + answer, status)
    fields = b"" if page is None else f"page-id: {page}\r\n".encode()
    return b"".join(
        [
            record("request", [("WARC-Record-ID", request), *common], http),
            response,
            record(
                "metadata",
                [
                    ("WARC-Record-ID", record_id(page, digest, *place, "metadata")),
                    *common,
                    ("WARC-Concurrent-To", request),
                    ("Content-Type", "application/warc-fields"),
                ],
                fields,
            ),
        ]
    )


def file_system(folder: str):
    """(file system, path) of a folder named by a path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """(path, records) of the files written below ``folder``."""
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(id_col).alias("rank"),
        F.col(url).alias("url"),
        bytes_of(payload).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    same = (
        rows.filter(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("rank").cast("string").alias("original"))
        .filter("n > 1 AND original IS NOT NULL")
    )
    narrow = rows.filter(F.octet_length("payload") >= MIN_REVISIT).select("id", "digest")
    revisits = saved(
        narrow.join(same, "digest")
        .filter(~F.col("id").eqNullSafe(F.col("original")))
        .select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "original")
        .distinct(),
        "revisits",
    )
    joined = rows.join(
        revisits,
        (F.col("digest") == F.col("r_digest")) & F.col("id").eqNullSafe(F.col("r_id")),
        "left",
    ).select("id", "url", "payload", "digest", "original")

    def write(batches):
        part = TaskContext.get().partitionId()
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, size, n, seq = None, "", 0, 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for k, payload_ in enumerate(batch.column(2)):
                values = (batch.column(c)[k].as_py() for c in (0, 1, 3, 4))
                page, link, digest, original = values
                if out is None:
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                data = transaction(page, link, payload_.as_py(), digest, original, (part, seq))
                out.write(data)
                size, n, seq = size + len(data), n + 3, seq + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n))
                    out, size, n = None, 0, 0
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n))
        if done:
            yield pa.RecordBatch.from_pylist([{"path": p, "records": n} for p, n in done])

    return joined.mapInArrow(write, "path string, records long")


def members(stream) -> Iterator[bytes]:
    """The content of each gzip member of a stream."""
    opener, parts = zlib.decompressobj(31), []
    data = stream.read(READ_BYTES)
    while data:
        parts.append(opener.decompress(data))
        data = opener.unused_data
        if opener.eof:
            yield b"".join(parts)
            opener, parts = zlib.decompressobj(31), []
        data = data or stream.read(READ_BYTES)
    if any(parts):
        raise ValueError("the archive ends inside a record")


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record; the first of repeated headers."""
    lines = io.BytesIO(content)
    while line := lines.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := lines.readline().rstrip(b"\r\n")) and b":" in line:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), value.strip())
        yield headers, lines.read(int(headers.get("content-length", 0)))


RECORD = (
    "record_id string, type string, concurrent_to string, target_uri string, date string, "
    "refers_to string, digest string, payload_bytes long, payload_sha1 string, page_id string, "
    "payload binary"
)


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the files in (path); a payload is a block without its HTTP head.

    Without payloads their lengths and digests are still those of the bytes read.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]

    def row(headers: dict[str, str], block: bytes) -> dict:
        kind, page = headers.get("warc-type"), None
        payload = block
        if kind in ("request", "response", "revisit"):
            payload = block.partition(b"\r\n\r\n")[2]
        if kind == "metadata":
            fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
            page = fields.get("page-id")
        digest = headers.get("warc-payload-digest")
        return {
            "record_id": headers.get("warc-record-id"),
            "type": kind,
            "concurrent_to": headers.get("warc-concurrent-to"),
            "target_uri": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"),
            "refers_to": headers.get("warc-refers-to"),
            "digest": digest and digest.partition(":")[2],
            "payload_bytes": len(payload),
            "payload_sha1": hashlib.sha1(payload).hexdigest(),
            "page_id": page,
            "payload": payload if with_payload else None,
        }

    schema = pa.schema(
        [(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names[:-1]]
        + [("payload", pa.binary())]
    )

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = file_system(path)
                held, size = [], 0
                with system.open_input_stream(place, compression=None) as stream:
                    for content in members(stream):
                        for headers, block in records(content):
                            held.append(row(headers, block))
                            size += len(block) * with_payload + 500
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    # A task per file: a file's bytes are bounded.
    n_files = max(1, files.count())
    return files.select("path").repartition(n_files).mapInArrow(read, RECORD)


def captures(found: DataFrame) -> DataFrame:
    """(capture, request, response, revisit, metadata): the records that belong together."""
    part = F.struct(*(c.split()[0] for c in RECORD.split(", ")))
    key = F.coalesce("concurrent_to", "record_id")
    return (
        found.filter(F.col("type").isin(*PARTS))
        .groupBy(key.alias("capture"))
        .agg(
            *(
                F.min_by(part, F.when(F.col("type") == kind, F.col("record_id"))).alias(kind)
                for kind in PARTS
            )
        )
    )


def round_trip(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read from the archives.

    A revisit's payload is that of the response it refers to.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    files = saved(write_archives(pages, folder, id_col), "files")
    found = saved(
        captures(read_archives(files, with_payload=False)).select(
            F.col("metadata.page_id").cast(pages.schema[id_col].dataType).alias("page_id"),
            "response",
            F.col("revisit.refers_to").alias("wanted"),
        ),
        "captures",
    )
    originals = (
        found.filter("response IS NOT NULL")
        .groupBy(F.col("response.record_id").alias("record_id"))
        .agg(
            F.max("page_id").alias("original"),
            F.max("response.payload_bytes").alias("bytes"),
            F.max("response.payload_sha1").alias("sha1"),
        )
    )
    responses = found.filter("response IS NOT NULL").select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_sha1").alias("payload_digest"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast(pages.schema[id_col].dataType).alias("refers_to"),
    )
    revisits = (
        found.filter("wanted IS NOT NULL")
        .join(originals, F.col("wanted") == F.col("record_id"), "left")
        .select(
            "page_id",
            F.col("bytes").alias("payload_bytes"),
            F.col("sha1").alias("payload_digest"),
            F.lit("revisit").alias("record_type"),
            F.col("original").alias("refers_to"),
        )
    )
    return responses.unionByName(revisits)
