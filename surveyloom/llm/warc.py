"""WARC archives: one gzip member for each record, written by the tasks into the shared folder and read back in sequence."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored
from surveyloom.session import fresh_folder

#: Payloads below this size are always stored whole.
REVISIT_BYTES = 1000
#: A task begins another file when one has grown to this size.
FILE_BYTES = 1 << 30
#: Pages have no capture time.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 4

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, digest_ok boolean"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", _digest(block)), ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """The record of a page: a response with its payload, or a revisit (payload None) with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if payload is None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    return member(headers, http + (payload or b""))


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes
    #: The block has the digest that its header names (or names none).
    block_ok: bool


def _parse(raw: bytes) -> Record:
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not gap or not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in fields.decode().split("\r\n"):
        key, colon, value = line.partition(":")
        if colon:
            headers[key.strip().lower()] = value.strip()
    size = int(headers.get("content-length", "-1"))
    if size < 0 or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("record and Content-Length disagree")
    block = rest[:size]
    return Record(headers, block, headers.get("warc-block-digest") in (None, _digest(block)))


def read_records(stream: BinaryIO, chunk: int = 1 << 16) -> Iterator[Record]:
    """Records in sequence; memory holds one record and one chunk. A truncated or misframed archive raises ValueError."""
    data = b""
    while data := data or stream.read(chunk):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    raise ValueError("truncated archive")
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
        yield _parse(b"".join(parts))


class DamagedRecord(ValueError):
    """A block or payload does not have the length or digest that its record names."""


def _pages(records: Iterator[Record]) -> Iterator[tuple]:
    """Size and digest of a response are computed from the payload that was read; a revisit has those its record names."""
    for headers, block, ok in records:
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?im)^content-length:\s*([0-9]+)", head)[1])
        named = headers["warc-payload-digest"]
        if kind == "response":
            ok = ok and len(payload) == size and _digest(payload) == named
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        else:
            digest = base64.b32decode(named.removeprefix("sha1:")).hex()
        yield (_page_id(headers.get("warc-record-id")), headers.get("warc-target-uri"), kind, _page_id(headers.get("warc-refers-to")), size, digest, ok)


def deduplicated(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null for revisits), payload_bytes, payload_digest, refers_to.

    Only digests that occur more than once are joined, so the copies of one page never meet in one task.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    last = (
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("d"))
        .agg(F.count("*").alias("n"), F.max("page_id").alias("last"))
        .filter("n > 1")
    )
    first = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return rows.join(last, F.col("payload_digest") == F.col("d"), "left").select(
        "page_id", "url", F.when(first.isNull(), F.col("html")).alias("html"), "payload_bytes", "payload_digest", first.alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) as archives below `folder`; path and records of each file that counts.

    Every attempt of a task writes files of its own. The result is stored, so only the files of the attempts that Spark
    accepted are listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = pafs.FileSystem.from_uri(folder)
        files.create_dir(top, recursive=True)
        out, done = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or out.tell() >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{top}/{name}", compression=None)
                    out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    done.append([f"{folder}/{name}", 0])
                page_id, url, html, size, digest, refers_to = row
                out.write(page_record(page_id, url, None if html is None else html.encode(), size, digest, refers_to))
                done[-1][1] += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return stored(deduplicated(pages).mapInArrow(run, "path string, records long"), "warc-files")


def read_archives(files: DataFrame, strict: bool = False) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, digest_ok of all page records of the files (path).

    Size and digest are those of what was read. `strict` fails on the first record that is not what its headers say; otherwise
    digest_ok tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, name = pafs.FileSystem.from_uri(path)
                with source.open_input_stream(name, compression=None) as stream:
                    rows: list[tuple] = []
                    for row in _pages(read_records(stream)):
                        if strict and not row[-1]:
                            raise DamagedRecord(f"{path}: page {row[0]}")
                        rows.append(row)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, _RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The page records of `pages` after writing and reading them.

    A null html is an empty payload, a null page_id or url stays null. Of equal payloads of at least REVISIT_BYTES bytes the one
    with the largest page_id (null: smallest) is the response, or each of them if rows repeat that page_id. An empty table
    gives no rows; extra columns are ignored.
    """
    return read_archives(write_archives(pages.select("page_id", "url", "html"), fresh_folder(spark, "warc")), strict=True)


#: DuckDB SQL of op1 on the table pages.
WARC_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last, payload_bytes >= {REVISIT_BYTES} AS large FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN large AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN large AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM w
"""
