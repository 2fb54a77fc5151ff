"""WARC archives with duplicate payloads resolved to revisit records.

Headers first: every page's payload digest and length are shuffled by digest, and the smallest page id
among equal payloads becomes the original. The others are joined to it. Only then are payloads
written: originals as `response` records, the others as `revisit` records with fresh headers that
refer to the original and hold no payload. Every record is a gzip member of its own, so archives can be
read from any record on.

Archives are written by tasks under temporary names and renamed when complete; a repeated task writes
the same bytes. A group of equal payloads only meets as narrow header rows, added up before the shuffle.

Defined results: a null html is an empty payload. Payloads smaller than `min_bytes` are always
responses. Rows with the smallest page id of a payload are all responses; a null page id is the smallest
only if there is no other, and then its rows are responses. Line breaks and other control characters of a
URL are percent-encoded; a page without URL gets the target `urn:page:<id>`. No pages give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlink.llm.common import SharedFile, arrow_batches, file_system, joined, kept, shared_folder

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_PIECE = 1 << 20


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def target(page_id: int | None, url: str | None) -> str:
    return "".join(c if " " < c < "\x7f" or c > "\xa0" else quote(c) for c in url) if url else f"urn:page:{page_id}"


def _payload_key() -> Column:
    return F.sha1(F.coalesce("payload", F.lit("")).cast("binary"))


def headers(docs: DataFrame) -> DataFrame:
    """(page_id, digest, bytes) of the pages `page_id`, `payload`."""
    size = F.octet_length(F.coalesce("payload", F.lit(""))).cast("long")
    return docs.select("page_id", _payload_key().alias("digest"), size.alias("bytes"))


def originals(found: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to): the revisits among the headers."""
    first = found.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = first.where(F.col("n") > 1).drop("n")
    df = found.select("page_id", "digest").distinct().join(first, "digest")
    return df.where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit when it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, payload_digest),
        "WARC-Target-URI": target(page_id, url),
        "WARC-Date": DATE,
        "WARC-Page-ID": "" if page_id is None else str(page_id),
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Block-Digest": f"sha1:{digest_of(block)}",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, payload_digest), "WARC-Refers-To-Page-ID": str(refers_to)}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def members(stream: BinaryIO) -> Iterator[bytes]:
    """The decompressed gzip members of an archive, one at a time."""
    data, out, unpack = b"", [], zlib.decompressobj(31)
    while piece := data or stream.read(_PIECE):
        out.append(unpack.decompress(piece))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(out)
            out, unpack = [], zlib.decompressobj(31)
    if any(out):
        raise ValueError("archive ends within a record")


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = block[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def write_archives(
    pages: DataFrame, id_: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, folder: str | None = None, level: int = 6
) -> DataFrame:
    """Writes deduplicated archives; returns their list (archive, folder, name, records)."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    source = pages.select(F.col(id_).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("payload"))
    revisits = kept(originals(kept(headers(source), "warc_headers"), min_bytes), "warc_revisits")
    # A page id may repeat with other payloads, so the digest decides too; it also spreads the rows without an id.
    rows = joined(source.withColumn("digest", _payload_key()), revisits, ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n = TaskContext.get().partitionId(), 0
        name = f"part-{number:06d}.warc.gz"
        with SharedFile(folder, name) as stream:
            for whole in batches:
                for batch in arrow_batches(whole, 64):
                    for page, link, text, found in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]):
                        body = (text or "").encode()
                        digest = digest_of(body)
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        raw = record(page, link, body, digest, found)
                        stream.write(pack.compress(raw) + pack.flush())
                        n += 1
        yield pa.RecordBatch.from_pylist([{"archive": number, "folder": folder, "name": name, "records": n}])

    ordered = rows.select("page_id", "url", "payload", "refers_to")
    return kept(ordered.mapInArrow(run, "archive long, folder string, name string, records long"), "warc_archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Reads every archive in a task of its own: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, name in zip(batch.column("folder").to_pylist(), batch.column("name").to_pylist()):
                fs, base = file_system(folder)
                out = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        fields, http, payload = parse(raw)
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest_of(payload) != digest:
                            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                        number = lambda x: int(x) if x else None
                        refers = number(fields.get("WARC-Refers-To-Page-ID"))
                        out.append((number(fields["WARC-Page-ID"]), int(http["Content-Length"]), digest, kind, refers))
                columns = list(zip(*out)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    tasks = max(1, archives.count())
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.repartitionByRange(tasks, "archive").mapInArrow(run, schema)
