"""Token-id files with bit-plane shuffling.

A file holds the ids of documents in ascending order of doc_id, each document closed by an end id. Ids
are cut into blocks of fixed size. A block is transposed into planes: bit k of all its ids, for every k
up to the highest bit in use, packed to bytes; low planes are random, high ones nearly constant. Every
plane is compressed with zstandard by itself.

Layout, little-endian: MAGIC; the planes of all blocks; the index; its offset (uint64); MAGIC. The index
is one zstandard frame: counts of documents and blocks (uint64 each), the documents' ids (int64), a byte
each that tells a null id, their lengths (uint64), the blocks' sizes in ids (uint32) and plane counts
(uint32), and the compressed length of every plane (uint32). A reader can thus seek any block.

Files are written by the tasks of a range partitioning, one per partition, under temporary names that
are renamed when complete. A repeated task writes the same bytes again, so lost executors do no harm.

Defined results: a null text has no ids but its end id. Repeated doc_ids are rows of their own, ordered
by a hash of the text; null doc_ids come first. Very long texts are encoded whole. An empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlink.llm import tokens
from idlink.llm.common import SharedFile, file_system, kept, portions, shared_folder

MAGIC = b"IDPLANE1"
BLOCK = 1 << 17
#: Bytes of text encoded at once; a longer text is encoded by itself or with those before it.
TOGETHER = 8 << 20


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Bit planes of uint32 ids, lowest first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    used = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : -(-top // 8)]
    bits = np.unpackbits(used, axis=1, bitorder="little")[:, :top]
    return [plane.tobytes() for plane in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    for k, plane in enumerate(planes):
        bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    def __init__(self, stream: BinaryIO, level: int = 3, block: int = BLOCK):
        self.stream, self.block = stream, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.docs: list[int] = []
        self.nulls: list[bool] = []
        self.lengths: list[int] = []
        self.blocks: list[int] = []
        self.counts: list[int] = []
        self.sizes: list[int] = []
        self.waiting: list[bytes] = []
        self.pending = 0
        self.at = len(MAGIC)
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(ids)
        self.pending += len(ids) // 4
        if self.pending >= 8 * self.block:
            self._flush(self.block)

    def _flush(self, least: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        at = 0
        while len(ids) - at >= least and at < len(ids):
            block = ids[at : at + self.block]
            planes = [self.zstd.compress(p) for p in to_planes(block)]
            self.blocks.append(len(block))
            self.counts.append(len(planes))
            for plane in planes:
                self.stream.write(plane)
                self.sizes.append(len(plane))
                self.at += len(plane)
            at += len(block)
        self.waiting = [ids[at:].tobytes()]
        self.pending = len(ids) - at

    def close(self) -> None:
        self._flush(1)
        parts = [
            struct.pack("<QQ", len(self.docs), len(self.blocks)),
            np.array(self.docs, "<i8"),
            np.array(self.nulls, np.uint8),
            np.array(self.lengths, "<u8"),
            np.array(self.blocks, "<u4"),
            np.array(self.counts, "<u4"),
            np.array(self.sizes, "<u4"),
        ]
        self.stream.write(self.zstd.compress(b"".join(bytes(p) for p in parts)))
        self.stream.write(struct.pack("<Q", self.at) + MAGIC)


class Reader:
    """Reads a file block by block; `stream` must be seekable."""

    def __init__(self, stream: BinaryIO):
        self.stream = stream
        end = stream.seek(0, 2)
        stream.seek(end - 16)
        (at,), magic = struct.unpack("<Q", stream.read(8)), stream.read(8)
        stream.seek(0)
        if magic != MAGIC or stream.read(8) != MAGIC:
            raise ValueError("not a token-id file")
        self.zstd = zstandard.ZstdDecompressor()
        stream.seek(at)
        raw = self.zstd.decompress(stream.read(end - 16 - at))
        docs, blocks = struct.unpack_from("<QQ", raw)
        place = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            out = np.frombuffer(raw, kind, n, place)
            place += out.nbytes
            return out

        self.docs, self.nulls, self.lengths = take("<i8", docs), take("u1", docs), take("<u8", docs).astype(np.int64)
        self.blocks, self.counts = take("<u4", blocks), take("<u4", blocks)
        self.sizes = take("<u4", int(self.counts.sum()))
        first = np.concatenate([[0], np.cumsum(self.counts)]).astype(int)
        self.planes = list(zip(first, first[1:]))
        self.offsets = len(MAGIC) + np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    def block(self, k: int) -> np.ndarray:
        """The ids of one block, through the index."""
        a, b = self.planes[k]
        self.stream.seek(int(self.offsets[a]))
        planes = [self.zstd.decompress(self.stream.read(int(s))) for s in self.sizes[a:b]]
        return from_planes(planes, int(self.blocks[k]))

    def __iter__(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, number of ids, crc32 of their bytes) of every document."""
        rest, at, k = np.empty(0, "<u4"), 0, 0
        for doc, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.lengths.tolist()):
            crc, left = 0, n
            while left:
                if at == len(rest):
                    rest, at, k = self.block(k), 0, k + 1
                piece = rest[at : at + left]
                crc = zlib.crc32(piece.tobytes(), crc)
                at, left = at + len(piece), left - len(piece)
            yield None if null else doc, n, crc


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """Ids and texts of many small batches at once: the more texts, the fewer times each word is looked up."""
    held, size = [], 0
    for batch in batches:
        for a, b in portions(batch.column("t")):
            held.append(batch.slice(a, b - a))
            size += (pc.sum(pc.binary_length(held[-1].column("t"))).as_py() or 0) + 64 * (b - a)
            if size >= TOGETHER:
                yield _combined(held)
                held, size = [], 0
    if held:
        yield _combined(held)


def _combined(held: list[pa.RecordBatch]) -> tuple[list[int | None], pa.Array]:
    texts = pa.concat_arrays([b.column("t").cast(pa.large_string()) for b in held])
    return [doc for b in held for doc in b.column("id").to_pylist()], texts


def write_ids(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", tokenizer: str = tokens.DEFAULT, end_id: int = 0, folder: str | None = None
) -> DataFrame:
    """Writes the files and returns their list: shard, folder, name, docs, ids, start (ids in the files before it)."""
    folder = folder or shared_folder(docs.sparkSession, "token_ids")
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(id_).cast("long").alias("id"), F.xxhash64(body).alias("h"), body.alias("t"))
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId(), None
        encode = tokens.id_encoder(tokenizer).encode
        file = SharedFile(folder, f"shard-{shard:06d}.ids")
        with file as stream:
            writer = Writer(stream)
            for docs, texts in _gathered(batches):
                for doc, ids in zip(docs, encode(texts)):
                    writer.add(doc, ids + end)
            writer.close()
        row = {"shard": shard, "folder": folder, "name": f"shard-{shard:06d}.ids", "docs": len(writer.docs), "ids": sum(writer.lengths)}
        yield pa.RecordBatch.from_pylist([row])

    # The hash parts rows whose ids are null or alike.
    ordered = source.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "t")
    written = kept(ordered.select("id", "t").mapInArrow(run, "shard long, folder string, name string, docs long, ids long"), "token_shards")
    rows = [r.asDict() for r in written.orderBy("shard").collect()]  # one row per file
    start = 0
    for row in rows:
        row["start"] = start
        start += row["ids"]
    return docs.sparkSession.createDataFrame(rows or [], "shard long, folder string, name string, docs long, ids long, start long")


def read_report(files: DataFrame, id_: str = "doc_id") -> DataFrame:
    """Reads the files back, each in a task of its own: id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()  # all files are written
        for batch in batches:
            for row in batch.to_pylist():
                fs, base = file_system(row["folder"])
                with fs.open_input_file(f"{base}/{row['name']}") as stream:
                    at, out = row["start"], []
                    for doc, n, crc in Reader(stream):
                        out.append((doc, at, n, crc))
                        at += n
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [id_, "start", "n_tokens", "ids_crc32"])

    tasks = max(1, files.count())
    return files.repartitionByRange(tasks, "shard").mapInArrow(run, f"`{id_}` long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, id_: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Writes the ids, reads them back and reports on every document."""
    return read_report(write_ids(docs, id_, text, **options), id_)
