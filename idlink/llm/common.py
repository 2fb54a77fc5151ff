"""Word tables of Arrow batches in numpy, row identities, stored stages and shared files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from idlink.session import scratch_path
from idlink.sources.sinks import stored

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: A word, for Spark's, Java's and Python's pattern functions alike.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes that belong to a word: all but blanks, or all but ASCII other than digits and letters.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[list(SPACES)] = False
ALPHANUMERIC = np.ones(256, bool)
ALPHANUMERIC[:128] = [chr(b).isalnum() for b in range(128)]

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 21


def ascii_lower(text: Column) -> Column:
    """Lower case of A to Z only."""
    return F.translate(text, UPPER, LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, known: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    if len(known[0]) < n:
        known[0] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n * 2, _BASE)]), dtype=np.uint64)
    return known[0]


def _spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], is_word[data], [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: a polynomial in its bytes, scrambled with its length."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # in pieces, so that a long text needs no long intermediate arrays
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK)))
        lengths = ends[at:to] - starts[at:to]
        firsts = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
        values = data[np.repeat(starts[at:to], lengths) + within].astype(np.uint64) + np.uint64(1)
        sums = np.add.reduceat(values * _powers(int(lengths.max()) + 1)[within], firsts)
        out[at:to] = mix(sums + lengths.astype(np.uint64) * _BASE)
        at = to
    return out


class Words:
    """The words of a batch of texts; those of text i are the slice `first[i]:first[i + 1]`."""

    def __init__(self, texts: pa.Array, is_word: np.ndarray, lower: bool = True):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])  # one line feed after each text parts them
        raw = "\n".join([*texts.to_pylist(), ""]).encode()
        data = np.frombuffer(raw, np.uint8)
        self.data = _LOWERED[data] if lower else data
        self.starts, self.ends = _spans(self.data, is_word)
        self.first = np.searchsorted(self.starts, self.begins)
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = _hashes(self.data, self.starts, self.ends)
        return self._hash

    def text(self, start: int, words: int) -> str:
        """Words from number `start` on, joined by one blank."""
        return b" ".join(
            self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(start, start + words)
        ).decode()


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n words in a row."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total = mix(total * _BASE + hashes[i : i + size])
    return total


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_ids(at: int, n: int) -> np.ndarray:
    """Identities of `n` rows of this task, from its row `at` on. Store them before using them twice."""
    task = TaskContext.get()
    return (np.int64(task.partitionId() if task else 0) << np.int64(33)) + np.arange(at, at + n, dtype=np.int64)


def arrow_batches(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def portions(texts: pa.Array, most: int = 4 << 20, rows: int = 256) -> Iterator[tuple[int, int]]:
    """Ranges of at most `rows` rows with at most `most` bytes of text; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > at and (total + size > most or k - at == rows):
            yield at, k
            at, total = k, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: computed once, safe when executors are lost."""
    return stored(df.sparkSession, name)(df)


def joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal names, null equal to null; the names appear once."""
    right = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    equal = [left[n].eqNullSafe(right[f"_right_{n}"]) for n in names]
    return left.join(right, equal, how).drop(*[f"_right_{n}" for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def out_schema(text: str) -> StructType:
    return StructType.fromDDL(text)


class SlotFilter:
    """Which keys may be among given ones: a bit per slot that one of them falls into.

    The bits take 2^20 slots, 128 KB, whatever the number of keys; with very many keys all slots
    are taken and nothing is filtered, so a join that decides must follow.
    """

    SLOTS = 1 << 20

    def __init__(self, keys: DataFrame):
        slots = keys.select(F.pmod(F.col(keys.columns[0]), F.lit(self.SLOTS)).cast("int").alias("s")).distinct()
        bits = np.zeros(self.SLOTS, bool)
        bits[slots.toPandas()["s"].to_numpy(np.int64)] = True
        self.bits = np.packbits(bits, bitorder="little")

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        slot = np.mod(keys, self.SLOTS)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    def mark(self, df: DataFrame, keys: Callable[[pa.RecordBatch], np.ndarray], name: str) -> DataFrame:
        """Adds the boolean column `name`; `keys` gives the keys of a batch."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in arrow_batches(whole):
                    yield batch.append_column(name, pa.array(self.maybe(keys(batch))))

        return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, BooleanType())]))


# ---- files in the shared folder ----------------------------------------------------------


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that driver and executors reach."""
    path = scratch_path(spark, name)
    return path if re.match(r"[a-z0-9]+:", path) else f"file://{path}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system of a URI (file, hdfs, s3, gs, abfs) and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlsplit(uri).path)
    return pafs.FileSystem.from_uri(uri)


class SharedFile:
    """Writes a file under another name and renames it when complete, so that repeated tasks never mix."""

    def __init__(self, folder: str, name: str):
        self.fs, base = file_system(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.part = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.part)
        return self.stream

    def __exit__(self, kind, value, trace):
        self.stream.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)
