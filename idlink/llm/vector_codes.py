"""Product codes of vectors, trained and assigned in exact integer arithmetic.

Components become integers, vectors are cut into equal parts, and each part is replaced by the index of
its codebook's nearest entry. Distances are those of integers, so codes do not depend on the order of
sums, the batch size or the BLAS library.

The nearest entry minimizes |c|^2 - 2 x.c, and the dot products of a batch with all entries are one matrix
product. float64 holds integers exactly below 2^53 only, so both sides are split into limbs: low limbs
of `bits` bits, and the signed rest on top. `bits` is chosen such that a sum of products of limbs stays
below 2^53; each pair of limbs is one float64 product, exact by that bound, and the products are shifted
and added in int64. The first of the least distances wins.

A round is one pass over the vectors: a task sends, per part and entry, the number of its parts and
their component sums (at most parts x entries rows, whatever its input); sums of these are added up by
Spark. Only the codebooks reach the driver and the tasks: parts x entries short integer vectors, a bound
set by parameters. The vectors themselves are never shuffled.

Defined results: rows whose vector is null, empty or holds a null or non-finite component are dropped, and
so are vectors of another length than that of the smallest id. Null ids are coded but start no codebook
unless there are too few others. Repeated ids are rows of their own; as starts they are ordered by vector.
With fewer vectors than entries, codebooks are shorter. Integer components must be below the `limit` of
their length, so that every error fits a long; greater ones fail the job with a message that says so, as
their distances could not be told. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm.common import joined, kept, out_schema

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: float64 tells all integers up to here.
EXACT = 1 << 53
#: Sums per label up to this many labels are sent to all tasks; beyond, they are joined by a shuffle.
SENT_LABELS = 10_000


def limit(length: int) -> int:
    """Components below it in absolute value keep the summed squared distances of a vector within a long."""
    return math.isqrt(((1 << 63) - 1) // (4 * max(1, length)))


# ---- exact products ----------------------------------------------------------------------


def limb_bits(length: int) -> int:
    """Most bits of a limb for which a sum of `length` products of two limbs stays below 2^53."""
    return (52 - math.ceil(math.log2(max(1, length)))) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x as a sum of limbs times 2^(bits * place): low ones in [0, 2^bits), the last one signed and as small."""
    out = []
    while x.size and (x.min() < -(1 << bits) or x.max() >= 1 << bits):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Integer a (..., n, d) times b (..., m, d), transposed: exact if the true results fit a long."""
    bits = bits or limb_bits(a.shape[-1])
    total = np.zeros((*a.shape[:-1], b.shape[-2]), np.int64)
    for j, y in enumerate(limbs(b, bits)):
        y = np.swapaxes(y, -1, -2)
        for i, x in enumerate(limbs(a, bits)):
            total += np.matmul(x, y).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, books: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For x (parts, n, d) and books (parts, entries, d): first nearest entry and its squared distance, (parts, n)."""
    score = (books * books).sum(2)[:, None, :] - 2 * exact_dot(x, books, bits)
    code = score.argmin(2)
    return code, np.take_along_axis(score, code[..., None], 2)[..., 0] + (x * x).sum(2)


# ---- rows --------------------------------------------------------------------------------


def integers(vectors: pa.Array, length: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of a batch, and their integer components."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    flat = pc.list_flatten(vectors.take(pa.array(rows)))
    values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), length)
    good = np.isfinite(values).all(1)
    scaled = np.floor(values[good] * scale)
    if np.abs(scaled).max(initial=0) >= limit(length):
        raise ValueError(f"a component times {scale} is {limit(length)} or more; its distances would not fit a long")
    return rows[good], scaled.astype(np.int64)


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(len(x), parts, x.shape[1] // parts).swapaxes(0, 1))


def _usable(vectors: DataFrame, id_: str, vector: str, label: str) -> DataFrame:
    rows = vectors.select(F.col(id_).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def _sums(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape
    length = parts * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x = _cut(integers(batch.column("v"), length, scale)[1], parts)
            code, _ = nearest(x, books)
            for p in range(parts):
                count[p] += np.bincount(code[p], minlength=entries)
                np.add.at(total[p], code[p], x[p])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"],
        )

    found = rows.select("v").mapInArrow(run, "part long, entry long, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    books = books.copy()
    for part, entry, n, *total in found.groupBy("part", "entry").agg(F.sum("n"), *sums).collect():  # parts x entries at most
        books[part, entry] = [s // n for s in total]
    return books


def train(
    vectors: DataFrame,
    id_: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> np.ndarray:
    """Codebooks (parts, entries, width) of integers. Starts: the parts of the smallest ids' vectors."""
    rows = _usable(vectors, id_, vector, id_)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(1).collect()
    length = len(first[0]["v"]) if first else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components have no {parts} equal parts")
    starts = rows.where(F.size("v") == length).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries)
    begun = [r["v"] for r in starts.select("v").collect()]  # `entries` vectors
    books = _cut(integers(pa.array(begun, pa.list_(pa.float64())), length, scale)[1], parts)
    for _ in range(rounds if begun else 0):
        books = _sums(rows, books, scale)
    return books


def encode(
    vectors: DataFrame, books: np.ndarray, id_: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE
) -> DataFrame:
    """Codes with given codebooks: id, label, code (two hex digits a part) and error, the squared distance."""
    rows = _usable(vectors, id_, vector, label)
    parts, entries, width = books.shape
    length = parts * width
    if entries > 256:
        raise ValueError("codes have two hex digits a part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = integers(batch.column("v"), length, scale)
            if not len(at):
                continue
            code, distance = nearest(_cut(values, parts), books)
            text = code.T.astype(np.uint8).tobytes().hex()
            codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            taken = batch.select(["id", "label"]).take(pa.array(at))
            yield taken.append_column("code", pa.array(codes)).append_column("error", pa.array(distance.sum(0)))

    schema = StructType([rows.schema["id"], rows.schema["label"], *out_schema("code string, error long").fields])
    return rows.mapInArrow(run, schema).withColumnsRenamed({"id": id_, "label": label})


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Trains and encodes: id, code, error, label_error and the digest of the codebooks."""
    books = train(vectors, id_, vector)
    coded = encode(vectors.select(id_, vector, label), books, id_, vector, label).withColumnsRenamed({id_: "id", label: "label"})
    coded = kept(coded, "vector_codes")
    sums = kept(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    if sums.limit(SENT_LABELS + 1).count() <= SENT_LABELS:
        sums = F.broadcast(sums)
    out = joined(coded, sums, ["label"])
    return out.select(F.col("id").alias(id_), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
