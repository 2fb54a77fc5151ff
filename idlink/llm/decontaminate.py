"""Benchmark decontamination by winnowing.

Items and documents are cut into windows of `window` words. A window's fingerprint is the least of
the k-gram hashes in it, so two equal windows have equal fingerprints: every shared span of `window`
words or more is found, whatever surrounds it. Document windows whose fingerprint and whole hash may
be among the items' (a bit table of fixed size) are joined with the items' windows on the
fingerprint, and a hit is extended to the window by comparing its words. Overlapping windows add up
to spans of any length. Items shorter than a window are one window of their own length.

One pass reads the texts and keeps a few windows; only these are shuffled. A passage in very many
documents gives one row per document and place.

Defined results: null and empty texts have no words. An item without words has no window; an item
without id marks words as hit but is not listed. Repeated items count once, repeated documents are
rows of their own. Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm.common import ALPHANUMERIC, SlotFilter, Words, arrow_batches, grams, kept, out_schema, row_ids, signed

_WINDOW = "f long, whole long, start int, n int, words string"


def _windows(words: Words, lengths: list[int], window: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: it, the text of every window, its first word, fingerprint and whole hash."""
    hashes, ends = words.hash, words.first[1:]
    for n in lengths:
        whole = grams(hashes, n)
        if n == window:
            fingerprint = grams(hashes, k)
            fingerprint = np.minimum.reduce([fingerprint[i : i + len(whole)] for i in range(window - k + 1)])
        else:
            fingerprint = whole
        first = np.arange(len(whole))
        inside = first + n <= ends[np.searchsorted(ends, first, "right").clip(max=len(ends) - 1)]
        yield n, first[inside], signed(fingerprint[inside]), signed(whole[inside])


def item_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item_id, f, whole, start, n, words) of every window of the items `id`, `t`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in arrow_batches(whole_batch):
                words = Words(batch.column("t"), ALPHANUMERIC)
                counts = np.diff(words.first)
                ids = batch.column("id").to_pylist()
                short = sorted({int(c) for c in counts if 0 < c < window})
                rows = []
                for n, first, f, whole in _windows(words, [*short, window], window, k):
                    texts = np.searchsorted(words.first, first, "right") - 1
                    for i, a, b, c in zip(texts.tolist(), first.tolist(), f.tolist(), whole.tolist()):
                        if n == min(window, counts[i]):
                            rows.append((ids[i], b, c, a - int(words.first[i]), n, words.text(a, n)))
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["item_id", "f", "whole", "start", "n", "words"]
                )

    return items.select(F.col("id").cast("string").alias("id"), "t").mapInArrow(run, f"item_id string, {_WINDOW}")


def candidates(docs: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """`docs` without `t`, with `row`, `n_words` and `hits`, the windows that may be an item's."""
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # `window` values at most
    prints, wholes = SlotFilter(items.select("f")), SlotFilter(items.select("whole"))
    others = [c for c in docs.columns if c != "t"]
    kind = pa.struct([("f", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for whole_batch in batches:
            for batch in arrow_batches(whole_batch):
                words = Words(batch.column("t"), ALPHANUMERIC)
                hits: list[list[tuple]] = [[] for _ in range(batch.num_rows)]
                for n, first, f, whole in _windows(words, lengths, window, k):
                    maybe = np.flatnonzero(prints.maybe(f))
                    maybe = maybe[wholes.maybe(whole[maybe])]
                    texts = np.searchsorted(words.first, first[maybe], "right") - 1
                    for i, a, b in zip(texts.tolist(), first[maybe].tolist(), f[maybe].tolist()):
                        hits[i].append((b, a - int(words.first[i]), n, words.text(a, n)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in others],
                        pa.array(row_ids(at, batch.num_rows)),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array([[dict(zip(("f", "start", "n", "words"), h)) for h in x] for x in hits], pa.list_(kind)),
                    ],
                    [*others, "row", "n_words", "hits"],
                )
                at += batch.num_rows

    added = out_schema("row long, n_words long, hits array<struct<f:long,start:int,n:int,words:string>>")
    schema = StructType([*[docs.schema[c] for c in others], *added.fields])
    return docs.select(*others, "t").mapInArrow(run, schema)


def occurrences(found: DataFrame, items: DataFrame) -> DataFrame:
    """(row, start, n, item_id) of the candidates that are windows of an item."""
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    return hits.join(items.select("item_id", "f", "n", "words").distinct(), ["f", "n", "words"]).select("row", "start", "n", "item_id")


def _prepared(benchmark: DataFrame, item_id: str, text: str, window: int, k: int) -> DataFrame:
    return kept(item_windows(benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("t")), window, k), "benchmark_windows")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """One row per document: its words, those hit, and the items whose windows occur in it (`items`, sorted)."""
    items = _prepared(benchmark, item_id, item_text, window, k)
    found = kept(candidates(docs.select(F.col(id_).alias("id"), F.col(text).alias("t")), items, window, k), "contamination")
    at = kept(occurrences(found, items), "occurrences")
    order = Window.partitionBy("row").orderBy("start", "n")
    end = F.col("start") + F.col("n")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = at.select("row", "start", "n").distinct()
    hit = spans.select("row", F.greatest(F.lit(0), end - F.greatest("start", before)).alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    listed = at.where(F.col("item_id").isNotNull()).groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    df = found.drop("hits").join(hit, "row", "left").join(listed, "row", "left")
    none = F.array().cast("array<string>")
    return df.select(
        F.col("id").alias(id_), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """The documents without any window of an item, with the columns they came with. Clean texts are not shuffled."""
    items = _prepared(benchmark, item_id, item_text, window, k)
    found = candidates(docs.select(F.struct("*").alias("doc"), F.col(text).alias("t")), items, window, k)
    clean = found.where(F.size("hits") == 0).select("doc")
    suspects = kept(found.where(F.size("hits") > 0), "suspects")
    cleared = suspects.join(occurrences(suspects, items).select("row").distinct(), "row", "left_anti").select("doc")
    return clean.union(cleared).select("doc.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_: str = "doc_id", **options) -> DataFrame:
    """`contamination` with the items as a count and a digest."""
    df = contamination(docs, benchmark, id_, **options)
    return df.select(
        id_,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
