"""Quality classifier: boosted trees over statistics of documents.

Every text becomes a short row of statistics of its bytes, words and lines (`STATISTICS`), in one pass
over whole texts. Trees (`trees.py`) learn a document's quality label from them, and nothing else of it;
they score all documents.

The trees learn from at most about `sample` labelled documents: a share of them by a hash, of which there
are so many. That is the only bound; it makes the learning rows (some 30 short numbers each) fit
the driver at any size. All statistics and scores cover all documents. Statistics are stored once, so texts
are read once.

Defined results: a null text counts as empty, and an empty text has zero for all statistics, and a score.
Labels of one document that differ count as a share; labels that are null, and labels of unknown
documents, teach nothing. Repeated ids get a row each, as do null ids (these are in the fold of the empty
text, and have no label). With no label to learn from, all scores are 0.5; with labels of one kind,
scores are that kind's smoothed share. Texts with equal statistics get equal scores. An empty table
gives no rows. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm import trees
from idlink.llm.common import NOT_BLANK, Words, _hashes, _spans, grams, kept, mix, out_schema, portions
from idlink.llm.langid import fold
from idlink.operators.skew import spread_join

#: Labelled documents that the trees learn from, about.
SAMPLE = 65_536
CUT = 0.3


def _bytes(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars.encode())] = 1
    return table


_UPPER, _LOWER, _DIGIT = (_bytes(c) for c in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_POINT, _SYMBOL, _STOP = _bytes(".,;:'\"()-?!"), _bytes("#*$%&|<>{}[]=+@^~\\/_"), _bytes(".?!:;\"')")
_BLANK = (~NOT_BLANK).astype(np.uint8)
_HIGH = (np.arange(256) >= 128).astype(np.uint8)
_LETTER = np.maximum.reduce([_UPPER, _LOWER, _HIGH])
_BEGIN = 1 - ((np.arange(256) & 0xC0) == 0x80).astype(np.uint8)  # bytes that begin a character
_NOT_NEWLINE = np.arange(256) != 10

STATISTICS = (
    "chars", "words", "lines", "word_length", "longest_word", "words_a_line", "upper", "digits", "points", "symbols", "blanks", "high",
    "distinct_words", "top_word", "word_entropy", "repeated_pairs", "repeated_fives", "same_as_last", "repeated_lines",
    "no_letter", "short", "long", "capitals", "all_capitals", "ends_in_point", "ends_in_symbol", "lone_symbols",
)


def _per_text(table: np.ndarray, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of a byte table over each text; the line feed after a text counts along."""
    return np.add.reduceat(table[data], begins[:-1], dtype=np.int64)


def _per_span(table: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of a byte table over each span."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat(table[data], np.column_stack([starts, ends]).ravel(), dtype=np.int64)[::2]


def _groups(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash): the text and how often."""
    keys, first, counts = np.unique(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
    return text[first], counts


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)))
    if not n:
        return out
    w = Words(texts, NOT_BLANK, lower=False)
    counts = np.diff(w.first)
    text = np.repeat(np.arange(n), counts)
    chars = np.maximum(_per_text(_BEGIN, w.data, w.begins) - 1, 0)
    length = np.diff(w.begins) - 1
    lengths = _per_span(_BEGIN, w.data, w.starts, w.ends)
    at = {name: k for k, name in enumerate(STATISTICS)}

    def put(name: str, total: np.ndarray, of: np.ndarray | float = 1.0) -> None:
        out[:, at[name]] = total / np.maximum(of, 1)

    def of_words(name: str, what: np.ndarray) -> None:
        put(name, np.bincount(text, what, n), counts)

    put("chars", np.log1p(chars))
    put("words", np.log1p(counts))
    for name, table in (("upper", _UPPER), ("digits", _DIGIT), ("points", _POINT), ("symbols", _SYMBOL), ("high", _HIGH)):
        put(name, _per_text(table, w.data, w.begins), length)
    put("blanks", _per_text(_BLANK, w.data, w.begins) - 1, length)
    of_words("word_length", lengths)
    longest = np.zeros(n)
    np.maximum.at(longest, text, lengths)
    put("longest_word", np.log1p(longest))

    line_starts, line_ends = _spans(w.data, _NOT_NEWLINE)
    line_text = np.searchsorted(w.begins, line_starts, "right") - 1
    lines = np.bincount(line_text, minlength=n)
    put("lines", np.log1p(lines))
    put("words_a_line", np.log1p(counts / np.maximum(lines, 1)))
    whose, _ = _groups(line_text, _hashes(w.data, line_starts, line_ends))
    put("repeated_lines", lines - np.bincount(whose, minlength=n), lines)

    whose, often = _groups(text, w.hash)
    put("distinct_words", np.bincount(whose, minlength=n), counts)
    top = np.zeros(n)
    np.maximum.at(top, whose, often)
    put("top_word", top, counts)
    put("word_entropy", np.where(counts > 0, np.log(np.maximum(counts, 1)) - np.bincount(whose, often * np.log(often), n) / np.maximum(counts, 1), 0))
    for name, size in (("repeated_pairs", 2), ("repeated_fives", 5)):
        inside = np.flatnonzero(text[size - 1 :] == text[: len(text) - size + 1]) if len(text) >= size else np.zeros(0, np.int64)
        whose, _ = _groups(text[inside], grams(w.hash, size)[inside])
        windows = np.bincount(text[inside], minlength=n)
        put(name, windows - np.bincount(whose, minlength=n), windows)
    same = np.zeros(len(text), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])
    of_words("same_as_last", same)

    letters = _per_span(_LETTER, w.data, w.starts, w.ends)
    capitals = _per_span(_UPPER, w.data, w.starts, w.ends)
    symbols = _per_span(_SYMBOL, w.data, w.starts, w.ends)
    of_words("no_letter", letters == 0)
    of_words("short", lengths <= 3)
    of_words("long", lengths >= 10)
    of_words("capitals", _UPPER[w.data[w.starts]])
    of_words("all_capitals", (capitals == letters) & (letters > 1))
    of_words("ends_in_point", _STOP[w.data[w.ends - 1]])
    of_words("ends_in_symbol", _SYMBOL[w.data[w.ends - 1]])
    of_words("lone_symbols", symbols == w.ends - w.starts)
    return out


def with_statistics(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every document: id and stats, an array of STATISTICS."""
    source = docs.select(F.col(id_).alias("id"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in portions(batch.column("t")):
                part = batch.slice(start, end - start)
                found = statistics(part.column("t")).astype(np.float32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("id"), flat], ["id", "stats"])

    return source.mapInArrow(run, StructType([source.schema["id"], *out_schema("stats array<float>").fields]))


def fit(stats: DataFrame, labels: DataFrame, id_: str = "doc_id", label: str = "quality", sample: int = SAMPLE, **options) -> trees.Forest:
    """Learns the label (0 or 1) from the statistics of about `sample` labelled documents at most."""
    targets = labels.where(F.col(label).isNotNull() & F.col(id_).isNotNull()).groupBy(F.col(id_).alias("id"))
    targets = targets.agg(F.avg(F.col(label).cast("double")).alias("target"))
    rows = spread_join(stats, targets, ["id"], ["stats"])
    rows = kept(rows.groupBy("id", "stats", "target").agg(F.count("*").alias("weight")), "learning_rows")
    found = rows.count()
    if found > sample:
        slots = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("id", "stats"), F.lit(slots)) < int(slots * sample / found))
    rows = rows.select("id", "stats", "target", F.col("weight").cast("double")).toPandas()
    x = np.array(rows["stats"].to_list(), np.float32).reshape(len(rows), len(STATISTICS))
    order = np.lexsort([*x.T, rows["id"].to_numpy()])
    return trees.fit(x[order], rows["target"].to_numpy(float)[order], rows["weight"].to_numpy(float)[order], **options)


def score(stats: DataFrame, forest: trees.Forest) -> DataFrame:
    """id, score of every row of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pc.list_flatten(batch.column("stats")).to_numpy(zero_copy_only=False)
            found = forest.predict(flat.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], ["id", "score"])

    return stats.mapInArrow(run, StructType([stats.schema["id"], *out_schema("score double").fields]))


def quality_report(docs: DataFrame, labels: DataFrame, id_: str = "doc_id", folds: int = 5, held_out: int = 0, cut: float = CUT) -> DataFrame:
    """Learns from all folds but one and scores every document: id, held_out, score, predicted."""
    stats = kept(with_statistics(docs, id_), "doc_statistics")
    forest = fit(stats, labels.where(fold(F.col(id_), folds) != held_out), id_)
    df = score(stats, forest)
    out = (fold(F.col("id"), folds) == held_out).alias("held_out")
    return df.select(F.col("id").alias(id_), out, "score", (F.col("score") >= cut).cast("int").alias("predicted"))
