"""Language identification by words first, backing off to character n-grams.

Model: per language, the relative frequencies of words and of the character n-grams of its words
(bounded by marks, orders 4 to 1). A known word is scored by its log frequency in each language. An
unseen word is scored by its n-grams of the highest order of which any is known; shorter ones count only
when no longer one is known. Word scores add up; the score is the best language's posterior.

All labelled rows are counted. The model keeps words and n-grams whose share in a language reaches
`min_share`, so it has at most 1 / min_share words and as many n-grams of each order per language,
whatever the size of the corpus: that bounds what the driver collects and the tasks receive.

Defined results: a null text, and one without a letter, is `und` with score 0; so is everything when
nothing was learned. Ties go to the language that sorts first. Rows with a null language teach nothing.
Very long texts are scored whole. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm.common import arrow_batches, kept, out_schema

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
_FLUSH = 200_000
_MEMO = 300_000


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (`lang`, `t`); every task adds up before it sends."""

    def batch_of(counts: dict[str, Counter]) -> pa.RecordBatch:
        flat = [(lang, w, n) for lang, found in counts.items() for w, n in found.items()]
        columns = list(zip(*flat)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for whole in batches:
            for batch in arrow_batches(whole):
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
                    counts[lang].update(words_of(text))
                if sum(map(len, counts.values())) > _FLUSH:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    sent = rows.where(F.col("lang").isNotNull() & F.col("t").isNotNull()).select("lang", "t")
    return sent.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, by: list[str], min_share: float) -> DataFrame:
    """(by, gram, share) of the grams with at least `min_share` of their language's total."""
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    df = counts.join(totals, by).withColumn("share", F.col("n") / F.col("total"))
    return df.where(F.col("share") >= min_share).select(*by, "gram", "share")


class Model:
    def __init__(self, words: dict[str, dict[str, float]], grams: dict[str, dict[str, float]], min_share: float):
        """`words` and `grams` map a word or n-gram to its share in each language that has it."""
        self.languages = sorted({lang for found in words.values() for lang in found})
        self.floor = np.log(min_share / 10)
        self.gram_row = {g: k for k, g in enumerate(grams)}
        self.gram_scores = self._vectors(grams)
        #: Row of every known word in the table of scores; rows of unseen words follow and may be dropped.
        self.known = {w: k for k, w in enumerate(words)}
        self.table = self._vectors(words)
        self.unseen: dict[str, int] = {}

    def _vectors(self, shares: dict[str, dict[str, float]]) -> np.ndarray:
        rows = [[np.log(found[x]) if x in found else self.floor for x in self.languages] for found in shares.values()]
        return np.array(rows, float).reshape(len(shares), len(self.languages))

    def _back_off(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words: the mean over a word's n-grams of the highest order of which any is known."""
        found, counts = [], np.zeros(len(words), np.int64)
        get = self.gram_row.get
        for k, word in enumerate(words):
            marked = f"^{word}$"
            for order in ORDERS:
                rows = [row for i in range(len(marked) - order + 1) if (row := get(marked[i : i + order])) is not None]
                if rows:
                    found += rows
                    counts[k] = len(rows)
                    break
        out = np.zeros((len(words), len(self.languages)))
        some = counts > 0
        if found:
            starts = (np.cumsum(counts) - counts)[some]
            out[some] = np.add.reduceat(self.gram_scores[found], starts, axis=0) / counts[some, None]
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words by language."""
        rows = list(map(self.known.get, words))
        if None in rows:
            if len(self.unseen) >= _MEMO:
                self.unseen.clear()
            new = [w for w, row in zip(words, rows) if row is None and w not in self.unseen]
            if new:
                at = len(self.known) + len(self.unseen)
                if at + len(new) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros((at + len(new), len(self.languages)))])
                self.table[at : at + len(new)] = self._back_off(new)
                self.unseen.update(zip(new, range(at, at + len(new))))
            rows = [self.unseen[w] if row is None else row for w, row in zip(words, rows)]
        return self.table[rows]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text or ""))
        if not counts or not self.languages:
            return "und", 0.0
        total = np.fromiter(counts.values(), float, len(counts)) @ self.scores(list(counts))
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit(rows: DataFrame, min_share: float = 1e-5) -> Model:
    """Learns from all rows (`lang`, `t`)."""
    counts = kept(word_counts(rows), "language_words")
    marked = F.concat(F.lit("^"), "gram", F.lit("$"))
    pieces = [
        F.when(F.length("m") >= k, F.transform(F.sequence(F.lit(1), F.length("m") - (k - 1)), lambda i, k=k: F.substring("m", i, F.lit(k))))
        for k in ORDERS
    ]
    pieces = F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in pieces])
    grams = counts.withColumn("m", marked).select("lang", F.explode(pieces).alias("gram"), "n")
    grams = grams.groupBy("lang", F.length("gram").alias("order"), "gram").agg(F.sum("n").alias("n"))

    def collected(df: DataFrame) -> dict[str, dict[str, float]]:
        out: dict[str, dict[str, float]] = defaultdict(dict)
        for lang, gram, share in df.select("lang", "gram", "share").toPandas().itertuples(index=False):
            out[gram][lang] = share
        return out

    words = collected(_frequent(counts, ["lang"], min_share))
    return Model(words, collected(_frequent(kept(grams, "language_grams"), ["lang", "order"], min_share)), min_share)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents, each in the struct `doc`, with `lang_pred` and `score`."""
    sent = docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for batch in arrow_batches(whole):
                found = [known.predict(t) for t in batch.column("t").to_pylist()]
                columns = [batch.column("doc"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "lang_pred", "score"])

    schema = StructType([sent.schema["doc"], *out_schema("lang_pred string, score double").fields])
    return sent.mapInArrow(run, schema)


def fold(id_: Column, of: int) -> Column:
    """Remainder of the crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % of


def language_report(docs: DataFrame, id_: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held_out: int = 0) -> DataFrame:
    """Learns from all folds but one and predicts the language of every document."""
    out = fold(F.col(id_), folds) == held_out
    model = fit(docs.where(~out).select(F.col(lang).alias("lang"), F.col(text).alias("t")))
    df = predict(docs.select(F.col(id_).alias("id"), F.col(text).alias("t")), model, "t")
    df = df.select(F.col("doc.id").alias("id"), "lang_pred", "score")
    return df.select(F.col("id").alias(id_), (fold(F.col("id"), folds) == held_out).alias("held_out"), "lang_pred", "score")
