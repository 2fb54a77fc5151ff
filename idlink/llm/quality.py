"""Quality rules: base counts, then divergence of a text's histograms from those of its language.

Method: the histogram of character classes and that of common words are compared with the
references of every language by Jensen-Shannon divergence (base 2, 0 to 1); the closest language
counts. The word divergence is given as a share of what a text without any common word has, as the
languages' common words weigh differently. Texts under a minimum length have too coarse histograms
and pass. A language has a reference from 1,000 words on, however many others have; texts of a language
with fewer are compared with all references, as every text is. Everything is columns of
built-in functions: one pass learns the references, one judges the documents, and no text is shuffled.

Defined results: a null text has no words and fails the base rule; so does an empty one. Rows are
judged alone, so repeated rows and ties get equal verdicts. A null language teaches nothing. Without
references (an empty table, few labelled words) only the base rule decides. Columns of the input with
clashing names are never read: the input travels in one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idlink.llm.common import WORD

#: Character classes, in the order in which they are taken out of the text; the last takes the rest.
CLASSES = {
    "lower": "[a-z]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "blank": r"[\x20\x09-\x0D]+",
    "mark": "[.,;:!?'\"()-]+",
    "symbol": r"[\x00-\x7F]+",
    "other": None,
}
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """Parameters. A language has a reference if its texts have `reference_words` words, whatever the others have."""

    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    guard_words: int = 50
    common_words: int = 10
    reference_words: int = 1000
    class_limit: float = 0.10
    word_limit: float = 0.95


def _repeat_words(df: DataFrame, window: int) -> DataFrame:
    """Adds `n_repeat_words`: words inside windows whose word sequence occurs twice or more."""
    get = F.get
    last = F.size("words") - F.lit(window)
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[get("words", i + F.lit(k)) for k in range(window)]))
    df = df.withColumn("grams", F.when(last >= 0, hashes))
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    # Only a text with equal windows sorts them; equal ones are then neighbours.
    pairs = F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("ordered", F.when(repeats, F.sort_array(pairs))).drop("grams")
    same = lambda x, j: F.coalesce(get("ordered", j)["h"] == x["h"], F.lit(False))
    twins = F.filter("ordered", lambda x, i: ((i > 0) & same(x, F.greatest(i - 1, F.lit(0)))) | same(x, i + 1))
    df = df.withColumn("places", F.sort_array(F.transform(twins, lambda x: x["i"]))).drop("ordered")
    step = lambda p, i: F.least(F.lit(window), F.coalesce(get("places", i + 1) - p, F.lit(window)))
    covered = F.aggregate(F.transform("places", step), F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def _class_counts(df: DataFrame) -> DataFrame:
    """Adds `classes`, the number of characters of each class, and `n_symbols`."""
    df = df.withColumn("left_0", F.coalesce("t", F.lit("")))
    counts = []
    for k, pattern in enumerate(CLASSES.values()):
        if pattern is None:
            counts.append(F.length(f"left_{k}"))
            break
        df = df.withColumn(f"left_{k + 1}", F.regexp_replace(f"left_{k}", pattern, ""))
        counts.append(F.length(f"left_{k}") - F.length(f"left_{k + 1}"))
    symbols = F.length("left_4") - F.length(F.regexp_replace("left_4", SYMBOLS, ""))
    out = df.withColumns({"classes": F.array(*[c.cast("double") for c in counts]), "n_symbols": symbols.cast("long")})
    return out.drop(*[f"left_{k}" for k in range(len(CLASSES))])


def _words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(WORD), F.lit(0)))


def base_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds the base counts and `base_failed` to a frame with the text in `t`; keeps `words` and `classes`."""
    df = _class_counts(_words(df))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_dup_lines": F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long"),
        }
    ).drop("lines")
    # A null array has size -1 or null by session setting; both give no repeated line.
    df = df.withColumn("n_dup_lines", F.when(F.col("t").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_dup_lines")))
    df = _repeat_words(df, rules.window)
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def references(texts: DataFrame, rules: Rules) -> list[tuple[str, list[float], list[tuple[str, float]]]]:
    """(language, class shares, common words with shares), from all texts `t` with a language `l`.

    The driver gets a dozen numbers for each language that has `reference_words` words.
    """
    known = _words(texts.where(F.col("l").isNotNull()))
    sums = [F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(CLASSES))]
    shares = _class_counts(known).groupBy("l").agg(*sums, F.sum(F.size("words")).alias("n"))
    found = {r["l"]: r for r in shares.where(F.col("n") >= max(1, rules.reference_words)).collect()}
    counts = known.select("l", F.explode("words").alias("w")).groupBy("l", F.lower("w").alias("w")).count()
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("count"), "w"))
    top = counts.where(F.col("l").isin(list(found))).withColumn("rank", rank).where(F.col("rank") <= rules.common_words)
    words: dict[str, list[tuple[str, float]]] = {}
    for r in top.orderBy("l", "rank").collect():
        words.setdefault(r["l"], []).append((r["w"], r["count"] / found[r["l"]]["n"]))
    out = []
    for language in sorted(found):
        sizes = [found[language][f"c{k}"] for k in range(len(CLASSES))]
        out.append((language, [s / sum(sizes) for s in sizes], words[language]))
    return out


def jensen_shannon(p: Column, q: Column) -> Column:
    """Base-2 divergence of two histograms of equal length, each with sum 1."""

    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        half = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0)) / 2
        return half(a) + half(b)

    return F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def judged(df: DataFrame, refs: list, rules: Rules) -> DataFrame:
    """Adds `class_divergence`, `word_divergence` (the least over languages) and `kept`."""
    common = sorted({w for _, _, words in refs for w, _ in words})
    if not refs:
        none = F.lit(None).cast("double")
        return df.withColumns({"class_divergence": none, "word_divergence": none, "kept": ~F.col("base_failed")})
    hits = F.filter(F.transform("words", F.lower), lambda w: w.isin(common))
    df = df.withColumn("hits", F.concat(F.lit(" "), F.array_join(hits, "  "), F.lit(" ")))
    count = lambda w: (F.length("hits") - F.length(F.replace("hits", F.lit(f" {w} "), F.lit("")))) / F.lit(len(w) + 2.0)
    df = df.withColumn("counts", F.array(*[count(w) for w in common])).drop("hits")
    chars = F.aggregate("classes", F.lit(0.0), lambda s, x: s + x)
    df = df.withColumn("shares", F.transform("classes", lambda x: F.try_divide(x, chars)))
    by_class, by_word = [], []
    for _, class_shares, words in refs:
        by_class.append(jensen_shannon(F.col("shares"), _doubles(class_shares)))
        own = [F.try_divide(F.col("counts")[common.index(w)], F.col("n_words")) for w, _ in words]
        rest = F.greatest(F.lit(0.0), F.lit(1.0) - sum(own[1:], own[0]))
        known = [share for _, share in words]
        reference = _doubles([*known, max(0.0, 1.0 - sum(known))])
        none = _doubles([*[0.0] * len(known), 1.0])
        by_word.append(F.try_divide(jensen_shannon(F.array(*own, rest), reference), jensen_shannon(none, reference)))
    least = lambda xs: F.array_min(F.array(*xs))
    long_enough = F.col("n_words") >= rules.guard_words
    df = df.withColumns({"class_divergence": F.when(long_enough, least(by_class)), "word_divergence": F.when(long_enough, least(by_word))})
    far = (F.col("class_divergence") > rules.class_limit) | (F.col("word_divergence") > rules.word_limit)
    return df.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).drop("counts", "shares")


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """One row per document: the document in the struct `doc`, its counts, divergences and `kept`."""
    refs = references(docs.select(F.col(text).alias("t"), F.col(lang).alias("l")), rules)
    df = base_counts(docs.select(F.struct("*").alias("doc"), F.col(text).alias("t"), F.col(lang).alias("l")), rules)
    return judged(df, refs, rules).drop("t", "l", "words", "classes")


def quality_filter(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with the columns they came with.

    The task number keeps the optimizer from moving the filter below the counts, where it would
    repeat their expressions many times over.
    """
    df = quality(docs, **options).withColumn("task", F.spark_partition_id())
    return df.where("kept AND task >= 0").select("doc.*")
