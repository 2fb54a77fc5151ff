"""Document statistics by plain Python, trees by exhaustive search and walking, and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from idlink.llm import doc_classifier as dc
from idlink.llm import trees

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#*$%&|<>{}[]=+@^~\\/_"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    raw, n = text.encode(), len(words)
    lines = [x for x in text.split("\n") if x]
    letters = [sum(b in UPPER.encode() or b in UPPER.lower().encode() or b >= 128 for b in w.encode()) for w in words]
    capitals = [sum(c in UPPER for c in w) for w in words]
    counts = Counter(words)

    def share(total, of):
        return total / max(of, 1)

    def repeats(size):
        windows = [tuple(words[i : i + size]) for i in range(n - size + 1)]
        return share(len(windows) - len(set(windows)), len(windows))

    return {
        "chars": math.log1p(len(text)),
        "words": math.log1p(n),
        "lines": math.log1p(len(lines)),
        "word_length": share(sum(map(len, words)), n),
        "longest_word": math.log1p(max(map(len, words), default=0)),
        "words_a_line": math.log1p(n / max(1, len(lines))),
        "upper": share(sum(c in UPPER for c in text), len(raw)),
        "digits": share(sum(c in "0123456789" for c in text), len(raw)),
        "points": share(sum(c in ".,;:'\"()-?!" for c in text), len(raw)),
        "symbols": share(sum(c in SYMBOLS for c in text), len(raw)),
        "blanks": share(sum(c in " \t\n\v\f\r" for c in text), len(raw)),
        "high": share(sum(b >= 128 for b in raw), len(raw)),
        "distinct_words": share(len(counts), n),
        "top_word": share(max(counts.values(), default=0), n),
        "word_entropy": -sum(c / n * math.log(c / n) for c in counts.values()),
        "repeated_pairs": repeats(2),
        "repeated_fives": repeats(5),
        "same_as_last": share(sum(a == b for a, b in zip(words, words[1:])), n),
        "repeated_lines": share(len(lines) - len(set(lines)), len(lines)),
        "no_letter": share(sum(x == 0 for x in letters), n),
        "short": share(sum(len(w) <= 3 for w in words), n),
        "long": share(sum(len(w) >= 10 for w in words), n),
        "capitals": share(sum(w[0] in UPPER for w in words), n),
        "all_capitals": share(sum(a == b > 1 for a, b in zip(capitals, letters)), n),
        "ends_in_point": share(sum(w[-1] in ".?!:;\"')" for w in words), n),
        "ends_in_symbol": share(sum(w[-1] in SYMBOLS for w in words), n),
        "lone_symbols": share(sum(all(c in SYMBOLS for c in w) for w in words), n),
    }


ODD = [
    None, "", " ", "\n\n", "one", "one one one two two one one two", "A BC de\n\nA BC de\nx $$ ## y$ 12 é É\U0001f600 é.",
    "the cat sat on the mat and the cat sat on the mat again", "x\ty\vz\x0cw\r\nq", "word " * 2000, "é" * 50, "| a | b |", "",
]


def test_statistics_equal_plain_python():
    for texts in (ODD, [ODD[6]], [None], ["", ""], [ODD[7] + " a", "a " + ODD[7]]):
        got = dc.statistics(pa.array(texts, pa.string()))
        for row, text in zip(got, texts):
            want = plain(text)
            assert tuple(want) == dc.STATISTICS
            np.testing.assert_allclose(row, list(want.values()), rtol=1e-12, atol=1e-12, err_msg=repr(text))


def test_portions_cover_all_rows():
    texts = pa.array(["a" * n for n in (1, 9, 3, 0, 50, 2)] + [None])
    parts = list(dc.portions(texts, 10))
    assert parts == [(0, 2), (2, 4), (4, 5), (5, 7)]
    assert list(dc.portions(pa.array([], pa.string()))) == []


def walk(forest, row):
    bins = forest.bins(row[None])[0]
    total = forest.start
    for node in forest.roots.tolist():
        for _ in range(forest.depth):
            node = forest.child[node] + int(bins[forest.column[node]] > forest.cut[node])
        total += forest.value[node]
    return 1 / (1 + math.exp(-total))


def test_traversal_equals_walking_and_learns():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 4))
    target = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    forest = trees.fit(x, target, np.ones(800), trees=30, depth=3)
    got = forest.predict(x)
    np.testing.assert_allclose(got, [walk(forest, r) for r in x], rtol=1e-12)
    assert ((got >= 0.5) == target).mean() > 0.95
    assert 0 < got.min() and got.max() < 1


def test_first_cut_is_the_best_one():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 6, (60, 3)).astype(float)
    target, weight = rng.random(60), rng.integers(1, 4, 60).astype(float)
    forest = trees.fit(x, target, weight, trees=1, depth=1, rate=1.0, ridge=0.5, least=0.0)
    p = 1 / (1 + math.exp(-forest.start))
    g, h = (p - target) * weight, p * (1 - p) * weight

    def gain(mask):
        return sum(g[m].sum() ** 2 / (h[m].sum() + 0.5) for m in (mask, ~mask)) - g.sum() ** 2 / (h.sum() + 0.5)

    best = max(gain(x[:, j] <= v) for j in range(3) for v in range(5))
    j, cut = forest.column[0], forest.cut[0]
    left = forest.bins(x)[:, j] <= cut
    assert gain(left) == pytest.approx(best)
    for node, mask in ((1, left), (2, ~left)):
        assert forest.value[node] == pytest.approx(-g[mask].sum() / (h[mask].sum() + 0.5))


def test_weights_count_as_repeated_rows():
    rng = np.random.default_rng(9)
    x, target = rng.normal(size=(50, 2)), rng.integers(0, 2, 50).astype(float)
    weight = rng.integers(1, 4, 50)
    edges = [trees.borders(x[:, j], 64) for j in range(2)]
    a = trees.fit(x, target, weight.astype(float), trees=5)
    b = trees.fit(np.repeat(x, weight, 0), np.repeat(target, weight), np.ones(weight.sum()), trees=5)
    if all(len(e) == len(f) and (e == f).all() for e, f in zip(a.edges, b.edges)) and len(edges[0]):
        np.testing.assert_allclose(a.predict(x), b.predict(x), rtol=1e-9)


def test_nothing_to_learn_from():
    none = trees.fit(np.zeros((0, 3)), np.zeros(0), np.zeros(0))
    assert none.predict(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    ones = trees.fit(np.random.default_rng(1).normal(size=(20, 3)), np.ones(20), np.ones(20))
    assert (ones.predict(np.zeros((2, 3))) > 0.9).all()


def test_report(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in dc.quality_report(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 < r.score < 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    known = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = ([r for q, r in known if q == k] for k in (1, 0))
    assert sum(r.predicted for r in good) >= 0.95 * len(good) and sum(r.predicted for r in bad) <= 0.2 * len(bad)
    # held-out labels, languages, sources and ids are not used
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in dc.quality_report(docs.select("doc_id", "text").repartition(7), turned).collect()}
    assert all(again[i] == pytest.approx(r.score, abs=1e-9) for i, r in got.items())


def test_odd_tables(spark):
    rows = [(1, "good words here and there"), (1, "good words here and there"), (None, None), (2, None), (3, ""), (4, "x " * 300_000), (5, "## $$")]
    clash = {c: F.lit("x") for c in ("id", "t", "stats", "score", "target", "weight", "held_out", "predicted", "quality")}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, None), (None, 1), (3, 0), (4, 0), (99, 1), (5, 0)], "doc_id long, quality int").withColumns(
        {c: F.lit("y") for c in ("id", "text", "target", "stats")}
    )
    got = dc.quality_report(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "4", "5", "None"]
    assert len({r.score for r in got if r.doc_id == 1}) == 1 and len({r.score for r in got if r.doc_id in (None, 2, 3)}) == 1
    assert dc.quality_report(docs.where("false"), labels).collect() == []
    assert {r.score for r in dc.quality_report(docs, labels.where("false")).collect()} == {0.5}


def test_sample_is_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen = []
    real = trees.fit
    try:
        trees.fit = lambda x, *a, **b: seen.append(len(x)) or real(x, *a, **b)
        dc.fit(dc.with_statistics(docs), labels, sample=500)
    finally:
        trees.fit = real
    assert 400 < seen[0] < 600
