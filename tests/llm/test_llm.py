"""The text operators against brute force, round trips and held-out accuracy, on small odd inputs."""

from __future__ import annotations

import functools
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from idlink.llm import (
    attribution,
    decontaminate,
    jaccard,
    langid,
    licenses,
    mixing,
    planes,
    quality,
    suffix_tree,
    tokens,
    warc,
)
from idlink.llm.common import kept
from idlink.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over the lazy dog and then it sleeps near the old barn until morning comes again"
ODD = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, PROSE.replace("barn", "BARN"), None, None),
    (4, None, "en", "b"),
    (5, "", None, ""),
    (None, "one two", "de", "b"),
    (7, " \t\n ", "de", "b"),
    (8, "word " * 30_000, "en", "a"),
    (9, "###  $$$\n\n  x y  <|endoftext|> é\U0001f600 don't   end \n \n", "fr", "c"),
    (10, "\n".join(["same line here"] * 6), "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    clash = {c: F.lit("x") for c in ("t", "id", "row", "node", "n_words", "kept", "doc", "size", "hits", "score", "words")}
    return spark.createDataFrame(ODD, SCHEMA).withColumns(clash)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# ---- quality rules -----------------------------------------------------------------------


def base_of(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    inside = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_quality_base(table, request):
    df = request.getfixturevalue(table)
    got = quality.quality(df).select(
        "doc.doc_id", "doc.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    for r in got.collect():
        assert tuple(r)[2:8] == base_of(r.text), r.doc_id
        assert not (r.kept and r.base_failed)


def test_quality_of_languages_beside_a_large_one(spark, docs):
    """A small language has a reference of its own, and a tiny one no exemption."""
    english = docs.where("lang = 'en'").select("doc_id", "text", "lang")
    french = docs.where("lang = 'fr' and length(text) > 1500").select((F.col("doc_id") + 10_000).alias("doc_id"), "text", "lang").limit(6)
    noise = random.Random(5)
    junk = [(20_000 + k, " ".join("".join(noise.choice("qxzjvk") for _ in range(5)) for _ in range(80)), lang) for k, lang in enumerate(["sw", "en", None])]
    many = english.unionByName(english).unionByName(french).unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string"))
    kept = {r.doc_id: r.kept for r in quality.quality(many).select("doc.doc_id", "kept").where("doc_id >= 10000").collect()}
    assert [kept[20_000 + k] for k in range(3)] == [False] * 3
    assert sum(v for k, v in kept.items() if k < 20_000) >= 5


def test_quality_keeps_prose_and_drops_junk(docs, odd, empty):
    kept = {r.doc_id for r in quality.quality_filter(docs).select("doc_id").collect()}
    labels = docs.sparkSession.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(d in kept for d in good) >= 0.9 * len(good) and sum(d in kept for d in bad) <= 0.3 * len(bad)
    assert quality.quality_filter(odd).columns == odd.columns
    assert quality.quality_filter(empty).count() == 0


def test_divergence_is_zero_for_equal_histograms(spark):
    half = lambda *x: F.array(*[F.lit(v) for v in x])
    row = spark.range(1).select(
        quality.jensen_shannon(half(0.5, 0.5), half(0.5, 0.5)), quality.jensen_shannon(half(1.0, 0.0), half(0.0, 1.0))
    ).first()
    assert tuple(row) == (0.0, 1.0)


# ---- Jaccard join ------------------------------------------------------------------------


def set_of(text, n):
    w = words_of(lowered(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, n, percent):
    sets = [(i, set_of(t, n)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            o = len(x & y)
            if o and 100 * o >= percent * (len(x) + len(y) - o):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min((x for x in (least.get(root(k)), i) if x is not None), default=None)
    return sorted(((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets)), key=str)


def variants():
    """A chain of texts that link only to their neighbours, and texts around the limit."""
    words = [f"w{i}" for i in range(120)]
    out = [(100 + k, " ".join(words[k * 2 : 100 + k * 2]), "en", "a") for k in range(10)]
    for k in range(12):
        edited = list(words)
        for j in range(k):
            edited[(j * 37 + k * 5) % 120] = f"x{k}-{j}"
        out.append((200 + k, " ".join(edited), "en", "a"))
    return out


def test_one_python_step_per_task(spark, odd, monkeypatch):
    """Two in a row take two workers of every core, which stay with all that they hold."""
    frames = []
    monkeypatch.setattr(jaccard, "kept", lambda df, name: frames.append(df) or kept(df, name))
    near = spark.createDataFrame([(100 + k, f"{PROSE} and then {PROSE.upper()} {k}", "en", "a") for k in range(4)], SCHEMA)
    docs = odd.select("doc_id", "text", "lang", "source").union(near)
    frames.append(jaccard.keep_one(docs, n=5, percent=80))
    assert len(frames) > 10
    for frame in frames:
        above: list[tuple[int, str]] = []
        for line in frame._jdf.queryExecution().sparkPlan().toString().splitlines():
            depth = re.search(r"[A-Za-z]", line).start()
            above = [x for x in above if x[0] < depth]
            if "MapInArrow" in line:
                # sparkPlan has no exchanges yet: what needs one stands between.
                inner = [name for _, name in above]
                last = max((k for k, name in enumerate(inner) if re.match("Exchange|.*Aggregate|.*Join|Window|Sort", name)), default=-1)
                assert not any("MapInArrow" in name for name in inner[last + 1 :]), frame._jdf.queryExecution().sparkPlan().toString()
            above.append((depth, line[depth:]))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_equals_brute_force(spark, n, percent):
    rows = ODD + variants()
    df = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(jaccard.jaccard_report(df, n=n, percent=percent, block=3), "doc_id", "n_shingles", "component_id")
    assert got == brute_components([(r[0], r[1]) for r in rows], n, percent)


def test_partners_share_the_keys_they_need():
    """Random small sets that link: each shares at least as many keys as it claims that every partner does."""
    rng = np.random.default_rng(5)
    for _ in range(4000):
        percent = int(rng.choice([60, 80, 90]))
        size = int(rng.integers(3, 16))
        x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        y = np.unique(np.concatenate([x, rng.integers(0, 2**63, int(rng.integers(1, 3))).astype(np.uint64)]))
        if len(x) < jaccard.required_overlap(len(x), len(y), percent):
            continue
        sent = [jaccard.part_keys(s, percent) for s in (x, y)]
        ok = []
        for one, other in (sent, sent[::-1]):
            ok.append(any(len(set(k.tolist()) & set(j.tolist())) >= max(need, 1) for k, need in one for j, _ in other))
        assert all(ok), (percent, len(x), len(y))


def test_keep_one_of_each_component(spark, odd, empty):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert rows_of(kept, "doc_id") == rows_of(spark.createDataFrame([(i,) for i in (1, 4, 5, None, 7, 8, 9, 10)], "doc_id long"), "doc_id")
    assert jaccard.keep_one(empty).count() == 0 and jaccard.jaccard_report(empty).count() == 0


def test_block_search_equals_all_comparisons():
    """The index of a block holds what the query asks for, and finds what comparing all finds."""
    rng = np.random.default_rng(12)
    for trial in range(60):
        pool = np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64))
        sets = [np.unique(rng.choice(pool, int(rng.integers(1, 30)))) for _ in range(20)]
        query, members = sets[0], sets[1 : 1 + trial % 20]
        for percent in (30, 60, 90):
            want = [k for k, m in enumerate(members) if 100 * len(np.intersect1d(query, m)) >= percent * len(np.union1d(query, m))]
            assert jaccard._search_block(query, members, percent) == want


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sets = [set(rng.choice(40, rng.integers(1, 30), replace=False).tolist()) for _ in range(20)]
        query, members = sets[0], sets[1:]
        index = {}
        for k, m in enumerate(members):
            for x in m:
                index.setdefault(x, []).append(k)
        want = [k for k, m in enumerate(members) if 100 * len(query & m) >= 60 * len(query | m)]
        assert jaccard.divide_skip(sorted(query), index, [len(m) for m in members], 60) == want


# ---- decontamination ---------------------------------------------------------------------


def brute_hits(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    words, hit, names = find(text), set(), set()
    for name, body in items:
        item = find(body)
        n = min(10, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                if name is not None:
                    names.add(str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(words), len(hit), len(names), digest, bool(hit)


def test_decontamination_equals_brute_force(spark, odd, empty):
    items = [(1, PROSE[20:90]), (1, PROSE[20:90]), (2, None), (3, "word word word"), (None, "same LINE!"), (10, "endoftext é"), (4, "word " * 12), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination_report(odd, bench)
    text_of = {r[0]: r[1] for r in ODD}
    for r in got.collect():
        assert tuple(r)[1:] == brute_hits(text_of[r.doc_id], items), r.doc_id
    assert got.count() == len(ODD)
    clean = decontaminate.decontaminate(odd, bench)
    want = [r[0] for r in ODD if not brute_hits(r[1], items)[4]]
    assert [r[0] for r in rows_of(clean, "doc_id")] == sorted(want, key=lambda x: str((x,)))
    none = bench.where("false")
    assert decontaminate.decontaminate(odd, none).count() == len(ODD)
    assert decontaminate.contamination_report(empty, bench).count() == 0


# ---- mixing ------------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_mix(table, request):
    df = request.getfixturevalue(table)
    found = mixing.mix_report(df).collect()
    assert len(found) == df.count()
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
    if table == "docs":
        assert all(abs(taken[s] - want[s]) <= largest[s] + 1 for s in sizes)
    assert sorted(map(str, mixing.mix_report(df).collect())) == sorted(map(str, found))
    assert mixing.mix(df).columns == df.columns
    assert sum(len(words_of(r.text)) for r in mixing.mix(df).select("text").collect()) == sum(taken.values())


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).count() == 0 and mixing.mix_report(empty).count() == 0


# ---- tokens ------------------------------------------------------------------------------

TRICKY = [r[1] or "" for r in ODD] + ["  a", "a  ", "a   b", "a \n b", "a\n \nb", "x\t y", "  a  b", "ÀÉ ǆ ꟸ1²½", "'s 't  's", "<|endoftext|> a b"]


@functools.cache
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(tokens.DEFAULT))


def reference_ids(text):
    return reference().encode(text, add_special_tokens=False)


def check_encoder(texts):
    encoder = tokens.id_encoder(tokens.DEFAULT)
    spans, counts = encoder.spans(texts)
    at = base = 0
    for text, ids, n in zip(texts, encoder.encode(texts), counts.tolist()):
        want = reference_ids(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text[:40]
        assert (spans[at : at + n] - base).tolist() == [list(x) for x in want.offsets], text[:40]
        at, base = at + n, base + len(text)
    assert at == len(spans)


def test_cached_encoding_equals_whole_encoding():
    check_encoder(TRICKY)
    check_encoder([""])
    check_encoder([])


def test_encoding_of_random_texts():
    rng = random.Random(3)
    letters = [*"aabcde  XYZ12.,'!?\n\t\r-_#$", "'s", "ll", "\u2028", "\u00a0", *"éßɐ漢字😀ª²½Ωǅ", "\u0301", "\uffff", "<|endoftext|>", "İ", "\x00", "\x85"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(600)]
    for at in range(0, 600, 7):
        check_encoder(texts[at : at + 7])


def test_ended_words_take_the_ids_of_their_stems():
    """A word and the sign behind it are not merged, nor kept, as a whole; parts across lines are not kept."""
    encoder = tokens.IdEncoder(tokens.DEFAULT)
    texts = ["Barn, the barn; a barn. A lorem!\nNext barn, x:", "barn? é, ªb. don't, 3, , ."]
    for _ in range(2):
        assert encoder.encode(texts) == [np.array(reference_ids(x).ids, "<u4").tobytes() for x in texts]
        kept = {*encoder.parts, *encoder.heads}
        assert {"Barn", "barn", "x"} <= kept and not {"Barn,", "barn;", "barn.", "lorem!\nNext", "x:", "barn?"} & kept


def test_words_are_looked_up_once_a_batch():
    """What Python does grows with the distinct words of a batch; signs behind a word do not make it another word."""

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    encoder = tokens.IdEncoder(tokens.DEFAULT)
    encoder.parts = Counted()
    texts = ["the old barn " * 500, "barn%%% the old\nbarn,&& " * 500 + "“old”", "the\u00a0 old  barn$$$", "'tis the barn'", "", "\u3000", " "]
    want = [np.array(reference_ids(x).ids, "<u4").tobytes() for x in texts]
    assert encoder.encode(texts) == want
    assert Counted.asked < 40
    assert "barn" in encoder.parts and not {"barn%%%", "barn,&&", "\nbarn,&&", "barn'"} & {*encoder.parts}
    for kind in (pa.string(), pa.large_string()):
        assert encoder.encode(pa.array(["x", *texts, "y"], kind).slice(1, len(texts))) == want


def test_small_batches_are_encoded_together(monkeypatch):
    """Rows keep their order and none is lost, however batches are cut and gathered."""
    rows = [(None if k % 5 == 0 else k, "barn " * (k % 7)) for k in range(40)]
    batches = [pa.RecordBatch.from_pylist([{"id": d, "t": t} for d, t in rows[a : a + 3]], pa.schema([("id", pa.int64()), ("t", pa.string())])) for a in range(0, 40, 3)]
    for together, most in ((planes.TOGETHER, 1), (300, 14), (1, 40)):
        monkeypatch.setattr(planes, "TOGETHER", together)
        found = list(planes._gathered(iter(batches)))
        assert len(found) <= most
        assert [(d, t) for ids, texts in found for d, t in zip(ids, texts.to_pylist(), strict=True)] == rows
    assert list(planes._gathered(iter([]))) == []


def test_words_are_merged_many_at_once():
    """Words behind a blank or a line feed take one call of the library for many, and lines are cut, so their words are kept."""
    encoder = tokens.IdEncoder(tokens.DEFAULT)
    calls, merge = [], encoder.tokenizer.model.tokenize
    encoder.tokenizer = SimpleNamespace(model=SimpleNamespace(tokenize=lambda x: calls.append(x) or merge(x)), encode_batch=encoder.tokenizer.encode_batch)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randrange(1, 9))) for _ in range(900)]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", ", ", ".\n"]) for _ in range(400)) for _ in range(9)]
    texts = ["\n" + texts[0], *texts, texts[1].strip(), "\n", "a\n", "é,\né"]
    assert encoder.encode(texts) == [np.array(reference_ids(x).ids, "<u4").tobytes() for x in texts]
    assert len(calls) < 150
    assert not any("\n" in p[1:] or p.endswith((",", ".")) for p in encoder.parts)
    assert any(p[0] == "\n" for p in encoder.parts if p)


def test_read_tasks_give_the_encoders_memory_back(spark, odd, monkeypatch):
    """What is known to an encoder goes when its files are read, also in the process that reads them."""
    encoder = tokens.id_encoder(tokens.DEFAULT)
    encoder.encode(["the old barn"])
    assert encoder.parts and encoder.heads
    run = []
    keep = lambda df, f, schema: run.append(f) or map_in_arrow(df, f, schema)
    map_in_arrow = type(odd).mapInArrow
    files = planes.write_ids(odd)
    monkeypatch.setattr(type(odd), "mapInArrow", keep)
    planes.read_report(files)
    assert list(run[0](iter([]))) == []
    assert not (encoder.parts or encoder.heads or encoder.pieces)
    assert encoder.encode(["the old barn"])[0] == np.array(reference_ids("the old barn").ids, "<u4").tobytes()


def test_planes_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2 ** int(rng.integers(1, 33)), n, dtype=np.uint64).astype("<u4")
        assert planes.from_planes(planes.to_planes(ids), n).tolist() == ids.tolist()
    stream = io.BytesIO()
    writer = planes.Writer(stream, block=16)
    docs = [(1, 0), (None, 5), (3, 200), (4, 16)]
    parts = [rng.integers(0, 70_000, n, dtype=np.uint32).astype("<u4").tobytes() for _, n in docs]
    for (doc, _), ids in zip(docs, parts):
        writer.add(doc, ids)
    writer.close()
    assert list(planes.Reader(stream)) == [(d, n, zlib.crc32(p)) for (d, n), p in zip(docs, parts)]


def test_token_output_equals_brute_force(spark, odd, empty):
    got = [tuple(r) for r in planes.token_output(odd).orderBy("start").collect()]
    at, want = 0, []
    for doc, text in sorted(((r[0], r[1] or "") for r in ODD), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = np.array([*reference_ids(text).ids, 0], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert planes.token_output(empty).count() == 0


#: Fields of seven characters with gaps of two. A lambda, so that workers get it by value.
fields = lambda text: [(f"f{k % 3}", at, min(at + 7, len(text))) for k, at in enumerate(range(0, len(text), 9))]


def section_rows(text, sections, rule):
    """Tokens per section name, one token and one character at a time."""
    owner = ["rest"] * len(text)
    place = [-1] * len(text)  # a gap is a section of its own
    for k, (name, start, end) in enumerate(sections(text)):
        owner[start:end], place[start:end] = [name] * (end - start), [k] * (end - start)
    gaps = 0
    for i in range(len(text)):
        if place[i] == -1:
            gaps -= i == 0 or place[i - 1] >= 0
            place[i] = gaps - 1
    counts, crossing, total = Counter({"rest": 0}), 0, 0
    for start, end in reference_ids(text).offsets:
        inside = Counter(place[start:end])
        crossing += len(inside) > 1
        total += 1
        if rule == "split":
            for i in range(start, end):
                counts[owner[i]] += 1 / (end - start)
        elif rule == "start":
            counts[owner[start]] += 1
        else:
            most = max(inside.values())
            counts[owner[next(i for i in range(start, end) if inside[place[i]] == most)]] += 1
    chars = Counter(owner)
    return {(name, chars[name], round(n, 6), total, crossing) for name, n in counts.items()} | {
        (name, n, round(counts[name], 6), total, crossing) for name, n in chars.items()
    }


@pytest.mark.parametrize("rule", attribution.RULES)
@pytest.mark.parametrize("sections", [attribution.sentences, attribution.head_and_body, fields])
def test_attribution_equals_brute_force(spark, rule, sections):
    texts = [None, "", "One. Two! Three?  Four.\n\nFive", "no end", "A.B. c", "...   ", "é\U0001f600. é  漢字漢字! internationalization", "x" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in attribution.attribute(df, sections=sections, rule=rule).collect():
        got.setdefault(r.doc_id, set()).add((r.section, r.n_chars, round(r.n_tokens, 6), r.doc_tokens, r.crossing))
    assert got == {k: section_rows(t or "", sections, rule) for k, t in enumerate(texts)}


def test_rules_differ_on_the_tables(spark, docs, odd, empty):
    some = docs.where("length(text) < 3000")
    by_rule = {rule: rows_of(attribution.attribute(some, rule=rule), "doc_id", "section", "n_tokens") for rule in attribution.RULES}
    assert len({str(x) for x in by_rule.values()}) == 3
    assert attribution.attribute(some).groupBy("doc_id").agg(F.max("crossing").alias("c")).where("c > 0").count() > 50
    totals = attribution.attribute(odd).groupBy("doc_id").agg(F.sum("n_tokens")).collect()
    texts = Counter()
    for r in ODD:
        texts[r[0]] += len(reference_ids(r[1] or "").ids)
    assert {r[0]: r[1] for r in totals} == {k: float(v) for k, v in texts.items()}
    assert attribution.attribute(empty).count() == 0


# ---- WARC --------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    pages = [(3, "http://a/\r\nX: y", "<p>é"), (1, None, "<p>é"), (2, "http://b/", None), (5, "u", ""), (4, "http://c/ü", "x" * 300_000), (6, "u", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = {r.page_id: tuple(r)[1:] for r in warc.read_archives(warc.write_archives(df)).collect()}
    first = {}
    for page, _, html in sorted(pages):
        first.setdefault(html or "", page)
    for page, _, html in pages:
        body = (html or "").encode()
        revisit = first[html or ""] != page
        want = (len(body), warc.digest_of(body), "revisit" if revisit else "response", first[html or ""] if revisit else None)
        assert got[page] == want
    small = warc.read_archives(warc.write_archives(df, min_bytes=5)).where("record_type = 'revisit'").count()
    assert small == 1  # the empty payloads are both responses now
    assert warc.read_archives(warc.write_archives(df.where("false"))).count() == 0


def test_warc_pages_without_id_spread_by_payload(spark):
    """Many pages of no id and of one repeated id: no more than one revisit meets a row, and no task gathers them."""
    bodies = [f"body {k}" for k in range(40)]
    pages = [(1, "u", b) for b in bodies] + [(None, "u", b) for b in bodies] + [(7, "u", b) for b in bodies]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    read = warc.read_archives(warc.write_archives(df)).collect()
    want = sorted((p or 0, warc.digest_of(b.encode()), "response" if p == 1 else "revisit", None if p == 1 else 1) for p, _, b in pages)
    assert sorted((r.page_id or 0, r.payload_digest, r.record_type, r.refers_to) for r in read) == want
    plans = []
    real = warc.kept
    warc.kept = lambda frame, name: plans.append(frame._jdf.queryExecution().optimizedPlan().toString()) or real(frame, name)
    try:
        warc.write_archives(df)
    finally:
        warc.kept = real
    assert plans and not any("collect_set" in p or "collect_list" in p for p in plans)


# ---- licenses ----------------------------------------------------------------------------


def test_licenses(spark, empty):
    lines = {
        1: ("prose here\nReleased under the MIT License.\n", "MIT"),
        2: ("LICENSED under the Apache-License, version 2.0!", "Apache-2.0"),
        3: ("Licensed under nothing at all", None),
        4: (None, None),
        5: ("", None),
        6: ("License", None),
        7: ("This work is licensed under the GNU General Public License version 3 only", "GPL-3.0"),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in lines.items()], "doc_id long, text string").withColumn("lines", F.lit(1))
    got = {r.doc_id: r.license for r in licenses.scan(df).collect()}
    assert got == {k: v[1] for k, v in lines.items()}
    assert licenses.scan(empty).count() == 0 and licenses.scan(df, templates={}).where("license IS NOT NULL").count() == 0


def test_licenses_in_whole_texts(spark):
    """Whole texts, wrapped and embedded statements, and several licenses of a document."""
    wrapped = "\n".join(f"# {x}" for x in re.sub(r"(\S+ \S+ \S+) ", r"\1\n", licenses.TEMPLATES["MIT"][-1]).splitlines())
    bodies = {name: texts[-1] for name, texts in licenses.TEMPLATES.items() if len(texts[-1]) > 300}
    assert {"AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "MIT", "Unlicense"} <= set(bodies)
    cases = {f"Copyright 2020 A. Person\n\n{text}\n{PROSE}": {name} for name, text in bodies.items()}
    cases |= {
        f"{PROSE}\n{wrapped}\n{PROSE}": {"MIT"},
        "Released under\nthe MIT License.": {"MIT"},
        f"{PROSE} Released under the MIT License. {PROSE}": {"MIT"},
        f"Licensed under CC BY-NC 4.0.\n{PROSE}\nReleased under the MIT License.": {"CC-BY-NC-4.0", "MIT"},
        f"All rights reserved.\n{PROSE}": {licenses.RESERVED},
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means.": {licenses.PROPRIETARY},
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
        f"{PROSE}\nThe license of this work is not known, and permission was not granted.": set(),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [set(got[k].licenses) for k in range(len(cases))] == list(cases.values())
    assert all(got[k].license == min(names, default=None) or len(names) > 1 for k, names in enumerate(cases.values()))


# ---- languages and scores ----------------------------------------------------------------


def test_languages(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred != 'und'")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    found = {r.doc_id: r for r in langid.language_report(odd).collect()}
    assert found[4].lang_pred == found[5].lang_pred == found[7].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in found.values())
    assert langid.language_report(empty).count() == 0


def test_back_off_takes_the_longest_known_order():
    model = langid.Model({"ab": {"x": 0.5}, "cd": {"y": 0.5}}, {"^c": {"y": 0.4}, "c": {"x": 0.9}}, 1e-3)
    assert model.predict("ab")[0] == "x" and model.predict("cz")[0] == "y" and model.predict("12")[0] == "und"


def test_suffix_tree_scores(docs, odd, empty):
    loose = suffix_tree.Shares(word=1e-4, context=1e-3, symbol=2e-4)
    got = {r.doc_id: r for r in suffix_tree.score_report(docs, shares=loose).collect()}
    counts = Counter()
    texts = {r.doc_id: words_of(lowered(r.text)) + [None] for r in docs.collect()}
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d in texts}
    for d, x in texts.items():
        if fold[d] != 2:
            counts.update(x)
    n, v = sum(counts.values()), len(counts)
    for d, x in texts.items():
        r = got[d]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[d] == 2, len(x), sum(w in counts for w in x), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)
    assert suffix_tree.score_report(odd).count() == len(ODD)
    assert suffix_tree.score_report(empty).count() == 0


def test_suffix_tree_distributions_sum_to_one(docs):
    tree, _ = suffix_tree.fit(docs.select(F.col("text").alias("t")), suffix_tree.Shares(word=1e-9, context=2e-3, symbol=2e-4))
    h = len(tree.words)
    every, logs = np.arange(h), np.log10(tree.base)
    first = tree.levels[0]
    assert len(first.states) and len(tree.levels) == 2
    for k in range(min(5, len(first.states))):
        one = suffix_tree._look_up(first, h, np.full(h, k), every, logs)
        # The unknown symbol has the rest of the root's mass.
        unknown = 10 ** first.rest[k] / (tree.total + tree.distinct + 1)
        assert math.isclose((10**one).sum() + unknown, 1, rel_tol=1e-6)


def brute_suffix_tree(texts, train):
    """Scores by a tree of all contexts of one and two words."""
    history = {k: [(*([None] + x)[max(0, i - 1) : i + 1], w) for i, w in enumerate(x)] for k, x in texts.items()}
    counts = Counter(w for k in train for w in texts[k])
    n, v = sum(counts.values()), len(counts)
    listed = {}
    for k in train:
        for *c, w in history[k]:
            for context in {tuple(c), tuple(c[-1:])}:
                listed.setdefault(context, Counter())[w] += 1
    states = {}

    def p(context, w):
        if not context:
            return (counts[w] + 1) / (n + v + 1)
        if context not in states:
            return p(context[1:], w)
        seen, size, weight = states[context]
        return (seen[w] - 0.5) / size if w in seen else weight * p(context[1:], w)

    for context, seen in sorted(listed.items(), key=lambda x: len(x[0])):
        size, short = sum(seen.values()), context[1:]
        if short and short not in states:
            continue
        divergence = sum(c * math.log(c / size / p(short, w)) for w, c in seen.items())
        if divergence > 0.5 * math.log(n) * len(seen):
            states[context] = seen, size, 0.5 * len(seen) / size / (1 - sum(p(short, w) for w in seen))
    return {k: sum(math.log10(p(tuple(c), w)) for *c, w in h) for k, h in history.items()}, states


@pytest.mark.parametrize("size, numbered", [(suffix_tree.BUCKET, suffix_tree.NUMBERED), (40, 0.01)])
def test_suffix_tree_of_all_contexts(spark, docs, size, numbered, monkeypatch):
    """Rare contexts and followers count as well; with buckets of 40 positions, words and pairs are parted."""
    monkeypatch.setattr(suffix_tree, "NUMBERED", numbered)
    some = docs.select("doc_id", "text").orderBy("doc_id").limit(25).collect()
    rows = [(r.doc_id, r.text) for r in some] + [(10_000 + k, "Of the " * 30 + f"w{k % 3} of the x") for k in range(12)]
    rows += [(20_000, None), (20_001, ""), (20_002, "unseen0 of unseen1")] + [(30_000 + k, "same start " + "z" * k) for k in range(60)]
    texts = {d: words_of(lowered(t)) + [None] for d, t in rows}
    train = [d for d in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    want, states = brute_suffix_tree(texts, train)
    assert {len(c) for c in states} == {1, 2}
    got = {r.doc_id: r for r in suffix_tree.score_report(spark.createDataFrame(rows, "doc_id long, text string"), size=size).collect()}
    counts = Counter(w for d in train for w in texts[d])
    n, v = sum(counts.values()), len(counts)
    assert got.keys() == texts.keys()
    for d, x in texts.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(w in counts for w in x), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x), rel_tol=1e-9)
        assert math.isclose(r.score, want[d], rel_tol=1e-7), d


def test_whole_suffix_tree_of_odd_texts(odd, empty):
    got = suffix_tree.score_report(odd)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in ODD)
    assert suffix_tree.score_report(empty).count() == 0
    alone = suffix_tree.score_report(odd.where("doc_id = 1"), folds=1, held_out=0).first()
    assert (alone.n_known, alone.train_tokens, alone.base_score, alone.score) == (0, 0, 0, 0)


def shuffle_bytes(spark):
    """Bytes of the files of every shuffle that is still there, by its number."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = Counter()
    for i in range(files.size()):
        if name := re.fullmatch(r"shuffle_(\d+)_.*", files.apply(i).getName()):
            found[int(name[1])] += files.apply(i).length()
    return found


def test_whole_suffix_tree_shuffles_little(spark, monkeypatch):
    """Positions travel packed, and symbols without a number meet their counts where they are listed, without a join."""
    monkeypatch.setattr(suffix_tree, "NUMBERED", 2e-5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    df = suffix_tree.score_report(docs, size=50_000)
    last = max(shuffle_bytes(spark))
    rows = df.collect()  # while `df` lives, so do the files of its shuffles
    new = {k: n for k, n in shuffle_bytes(spark).items() if k > last}
    assert sum(new.values()) < 13 * sum(r.n_tokens for r in rows), new


def test_followers_are_listed_once_with_their_counts():
    """In portions by symbol; those after a split word go by that word, whose pairs of more than `size` positions are hot."""
    hashed = lambda x: suffix_tree.symbols(pa.RecordBatch.from_pydict({"t": [x]}))[0][:-1]
    the, fox, owl = (int(hashed(w)[0]) for w in ("the", "fox", "owl"))
    numbered = np.sort(np.array([0, the]))
    plan = suffix_tree.Dealing(99, 4, numbered, np.array([1, 0]), np.array([50, 40]), 5, np.array([the]), np.array([2]), (3, 2))
    texts = ["the fox " * 3 + "owl fox", "the the owl", "a fox"]
    batch = pa.RecordBatch.from_pydict({"t": texts, "train": [True, True, False]})
    parts = pa.Table.from_batches(list(suffix_tree._noted(iter([batch, batch]), plan)))
    schema = pa.schema([("place", pa.int64()), *[(c, pa.binary()) for c in "asnc"], ("hot", pa.list_(pa.int64()))])
    found = {}
    for portion in set(parts["portion"].to_pylist()):
        merged = suffix_tree._merged(parts.filter(pa.array(parts["portion"].to_numpy() == portion)), plan, 5, schema)
        lists = [suffix_tree._unpack_ascending(merged["s"]), *(suffix_tree._unpack(merged[c], "<i8") for c in "nc")]
        for place, hot, s, n, c in zip(merged["place"].to_pylist(), merged["hot"].to_pylist(), *lists):
            assert hot == ([fox] if place == -1 and fox in s else [])
            for key, *values in zip(s.tolist(), n.tolist(), c.tolist()):
                assert (place, key) not in found
                found[place, key] = tuple(values)
    bucket = lambda w: int(plan.first(hashed(w))[0])
    start = int(plan.first(np.array([0]))[0])
    want = {(-1, fox): (6, 8), (-1, owl): (2, 4), (-1, the): (2, 0), (bucket("owl"), fox): (0, 8), (bucket("fox"), owl): (0, 4)}
    want |= {(start, int(hashed("a")[0])): (0, 0), (bucket("a"), fox): (0, 8)}
    assert found == want


def test_positions_are_dealt_with_their_histories(monkeypatch):
    """A chunk of many batches is one row per bucket, and every position has the two words before it, whatever the slices."""
    texts = ["", "the fox the fox the owl", None, "the", "a fox a fox", "the the the", ""]
    batches = [
        pa.RecordBatch.from_pydict({"id": [2 * k, 2 * k + 1], "t": pa.array(texts[k : k + 2], pa.string()), "train": [k % 2 == 0, True]})
        for k in range(len(texts) - 1)
    ]
    histories = [suffix_tree._histories(b) for b in batches]
    the = int(histories[1][2][0])
    numbered = np.sort(np.array([0, the]))
    counts = np.where(numbered == the, 50, 40)
    count = {"the": 50, None: 40}
    words = [words_of(x or "") + [None] for k in range(len(texts) - 1) for x in texts[k : k + 2]]
    plan = suffix_tree.Dealing(99, 4, numbered, np.argsort(np.argsort(-counts)), np.sort(counts)[::-1], 3, np.array([the]), np.array([2]), (1, 1))
    packs = [(c, pa.binary()) for c in ("a", "b", "s", "text", "listed", "hashes")]
    head = [("id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base_score", pa.list_(pa.float64()))]
    schema = pa.schema([("bucket", pa.int64()), *packs, ("start", pa.int64()), *head])
    want = Counter()
    for k, (a, b, s, text) in enumerate(histories):
        want.update(zip(a.tolist(), b.tolist(), s.tolist(), (2 * k + text).tolist(), suffix_tree._train(batches[k])[text].tolist()))
    for slice_ in (suffix_tree._SLICE, 5, 1):
        monkeypatch.setattr(suffix_tree, "_SLICE", slice_)
        got = pa.Table.from_batches(list(suffix_tree._dealt(iter(batches), plan, schema)))
        assert len(set(got["bucket"].to_pylist())) == got.num_rows <= 3
        word = np.empty(2, np.int64)
        word[plan.numbers] = plan.words
        found = Counter()
        columns = (suffix_tree._unpack(got[c]) for c in ("a", "b", "s", "text", "listed"))
        for a, b, s, text, listed, hashes in zip(*columns, suffix_tree._unpack_ascending(got["hashes"])):
            all_words = np.concatenate([word, hashes])
            rows = [all_words[x].tolist() for x in (a, listed[b], s)]
            found.update(zip(*rows, np.cumsum(text >> 1).tolist(), (text & 1).astype(bool).tolist()))
        assert found == want
        first = got.slice(0, 1).to_pylist()[0]
        assert first["n_tokens"] == [len(x) for x in words]
        assert first["n_known"] == [sum(w in count for w in x) for x in words]
        base = [sum(math.log10((count.get(w, 0) + 1) / 104) for w in x) for x in words]
        assert np.allclose(first["base_score"], base, rtol=1e-12)


# ---- queries -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_covers_its_table(spark, name):
    table = "pages" if name.startswith("op6") else "documents"
    key = "page_id" if name.startswith("op6") else "doc_id"
    assert QUERIES[name](spark, SF).select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = quality.quality_filter(docs).select("doc_id", "text").collect()
    text_of = {r.doc_id: r.text for r in good}
    single = {c for _, n, c in brute_components(list(text_of.items()), 5, 80)} if good else set()
    clean = {d for d in single if not brute_hits(text_of[d], bench)[4]}
    want = Counter({r.doc_id: r.copies for r in mixing.mix_report(docs.where(F.col("doc_id").isin(sorted(clean)))).collect() if r.copies})
    rows = got.orderBy("start").collect()
    assert Counter(r.doc_id for r in rows) == want
    at = 0
    for r in rows:
        ids = np.array([*reference_ids(text_of[r.doc_id]).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
