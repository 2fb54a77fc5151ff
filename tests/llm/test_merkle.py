"""The Merkle manifest against a tree built by recursion, over many shapes of groups."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from idlink.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = [None if row[c] is None else str(row[c]) for c in COLUMNS]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def lowered(row):
    text = row["text"]
    return row | {"text": text and text.translate({i: i + 32 for i in range(65, 91)})}


def climb(nodes, fanout):
    """Root of the nodes, and for each of them the runs above it with its place in them."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            steps[k].append((i % fanout, runs[i // fanout]))
            at[k] = i // fanout
        nodes = [digest("".join(r)) for r in runs]
    return nodes[0], steps


def brute(rows, fanout=8):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = [climb([leaf_of(r) for r in groups[g]], fanout) for g in order]
    root, upper = climb([t[0] for t in trees], fanout)
    out = []
    for g, (subroot, steps), above in zip(order, trees, upper):
        for r, own in zip(groups[g], steps):
            path = own + above
            proof = digest("".join(x for at, run in path for k, x in enumerate(run) if k != at))
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf_of(lowered(r) if hit else r)
            for at, run in path:
                node = digest("".join(run[:at] + [node] + run[at + 1 :]))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def frame(spark, rows):
    clash = {c: F.lit("x") for c in ("id", "group", "leaf", "g", "slot", "at", "n", "task", "rank", "run", "other")}
    return spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA).withColumns(clash)


def sized(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Plain Text", "lower only", f"Ümlaut {rng.random()}"])
            rows.append({"doc_id": len(rows), "text": text, "lang": lang, "source": rng.choice([None, "s1"]), "n_chars": rng.choice([None, 7])})
    rng.shuffle(rows)
    return rows


SHAPES = [
    ({"en": 1}, 8, 1),
    ({None: 1, "en": 9, "é": 64, "zz": 65}, 8, 1),
    ({"en": 700, "de": 3, None: 130}, 3, 2),
    ({f"l{i:02d}": 1 + 7 * (i % 4) for i in range(11)} | {"big": 200}, 3, 1),
    ({"a": 33, "b": 32, "c": 31, "d": 1, "e": 2}, 2, 1),
]


@pytest.mark.parametrize("sizes, fanout, levels", SHAPES)
def test_report_equals_recursion(spark, sizes, fanout, levels):
    rows = sized(sizes)
    tree = merkle.build(frame(spark, rows), other=merkle.tampered_leaf(COLUMNS), fanout=fanout, levels=levels)
    assert sorted((tuple(r) for r in tree.verify_report().collect()), key=str) == brute(rows, fanout)
    assert tree.partitions.count() == sum(-(-n // fanout**levels) for n in sizes.values())


def test_production_parameters_and_odd_rows(spark):
    rows = sized({"en": 40, None: 5})
    for k, r in enumerate(rows[:9]):
        r["doc_id"] = [None, 3, 3][k % 3]
    rows += [dict(rows[0]), dict(rows[5]), rows[7] | {"text": "Long " * 60_000}]
    got = merkle.manifest_report(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert {r.verified for r in got} == {True, False}


def test_empty_table(spark):
    df = frame(spark, sized({"en": 2})).where("false")
    assert merkle.manifest_report(df).collect() == []
    assert merkle.build(df).proofs().collect() == []


def test_proofs_prove_and_find_changes(spark):
    rows = sized({"en": 30, "de": 5})
    tree = merkle.build(frame(spark, rows), fanout=2, levels=2)
    for r in tree.proofs().collect():
        node, wrong = r.leaf, digest("x")
        for step in r.proof:
            node = digest("".join([*step.before, node, *step.after]))
            wrong = digest("".join([*step.before, wrong, *step.after]))
        assert node == r.root != wrong
    assert all(r.verified for r in tree.verify_report().collect())
