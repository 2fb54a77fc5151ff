"""Product codes against plain Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idlink.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """By the definition, with unlimited integers: rows (id, code, error, label_error, digest)."""
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not good:
        return []
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    width = len(good[0][1]) // parts
    cut = [[[math.floor(256 * float(np.float32(x))) for x in v[p * width : (p + 1) * width]] for p in range(parts)] for _, v, _ in good]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], c)), k) for k, c in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [x[p] for x, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    sums = {}
    for (_, _, label), e in zip(good, errors):
        sums[label] = sums.get(label, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, sums[label], digest) for (i, _, label), f, e in zip(good, found, errors)), key=str)


def frame(spark, rows):
    clash = {c: F.lit("x") for c in ("id", "v", "code", "error", "label_error", "part", "entry", "n", "total")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clash)


def random_rows(n, seed, scale=1.0, length=32):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, length))
    v = (centers[rng.integers(0, 5, n)] + rng.normal(scale=0.3, size=(n, length))) * scale
    return [(int(i), [float(x) for x in row.astype(np.float32)], int(i) % 3 or None) for i, row in zip(rng.permutation(n), v)]


@pytest.mark.parametrize("n, scale", [(40, 1.0), (300, 0.2), (150, 30000.0)])
def test_report_equals_brute_force(spark, n, scale):
    rows = random_rows(n, n, scale)
    rows += [rows[0], rows[1][:2] + (None,)]  # repeated rows
    got = vc.code_report(frame(spark, rows).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    rows = random_rows(70, 3, length=16)
    good = rows[0][1]
    rows += [
        (1000, None, 1),
        (1001, [], 1),
        (1002, [None, *good[1:]], 1),
        (1003, [float("nan"), *good[1:]], 1),
        (-5, [float("-inf"), *good[1:]], 2),
        (1004, good + good, 2),  # another length
        (None, good, 2),
        (1005, good, None),
    ]
    got = vc.code_report(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert {r.vec_id for r in got} >= {None, 1005} and not {r.vec_id for r in got} & {1000, 1001, 1002, 1003, 1004, -5}


def test_empty_and_all_dropped(spark):
    df = frame(spark, random_rows(3, 1))
    assert vc.code_report(df.where("false")).collect() == []
    assert vc.code_report(frame(spark, [(1, None, 1), (2, [None], 1)])).collect() == []


def test_what_cannot_be_told_fails_with_a_message(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vc.code_report(frame(spark, [(1, [1.0] * 17, 0)]))
    with pytest.raises(Exception, match="would not fit a long"):
        vc.code_report(frame(spark, [(1, [1e9] * 16, 0), (2, [0.0] * 16, 0)])).collect()


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_products_are_exact(data):
    width = data.draw(st.integers(1, 9))
    top = vc.limit(16 * width) - 1
    number = st.one_of(st.integers(-top, top), st.sampled_from([-top, top, 0, -1, 1 << 24, -(1 << 24)]))
    n, m = data.draw(st.integers(1, 6)), data.draw(st.integers(1, 5))
    row = st.lists(number, min_size=width, max_size=width)
    x = np.array(data.draw(st.lists(row, min_size=n, max_size=n)), np.int64)
    c = np.array(data.draw(st.lists(row, min_size=m, max_size=m)), np.int64)
    bits = data.draw(st.sampled_from([None, 3, 8, vc.limb_bits(width)]))
    want = [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in c] for r in x]
    assert vc.exact_dot(x, c, bits).tolist() == want
    code, distance = vc.nearest(x[None], c[None], bits)
    best = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)), k) for k, s in enumerate(c)) for r in x]
    assert [(int(d), int(k)) for d, k in zip(distance[0], code[0])] == best


def test_limbs_stay_exact():
    for width in (1, 4, 5, 64, 1000):
        bits = vc.limb_bits(width)
        assert width << (2 * bits) < vc.EXACT
    x = np.array([[-(1 << 40) - 1, 5, -1, (1 << 40) + 3]])
    parts = vc.limbs(x, 8)
    assert sum(p.astype(np.int64) << (8 * k) for k, p in enumerate(parts)).tolist() == x.tolist()
    assert all(-256 <= p.min() and p.max() < 256 for p in parts)
