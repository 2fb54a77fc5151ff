"""Segment linking and primary selection against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from idlink.operators import primary, segments
from idlink.schemas import LINKS, NAMES
from idlink.sources.conform import clean_links, clean_names

DAY0 = dt.date(2000, 1, 1)
SCORES = {"P": 1, "C": 1, "J": 0, "N": 0}
TYPES = {"LU": 2, "LC": 1, "NR": 0}


def day(n: int) -> dt.date:
    return DAY0 + dt.timedelta(days=n)


def random_input(seed: int, n_names: int, n_links: int, permnos: list[int], span: int, cusips: int):
    rng = random.Random(seed)
    names, links = [], []
    for i in range(n_names):
        start = rng.randrange(span)
        end = start + rng.randrange(-3, span // 2)
        cusip = None if rng.random() < 0.1 else f"{rng.randrange(cusips):06d}10"
        names.append((rng.choice(permnos), day(start), day(end), cusip, rng.choice([10, 12, None]), rng.choice([1, 2, 3]), i))
        if rng.random() < 0.2:
            names.append((*names[-1][:3], f"{rng.randrange(cusips):06d}10", 11, 2, n_names + i))
    for _ in range(n_links):
        start = rng.randrange(span)
        end = start + rng.randrange(-3, span)
        gvkey = None if rng.random() < 0.1 else f"{rng.randrange(30):06d}"
        cusip = None if rng.random() < 0.1 else f"{rng.randrange(cusips):06d}101"
        links.append((rng.choice(permnos), gvkey, day(start), day(end), cusip, rng.choice("PCJN"), rng.choice(list(TYPES))))
    return names, links


def frames(spark, names, links, partitions=4):
    n = spark.createDataFrame(names, "permno long, namedt date, nameendt date, ncusip string, shrcd int, exchcd int, src int")
    l = spark.createDataFrame(links, "permno long, gvkey string, linkdt date, linkenddt date, cusip string, linkprim string, linktype string")
    return clean_names(n.repartition(partitions), keep=["src"]), clean_links(l.repartition(partitions))


def last(value):
    return (value is None, value)


def brute_best(names, links):
    """(permno, namedt, nameendt) -> best (link fields, source row), one pair at a time."""
    out = {}
    for permno, start, end, ncusip, shrcd, exchcd, src in names:
        c6 = ncusip[:6] if ncusip else None
        found = []
        for lp, gvkey, ls, le, cusip, prim, kind in links:
            if lp != permno or not (start <= le and end >= ls):
                continue
            overlap = max(0, (min(end, le) - max(start, ls)).days)
            same = int(c6 is not None and cusip is not None and cusip[:6] == c6)
            order = (-SCORES[prim], -TYPES[kind], -same, -overlap, ls, last(gvkey), le, last(cusip), prim, kind, src)
            found.append((order, (gvkey, ls, le, cusip, prim, kind, overlap, same, src)))
        if not found:
            found.append((((1,) * 10) + (src,), (None, None, None, None, None, None, 0, 0, src)))
        best = min(found, key=lambda f: f[0])
        key = (permno, start, end)
        if key not in out or best[0] < out[key][0]:
            out[key] = best
    return {k: v[1] for k, v in out.items()}


CASES = {
    "many securities": (1, 120, 150, list(range(12)), 400, 6),
    "one hot security": (2, 150, 400, [7, 7, 7, 7, 8], 300, 4),
    "hot security, every CUSIP different": (3, 100, 300, [7], 200, 200),
    "same days again and again": (4, 150, 200, [1, 2], 12, 3),
}


@pytest.mark.parametrize("case", CASES, ids=list(CASES))
def test_best_links_equal_brute_force(spark, case):
    names, links = random_input(*CASES[case])
    n, l = frames(spark, names, links)
    rows = segments.best_links(n, l, order_by=("src",)).collect()
    got = {
        (r.permno, r.namedt, r.nameendt): (
            r.gvkey, r.linkdt, r.linkenddt, r.cusip, r.linkprim, r.linktype, r.overlap_days, r.cusip6_match, r.src,
        )
        for r in rows
    }
    assert len(rows) == len(got)
    assert got == brute_best(names, links)


def test_staging_changes_nothing(spark):
    from idlink.sources.sinks import stored

    names, links = random_input(8, 90, 150, [1, 2, 3], 100, 30)
    n, l = frames(spark, names, links)
    plain = segments.best_links(n, l, order_by=("src",)).collect()
    staged = segments.best_links(n, l, order_by=("src",), stage=stored(spark, "links")).collect()
    assert sorted(map(str, plain)) == sorted(map(str, staged))


def test_result_does_not_depend_on_partitioning(spark):
    names, links = random_input(5, 80, 120, [1, 2, 3], 100, 3)
    results = []
    for seed, partitions in ((0, 1), (1, 7)):
        random.Random(seed).shuffle(names)
        random.Random(seed).shuffle(links)
        n, l = frames(spark, names, links, partitions)
        results.append(sorted(map(str, segments.best_links(n, l, order_by=("src",)).collect())))
    assert results[0] == results[1]


def test_links_of_one_class_shrink_to_one_per_day(spark):
    """However many links a security has, at most one per end date competes."""
    rows = [(1, f"{i % 900:06d}", day(i % 40), day(60 + i % 40), f"{i:06d}101", "P", "LU") for i in range(3000)]
    _, links = frames(spark, [(1, day(0), day(9), "00000010", 10, 1, 0)], rows)
    kept = segments.undominated_links(links, ["permno", "linkprim_score", "linktype_rank"])
    assert kept.count() <= 40
    ends = [r.linkenddt for r in kept.orderBy("linkdt", "gvkey").collect()]
    assert ends == sorted(set(ends))


def brute_primary(rows):
    stats = {}
    for r in rows:
        if r.gvkey is None:
            continue
        s = stats.setdefault((r.gvkey, r.permno), [False, 0, 0, 0])
        s[0] |= bool(r.is_common)
        s[1] = max(s[1], r.linkprim_score)
        s[2] = max(s[2], r.linktype_rank)
        s[3] += max(0, (r.nameendt - r.namedt).days)
    firms, perms = {}, {}
    for g, p in stats:
        firms.setdefault(g, set()).add(p)
        perms.setdefault(p, set()).add(g)
    one = {(g, p) for g, p in stats if len(firms[g]) == 1 and len(perms[p]) == 1}
    best = {}
    for g, ps in firms.items():
        best[g] = min(ps, key=lambda p: (not stats[g, p][0], (g, p) not in one, -stats[g, p][1], -stats[g, p][2], -stats[g, p][3], p))
    return best, one


def test_primary_selection_and_one_to_one(spark):
    names, links = random_input(6, 200, 260, list(range(25)), 300, 5)
    n, l = frames(spark, names, links)
    linked = segments.with_flags(segments.best_links(n, l, order_by=("src",)))
    best, one = brute_primary(linked.collect())
    mapped = primary.primary_map(linked)
    assert {r.gvkey: r.primary_permno for r in mapped.collect()} == best
    stats = primary.pair_statistics_with_degree(linked).collect()
    assert {(r.gvkey, r.permno) for r in stats if r.one2one} == one
    master = primary.with_primary(linked, mapped)
    for r in master.collect():
        assert r.primary_permno == best.get(r.gvkey)
        assert r.is_primary_permno == (None if r.gvkey is None else r.permno == best[r.gvkey])
    assert master.count() == linked.count()
    table = primary.primary_table(master)
    assert {r.gvkey: r.primary_permno for r in table.collect()} == best


def test_links_without_a_firm_can_win(spark):
    names = [(1, day(0), day(99), "00000010", 10, 1, 0)]
    links = [(1, None, day(0), day(99), None, "P", "LU"), (1, "000007", day(0), day(99), None, "J", "LU")]
    n, l = frames(spark, names, links)
    row = segments.best_links(n, l, order_by=("src",)).first()
    assert row.gvkey is None and row.linkprim == "P"


def test_clean_inputs(spark):
    raw = spark.createDataFrame(
        [("1.0", "2001-01-01", "E", " abc ", "12345678"), ("2", "bad", "2002-01-01", "x", "1"), ("x", "20010101", None, "y", "2")],
        "PERMNO string, `Date` string, NAMEENDT string, Ticker string, NCUSIP string",
    )
    rows = clean_names(raw).collect()
    assert [(r.permno, r.namedt, r.nameendt, r.ticker, r.ncusip6) for r in rows] == [
        (1, dt.date(2001, 1, 1), dt.date(2262, 4, 11), " ABC ", "123456")
    ]
    assert clean_names(raw).columns[: len(NAMES.columns)] == NAMES.columns
    raw = spark.createDataFrame([("5", "77.0", None, "E", "p")], "LPERMNO string, GVKEY string, linkdt string, LINKENDDT string, linkprim string")
    row = clean_links(raw).first()
    assert (row.permno, row.gvkey, row.linkdt, row.linkenddt, row.linkprim_score, row.linktype_rank) == (
        5, "000077", dt.date(1900, 1, 1), dt.date(2262, 4, 11), 1, 0,
    )
    assert set(LINKS.columns) <= set(clean_links(raw).columns)


def test_flags(spark):
    df = spark.createDataFrame([(10, 1), (12, 9), (None, None)], "shrcd int, exchcd int")
    rows = segments.with_flags(df).select(F.struct("is_common", "exch").alias("s")).collect()
    assert [tuple(r.s) for r in rows] == [(True, "NYSE"), (False, None), (False, None)]
