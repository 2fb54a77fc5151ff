"""Provider matching against literal pass-by-pass matching; crosswalks and consolidation."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from idlink.operators import cascade, crosswalk, reports
from idlink.operators.cascade import PROVIDER_A, PROVIDER_B, PROVIDER_C, Pass, ProviderSpec
from idlink.plans import mapping
from idlink.schemas import FAR_FUTURE
from idlink.sources.conform import clean_provider_a, clean_provider_c, load_master

MASTER = (
    "permno long, gvkey string, namedt date, nameendt date, ticker string, ncusip string, shrcd int, exchcd int, "
    "linkprim_score int, linktype_rank int, primary_permno long, is_common boolean, is_primary_permno boolean"
)
POINTS = {"CUSIP6": 5, "ISIN_CUSIP6": 4, "ISIN": 6, "TICKER": 3}


def random_master(rng, n, cusips=8, tickers=6):
    rows = []
    for _ in range(n):
        start = dt.date(1995, 1, 1) + dt.timedelta(days=rng.randrange(2500))
        end = None if rng.random() < 0.15 else start + dt.timedelta(days=rng.randrange(-5, 1500))
        gvkey = None if rng.random() < 0.2 else f"{rng.randrange(20):06d}"
        permno = rng.randrange(30)
        cusip = None if rng.random() < 0.1 else f"10000{rng.randrange(cusips)}10"
        ticker = None if rng.random() < 0.1 else f"T{rng.randrange(tickers)}"
        rows.append(
            (permno, gvkey, start, end, ticker, cusip, 10, rng.choice([1, 2, 3, None]), rng.randrange(2), rng.randrange(3),
             permno, rng.random() < 0.5, rng.choice([True, False, None]))
        )
    return rows


def load(spark, rows):
    return load_master(spark.createDataFrame(rows, MASTER).repartition(3)).cache()


def score(m, points, overlap):
    exchange = 1 if m.exchcd in (1, 3) else 0
    return points + 3 * m.is_common + 2 * m.is_primary_permno + exchange + min(3, overlap // 365) + m.linkprim_score + m.linktype_rank


def nulls_last(v):
    return (v is None, v)


def literal(provider, master, spec, entity):
    """Match, keep the best, drop the matched, go on with the next pass."""
    if spec.prefilter:
        wanted = {p["cusip6_from_isin"] for p in provider} - {None}
        master = [m for m in master if m.ncusip6 in wanted]
    out = {}
    for step in spec.passes:
        found = defaultdict(list)
        for p in provider:
            key = (p[entity], p["year"])
            if p[step.key] is None or key in out:
                continue
            for m in master:
                if (m.ncusip6 if step.kind == "C" else m.ticker) != p[step.key]:
                    continue
                days = (min(p["valid_to"], m.nameendt) - max(p["valid_from"], m.namedt)).days
                if days <= 0:
                    continue
                s = score(m, POINTS[step.label], days)
                order = (-s, -days, not m.is_primary_permno, not m.is_common, nulls_last(m.exchcd), m.namedt, m.permno,
                         m.nameendt, nulls_last(m.ncusip6), nulls_last(m.ticker))
                found[key].append((order, (step.label, s, days, m.permno, m.gvkey, m.namedt, m.nameendt)))
        for key, candidates in found.items():
            out[key] = min(candidates, key=lambda c: c[0])[1]
    return out


def got(matches, entity):
    rows = matches.collect()
    out = {
        (r[entity], r["year"]): (r.match_src, r.match_score, r.overlap_days, r.permno, r.gvkey, r.namedt, r.nameendt) for r in rows
    }
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_provider_a_equals_pass_by_pass(spark, seed):
    rng = random.Random(seed)
    master = load(spark, random_master(rng, 120))
    rows = []
    for i in range(150):
        cusip = rng.choice([None, f"10000{rng.randrange(10)}103"])
        isin = rng.choice([None, f"US10000{rng.randrange(10)}1035", f"GB10000{rng.randrange(10)}1035"])
        rows.append((f"E{i % 40}", str(1994 + i // 20), cusip, isin, f"n{i}"))
    raw = spark.createDataFrame(rows, "OrgPermID string, Year string, cusip string, isin string, comname string")
    provider = clean_provider_a(raw).cache()
    matches = cascade.match_provider(provider, master, PROVIDER_A)
    want = literal(provider.collect(), master.collect(), PROVIDER_A, "orgpermid")
    assert got(matches, "orgpermid") == want and want
    assert matches.columns == PROVIDER_A.output
    assert {"CUSIP6", "ISIN_CUSIP6"} == {v[0] for v in want.values()}
    left = cascade.unmatched_after(provider, matches, "orgpermid")
    assert left.count() == provider.count() - len(want)


@pytest.mark.parametrize("prefilter", [True, False])
def test_provider_c_with_and_without_prefilter(spark, prefilter):
    rng = random.Random(9)
    master = load(spark, random_master(rng, 120))
    rows = [
        (f"t{rng.randrange(6)}" + rng.choice(["", ".L"]), 800000000000 + i * 4000000000, rng.choice([None, None, f"US10000{rng.randrange(4)}1035"]), 1.5)
        for i in range(120)
    ]
    raw = spark.createDataFrame(rows, "symbol string, periodEndDate long, isin string, Environmental double")
    provider = clean_provider_c(raw).cache()
    spec = ProviderSpec("c", "symbol", PROVIDER_C.passes, PROVIDER_C.columns, "ticker", prefilter)
    want = literal(provider.collect(), master.collect(), spec, "symbol")
    assert got(cascade.match_provider(provider, master, spec), "symbol") == want and want
    assert {"ISIN", "TICKER"} == {v[0] for v in want.values()}


def test_segments_without_a_firm_block_later_passes(spark):
    day = dt.date(2000, 1, 1)
    base = (day, None, "X", "10000010", 10, 1, 0, 0, 1, True, True)
    other = (day, None, "Y", "20000010", 10, 1, 0, 0, 2, True, True)
    master = load(spark, [(1, None, *base), (2, "000002", *other)])
    raw = spark.createDataFrame([("E", "2001", "100000103", "US2000001035")], "orgpermid string, year string, cusip string, isin string")
    matches = cascade.match_provider(clean_provider_a(raw), master, PROVIDER_A)
    row = matches.first()
    assert (row.match_src, row.gvkey, row.permno) == ("CUSIP6", None, 1)
    assert crosswalk.crosswalk(matches, "orgpermid").count() == 0


def test_no_match_gives_an_empty_table_with_all_columns(spark):
    master = load(spark, random_master(random.Random(3), 5))
    raw = spark.createDataFrame([("E", "2001", "999999103")], "orgpermid string, year string, cusip string")
    matches = cascade.match_provider(clean_provider_a(raw), master, PROVIDER_A)
    assert matches.count() == 0 and matches.columns == PROVIDER_A.output
    assert crosswalk.crosswalk(matches, "orgpermid").count() == 0


def test_load_master_derives_missing_columns(spark):
    raw = spark.createDataFrame(
        [("7", "123.0", "2000-01-01", None, " 12345678 ", "12", "7"), ("8", "9", None, None, "1", "10", "7")],
        "PERMNO string, gvkey string, namedt string, nameendt string, ncusip string, shrcd string, primary_permno string",
    )
    rows = load_master(raw).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.gvkey, row.ncusip6, row.is_common, row.is_primary_permno, row.linkprim_score) == ("000123", "123456", True, True, 0)
    assert row.nameendt == dt.date.fromisoformat(FAR_FUTURE)


MATCH = "e string, year int, gvkey string, permno long, match_score int, overlap_days int, namedt date, nameendt date"


def test_crosswalk_modal_security_and_ties(spark):
    d = dt.date
    rows = [
        ("A", 2000, "1", 5, 9, 100, d(1999, 1, 1), d(2001, 1, 1)),
        ("A", 2001, "1", 6, 9, 200, d(2000, 1, 1), d(2002, 1, 1)),
        ("A", 2002, "2", 7, 18, 365, d(2000, 1, 1), d(2003, 1, 1)),
        ("B", 2000, None, 7, 99, 1, d(2000, 1, 1), d(2001, 1, 1)),
        ("C", 2000, "9", 1, 5, 10, d(2000, 1, 1), d(2001, 1, 1)),
        ("C", 2001, "8", 1, 5, 10, d(2000, 1, 1), d(2001, 1, 1)),
    ]
    out = {r.e: r for r in crosswalk.crosswalk(spark.createDataFrame(rows, MATCH), "e").collect()}
    assert set(out) == {"A", "C"}
    a = out["A"]
    assert (a.gvkey, a.total_score, a.years_covered, a.max_overlap_days, a.primary_permno) == ("1", 18, 2, 200, 5)
    assert (a.first_seen, a.last_seen) == (d(1999, 1, 1), d(2002, 1, 1))
    assert out["C"].gvkey == "8"


def test_a_failing_provider_does_not_stop_the_others(spark):
    master = load(spark, random_master(random.Random(4), 40))
    raw = spark.createDataFrame([("E", "1997", "100001103", None)], "orgpermid string, year string, cusip string, isin string")

    def broken():
        raise OSError("no such file")

    sources = [
        mapping.Source(PROVIDER_B, broken),
        mapping.Source(PROVIDER_A, lambda: clean_provider_a(raw)),
        mapping.Source(PROVIDER_C, broken, enabled=False),
    ]
    done, failed = mapping.map_all(sources, master)
    assert set(done) == {"provider_a"} and set(failed) == {"provider_b"}
    table = mapping.consolidated(done)
    assert table.columns == crosswalk.CONSOLIDATED_COLUMNS
    assert table.where("provider <> 'provider_a'").count() == 0


def test_a_new_provider_is_only_a_spec(spark):
    master = load(spark, random_master(random.Random(5), 60))
    spec = ProviderSpec("d", "code", (Pass("TICKER", "tick", "T"),), ())
    rows = [(f"X{i}", 1996 + i % 5, f"T{i % 6}") for i in range(30)]
    from idlink.sources.conform import with_year_window

    provider = with_year_window(spark.createDataFrame(rows, "code string, year int, tick string")).cache()
    want = literal(provider.collect(), master.collect(), spec, "code")
    assert got(cascade.match_provider(provider, master, spec), "code") == want and want


def test_firm_overlap_reports(spark):
    def firms(*keys):
        return spark.createDataFrame([(k, 2000) for k in keys], "gvkey string, year int")

    by = {"a": firms("1", "2", "2", None), "b": firms("2", "3"), "c": firms("2", "3", "4")}
    assert [r.gvkey for r in reports.gvkey_common(by).collect()] == ["2"]
    pairs = {(r.provider_1, r.provider_2): r.n_shared for r in reports.gvkey_pairwise(by).collect()}
    assert pairs == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 2}
    assert {(r.gvkey, r.provider) for r in reports.gvkey_exclusive(by).collect()} == {("1", "a"), ("4", "c")}


def test_pairwise_counts_of_many_providers(spark):
    rng = random.Random(8)
    sets = {f"p{i:02d}": {f"{rng.randrange(90_000):06d}" for _ in range(rng.choice([0, 5, 400]))} for i in range(24)}
    sets["p00"] = set()
    rows = [(p, k) for p, keys in sets.items() for k in keys] + [("p00", None), ("p01", None)]
    long = spark.createDataFrame(rows * 2, "provider string, gvkey string").repartition(5)
    got = {(r.provider_1, r.provider_2): r.n_shared for r in reports.gvkey_pairwise(long).collect()}
    named = sorted({p for p, _ in rows})
    assert got == {(a, b): len(sets[a] & sets[b]) for i, a in enumerate(named) for b in named[i + 1 :]}
    by_name = {p: long.where(f"provider = '{p}'") for p in named}
    assert {(r.provider_1, r.provider_2): r.n_shared for r in reports.gvkey_pairwise(by_name).collect()} == got
    assert sum(got.values()) > 0


def test_a_thousand_providers_plan_in_seconds(spark):
    import time

    one = spark.createDataFrame([("000001", 2000)], "gvkey string, year int")
    begun = time.time()
    few = reports.gvkey_pairwise({f"p{i}": one for i in range(3)})._jdf.queryExecution().executedPlan().toString()
    long = spark.range(1000).selectExpr("concat('p', id) AS provider", "'000001' AS gvkey")
    wide = reports.gvkey_pairwise(long)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == few.count("Exchange")
    assert time.time() - begun < 30
    assert wide.agg({"n_shared": "sum"}).first()[0] == 1000 * 999 // 2
