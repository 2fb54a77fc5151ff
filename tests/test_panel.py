"""Membership panel against a literal per-row evaluation."""

from __future__ import annotations

import calendar
import datetime as dt
import random

import pytest

from idlink.operators import panel, quality
from idlink.operators.snapshots import dedup_date_ric, month_fallback, month_snapshots, month_spine, monthly_counts
from idlink.plans.panel import build_grid, build_panel
from idlink.sources.conform import clean_constituents, load_master

MASTER = (
    "permno long, gvkey string, namedt date, nameendt date, linkdt date, linkenddt date, comnam string, ticker string, "
    "exch string, ncusip string, cusip string, linkprim string, linktype string, linkprim_score int, linktype_rank int, "
    "overlap_days int, cusip6_match int, is_primary_permno boolean, is_common boolean"
)
MEMBERS = "Date date, RIC string, ISIN string, CUSIP string, Ticker string, row_id long"


def random_master(rng, n):
    rows = []
    used = set()
    while len(rows) < n:
        start = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(900))
        end = start + dt.timedelta(days=rng.randrange(1, 900))
        permno = rng.randrange(40)
        if (permno, start) in used:
            continue
        used.add((permno, start))
        link = None if rng.random() < 0.15 else start - dt.timedelta(days=rng.randrange(-60, 200))
        cusip = f"10000{rng.randrange(6)}10"
        rows.append(
            (permno, None if rng.random() < 0.1 else f"{rng.randrange(12):06d}", start, end, link, None, f"N{permno}",
             rng.choice([None, "T0", "T1", "T2"]), "NYSE", rng.choice([None, cusip]), rng.choice([cusip, f"10000{rng.randrange(6)}101"]),
             "P", "LU", rng.randrange(2), rng.randrange(3), rng.randrange(0, 900), rng.randrange(2),
             rng.random() < 0.4, rng.random() < 0.5)
        )
    return rows


def random_members(rng, n):
    rows = []
    for i in range(n):
        date = dt.date(2000, 1 + rng.randrange(12), 1) + dt.timedelta(days=rng.choice([0, 10, 27]))
        date = date.replace(year=2000 + rng.randrange(3))
        cusip = rng.choice([None, "Z99999103", f"10000{rng.randrange(8)}103"])
        rows.append((date, f"R{i}.N", None, cusip, rng.choice([None, "t0", "T1", "T5"]), i))
    return rows


def month_end(d):
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def f1(m):
    whole = m.is_primary_permno * 10000 + m.is_common * 1000 + m.cusip6_match * 100 + m.linkprim_score * 10 + m.linktype_rank * 5
    return whole + m.overlap_days / 365.0


def f2(m):
    return m.linkprim_score * 100 + m.linktype_rank * 10 + m.overlap_days / 365.0


def literal(members, master, score_single=False):
    last = {}
    for m in members:
        last[month_end(m.date)] = max(m.date, last.get(month_end(m.date), m.date))
    out = {}
    for c in members:
        day = month_end(c.date)
        if c.date != last[day]:
            continue
        valid = [m for m in master if m.linkdt and m.namedt <= day < m.nameendt and m.linkdt <= day < m.linkenddt]
        by_cusip = [m for m in valid if c.cusip6 is not None and c.cusip6 in (m.ncusip6, m.cusip6_link)]
        by_ticker = [m for m in valid if c.ticker_key is not None and m.ticker == c.ticker_key]
        found, kind = (by_cusip, "CUSIP6") if by_cusip else (by_ticker, "TICKER")
        if not found:
            out[c.row_id] = (day, "UNMATCHED", "NO_MATCH", None, None, 0.0)
            continue
        firms = {m.gvkey for m in found}
        several = len(firms) > 1
        fn = f2 if several else f1
        seen = {g: min((m.permno, m.namedt) for m in found if m.gvkey == g) for g in firms}
        best = min(found, key=lambda m: (m.gvkey is None, -fn(m), seen[m.gvkey], m.permno, m.namedt, m.nameendt))
        rank = fn(best) if len(found) > 1 or score_single else 0.0
        out[c.row_id] = (day, kind, "PRIMARY" if best.is_primary_permno else "SECONDARY", best.gvkey, best.permno, round(rank, 6))
    return out


@pytest.mark.parametrize("seed, score_single", [(1, False), (2, False), (3, True)])
def test_best_segment_equals_literal_loop(spark, seed, score_single):
    rng = random.Random(seed)
    master = load_master(spark.createDataFrame(random_master(rng, 80), MASTER).repartition(3)).cache()
    members = clean_constituents(spark.createDataFrame(random_members(rng, 150), MEMBERS), keep=["row_id"]).cache()
    best = panel.panel_best(month_snapshots(members), master, score_single=score_single).collect()
    got = {r.row_id: (r.date, r.match_type, r.permno_type, r.gvkey, r.permno, round(r.rank_score, 6)) for r in best}
    want = literal(members.collect(), master.collect(), score_single)
    assert got == want
    assert {v[1] for v in want.values()} == {"CUSIP6", "TICKER", "UNMATCHED"}


def test_panel_keeps_unmatched_rows_unless_told_otherwise(spark):
    rng = random.Random(7)
    master = spark.createDataFrame(random_master(rng, 60), MASTER)
    members = spark.createDataFrame(random_members(rng, 200), MEMBERS)
    full = build_panel(members, master).cache()
    collapsed = build_panel(members, master, collapse_unmatched=True).cache()
    assert full.columns == panel.PANEL_COLUMNS
    firm = "gvkey IS NOT NULL"
    assert sorted(map(str, full.where(firm).collect())) == sorted(map(str, collapsed.where(firm).collect()))
    assert full.where(firm).groupBy("date", "gvkey").count().where("count > 1").count() == 0
    assert collapsed.groupBy("date", "gvkey").count().where("count > 1").count() == 0
    assert full.where("gvkey IS NULL").count() > collapsed.where("gvkey IS NULL").count()
    assert quality.check_panel_duplicates(collapsed).first()[0] == 0
    assert quality.check_panel_duplicates(full).first()[0] > 0
    unmatched = full.where("match_type = 'UNMATCHED'").first()
    assert (unmatched.ticker_crsp, unmatched.company_name, unmatched.exchange, unmatched.rank_score) == ("", "", "", 0.0)


def one_segment(**change):
    row = dict(
        permno=1, gvkey="000001", namedt=dt.date(2000, 1, 1), nameendt=dt.date(2000, 3, 31), linkdt=dt.date(1999, 1, 1), linkenddt=None,
        comnam="N", ticker="T", exch="NYSE", ncusip="10000010", cusip="100000101", linkprim="P", linktype="LU", linkprim_score=1,
        linktype_rank=2, overlap_days=90, cusip6_match=1, is_primary_permno=True, is_common=True,
    )
    row.update(change)
    return tuple(row.values())


def members_on(spark, *days):
    rows = [(d, "T.N", None, "100000103", "T", i) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, MEMBERS)


def test_segment_ending_on_the_snapshot_day_is_out(spark):
    master = spark.createDataFrame([one_segment()], MASTER)
    rows = build_panel(members_on(spark, dt.date(2000, 2, 3), dt.date(2000, 3, 3)), master).orderBy("date").collect()
    assert [r.match_type for r in rows] == ["CUSIP6", "UNMATCHED"]


def test_segment_without_link_never_matches(spark):
    master = spark.createDataFrame([one_segment(linkdt=None)], MASTER)
    assert build_panel(members_on(spark, dt.date(2000, 2, 3)), master).first().match_type == "UNMATCHED"


def test_lone_candidate_scores_zero_and_loses_the_firm_to_a_ranked_one(spark):
    both = [one_segment(), one_segment(permno=2, ncusip="20000010", cusip="200000101", is_primary_permno=False)]
    third = one_segment(permno=3, ncusip="20000010", cusip="200000101", is_primary_permno=False)
    master = spark.createDataFrame([*both, third], MASTER)
    day = dt.date(2000, 2, 3)
    members = spark.createDataFrame(
        [(day, "A.N", None, "100000103", None, 0), (day, "B.N", None, "200000103", None, 1)], MEMBERS
    )
    row = build_panel(members, master).collect()
    assert len(row) == 1
    assert row[0].permno == 2 and row[0].rank_score > 0


def test_segment_counts_once_when_both_cusips_agree(spark):
    master = load_master(spark.createDataFrame([one_segment()], MASTER))
    snaps = month_snapshots(clean_constituents(members_on(spark, dt.date(2000, 2, 3)), keep=["row_id"]))
    assert panel.panel_best(snaps, master).first().n_candidates == 1


def test_null_firm_sorts_last(spark):
    master = spark.createDataFrame([one_segment(gvkey=None, overlap_days=9000), one_segment(permno=2)], MASTER)
    row = build_panel(members_on(spark, dt.date(2000, 2, 3)), master).first()
    assert (row.gvkey, row.permno) == ("000001", 2)


def test_grid_takes_december_and_looks_back_only(spark):
    master = spark.createDataFrame([one_segment(nameendt=dt.date(2005, 1, 1))], MASTER)
    table = build_panel(members_on(spark, dt.date(2000, 11, 3), dt.date(2000, 12, 5), dt.date(2001, 12, 5)), master)
    rows = build_grid(table).orderBy("formation_date").collect()
    assert [r.formation_date for r in rows] == [dt.date(2000, 12, 31), dt.date(2001, 12, 31)]
    r = rows[0]
    assert (r.constituency_year, r.prediction_year, r.esg_baseline_year, r.esg_outcome_year, r.esg_knowledge_year) == (
        2000, 2001, 1999, 2000, 1999,
    )


def test_snapshots_keep_all_rows_of_the_last_date(spark):
    days = [dt.date(2000, 1, 3), dt.date(2000, 1, 28), dt.date(2000, 1, 28), dt.date(2000, 2, 1)]
    snaps = month_snapshots(clean_constituents(members_on(spark, *days), keep=["row_id"]))
    assert sorted(r.row_id for r in snaps.collect()) == [1, 2, 3]
    assert {r.snapshot_date for r in snaps.collect()} == {dt.date(2000, 1, 31), dt.date(2000, 2, 29)}


def test_fallback_fills_missing_months_only(spark):
    d = dt.date
    first = spark.createDataFrame([(d(2000, 1, 31), "A", "I")], "date date, ric string, isin string")
    second = spark.createDataFrame([(d(2000, 1, 15), "B"), (d(2000, 2, 15), "C")], "date date, ric string")
    rows = month_fallback(first, second).orderBy("ric").collect()
    assert [(r.ric, r.isin) for r in rows] == [("A", "I"), ("C", None)]


def test_month_spine_and_counts(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(dt.date(2000, 1, 15), "a"), (dt.date(2000, 3, 30), "a")], "date date, ric string")
    spine = [r.month_end for r in month_spine(frame, F.min("date"), F.max("date")).orderBy("month_end").collect()]
    assert spine == [dt.date(2000, 1, 31), dt.date(2000, 2, 29)]
    assert {r.month_end: r.n_members for r in monthly_counts(frame).collect()} == {
        dt.date(2000, 1, 31): 1,
        dt.date(2000, 3, 31): 1,
    }


def test_first_row_per_date_and_instrument(spark):
    rows = [(dt.date(2000, 1, 3), "aa.N", 2), (dt.date(2000, 1, 3), "aa.N", 1), (dt.date(2000, 1, 4), "aa.N", 3)]
    frame = spark.createDataFrame(rows, "date date, ric string, row_id long")
    out = dedup_date_ric(frame, ["row_id"]).orderBy("date").collect()
    assert [(r.row_id, r.ticker) for r in out] == [(1, "AA"), (3, "AA")]
