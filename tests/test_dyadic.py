"""Date blocks, touching pairs and winner envelopes against plain loops and against pairs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idlink.operators import dyadic, panel, segments
from idlink.operators.cascade import TICKER
from idlink.operators.snapshots import month_snapshots
from idlink.sources.conform import clean_constituents, load_master
from idlink.sources.sinks import stored
from tests.test_panel import MASTER, MEMBERS, literal, random_master, random_members
from tests.test_segments import CASES, brute_best, frames, random_input

DAY0 = dt.date(2000, 1, 1)


def test_a_range_and_a_day_within_share_one_block(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(65), rng.randrange(65), rng.randrange(64)) for _ in range(400)]
    rows += [(a, b, x) for a in (0, 1, 31, 32, 63, 64) for b in (0, 1, 32, 63, 64) for x in (0, 31, 32, 63)]
    df = spark.createDataFrame(rows, "low int, high int, day int")
    blocks = F.size(F.array_intersect(dyadic.range_blocks("low", "high", 6), dyadic.day_blocks("day", 6)))
    whole = F.size(dyadic.range_blocks("low", "high", 6))
    for r in df.withColumns({"shared": blocks, "blocks": whole}).collect():
        assert r.shared == int(r.low <= r.day < r.high), r
        assert r.blocks <= 12


def test_all_dates_have_a_number(spark):
    df = spark.sql("SELECT DATE'0001-01-01' AS a, DATE'9999-12-31' AS b")
    low, high = df.select(dyadic.day_number(F.col("a")), dyadic.day_number(F.col("b"))).first()
    assert low == 0 and high + 1 < 1 << dyadic.LEVELS


def pair_frames(spark, left, right):
    a = spark.createDataFrame(left, "k int, i int, s date, e date")
    b = spark.createDataFrame(right, "k int, j int, t date, u date")
    return a, b


def joined_pairs(spark, left, right):
    a, b = pair_frames(spark, left, right)
    return sorted((r.i, r.j) for r in dyadic.touching_pairs(a, b, ["k"], ("s", "e"), ("t", "u")).collect())


def plain_pairs(left, right):
    return sorted(
        (i, j) for k, i, s, e in left for m, j, t, u in right if k == m and k is not None and None not in (s, e, t, u) and s <= u and e >= t
    )


def random_ranges(rng, n, span, keys):
    out = []
    for i in range(n):
        start = rng.randrange(span)
        end = start + rng.randrange(-5, span // 3)
        dates = [None if rng.random() < 0.05 else DAY0 + dt.timedelta(days=d) for d in (start, end)]
        out.append((rng.choice(keys), i, *dates))
    return out


def test_touching_pairs_equal_a_loop(spark):
    rng = random.Random(11)
    left, right = (random_ranges(rng, 150, 200, [1, 1, 1, 2, None]) for _ in range(2))
    found = joined_pairs(spark, left, right)
    assert found == plain_pairs(left, right) and len(found) > 1000


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([3, 20]))
def test_touching_pairs_on_few_days(spark, seed, span):
    rng = random.Random(seed)
    left, right = (random_ranges(rng, 25, span, [1, 2]) for _ in range(2))
    assert joined_pairs(spark, left, right) == plain_pairs(left, right)


def test_only_touching_pairs_are_made(spark):
    """10,000 short ranges and as many links of one security: the join makes the pairs that touch, not 100 million."""
    n = 10_000
    days = spark.range(n).select(F.lit(7).alias("k"), F.col("id").cast("int").alias("i"))
    a = days.select("k", "i", F.date_add(F.lit(DAY0), F.col("i") * 2).alias("s"), F.date_add(F.lit(DAY0), F.col("i") * 2 + 2).alias("e"))
    b = a.select("k", F.col("i").alias("j"), F.col("s").alias("t"), F.col("e").alias("u"))
    assert dyadic.touching_pairs(a, b, ["k"], ("s", "e"), ("t", "u")).count() == 3 * n - 2


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_ranges_of_a_key_are_not_cut_into_blocks(spark):
    rng = random.Random(12)
    left, right = (random_ranges(rng, 400, 200, range(40)) for _ in range(2))
    a, b = pair_frames(spark, left, right)
    pairs = dyadic.touching_pairs(a, b, ["k"], ("s", "e"), ("t", "u"))
    plan = executed_plan(pairs)
    assert "Generate" not in plan and "Broadcast" not in plan
    assert sorted((r.i, r.j) for r in pairs.collect()) == plain_pairs(left, right)


def test_blocks_are_never_broadcast(spark):
    """Spark takes ranges for as large as before they were cut into blocks, and used to send them to the driver."""
    rng = random.Random(13)
    a, b = pair_frames(spark, *(random_ranges(rng, 300, 200, [1, 1, 1, 2]) for _ in range(2)))
    for df in (dyadic.touching_pairs(a, b, ["k"], ("s", "e"), ("t", "u")), dyadic.touching_pairs(a, b, ["k"], ("s", "e"), ("t", "u"), 0)):
        joins = [line for line in executed_plan(df).splitlines() if "Join" in line and "_block" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)


@pytest.mark.parametrize("case", list(CASES)[1:], ids=list(CASES)[1:])
def test_crowded_securities_have_the_same_best_links(spark, case):
    names, links = random_input(*CASES[case])
    n, l = frames(spark, names, links)
    best = segments.best_links(n, l, order_by=("src",), stage=stored(spark, "links"), paired=2).collect()
    got = {
        (r.permno, r.namedt, r.nameendt): (
            r.gvkey, r.linkdt, r.linkenddt, r.cusip, r.linkprim, r.linktype, r.overlap_days, r.cusip6_match, r.src,
        )
        for r in best
    }
    assert len(best) == len(got) and got == brute_best(names, links)
    by_class = [
        sorted(str(r) for r in segments.segment_links(n, l, ("src",), stage=stored(spark, "links"), paired=paired).collect()) for paired in (2, 10**9)
    ]
    assert by_class[0] == by_class[1]


@pytest.mark.parametrize("seed, score_single, paired", [(1, False, 0), (2, True, 0), (3, False, 9)])
def test_envelope_equals_literal_loop(spark, seed, score_single, paired):
    rng = random.Random(seed)
    master = load_master(spark.createDataFrame(random_master(rng, 90), MASTER).repartition(3)).cache()
    members = clean_constituents(spark.createDataFrame(random_members(rng, 150), MEMBERS), keep=["row_id"]).cache()
    best = panel.panel_best(month_snapshots(members), master, score_single=score_single, paired=paired).collect()
    got = {r.row_id: (r.date, r.match_type, r.permno_type, r.gvkey, r.permno, round(r.rank_score, 6)) for r in best}
    assert got == literal(members.collect(), master.collect(), score_single)


def hot_segments(spark, n, firms):
    """Segments of one ticker, overlapping at random, with many equal scores."""
    number = F.col("id")
    start = F.date_add(F.lit(DAY0), F.pmod(F.xxhash64("id"), F.lit(15_000)).cast("int"))
    length = (F.pmod(F.xxhash64(number + 1), F.lit(400)) + 1).cast("int")
    h = F.pmod(F.xxhash64(number + 2), F.lit(1000))
    return spark.range(n).select(
        F.lit(TICKER).alias("key_kind"),
        F.lit("HOT").alias("key"),
        start.alias("valid_from"),
        F.date_add(start, length).alias("valid_to"),
        start.alias("namedt"),
        F.date_add(start, length).alias("nameendt"),
        F.when(h % 11 > 0, F.lpad((h % firms).cast("string"), 6, "0")).alias("gvkey"),
        number.alias("permno"),
        F.lit("HOT").alias("ticker"),
        F.lit("N").alias("comnam"),
        (h % 2 == 0).alias("is_primary_permno"),
        (h % 3 == 0).alias("is_common"),
        F.lit("NYSE").alias("exch"),
        F.lit("P").alias("linkprim"),
        F.lit("LU").alias("linktype"),
        (h % 5).cast("double").alias("permno_score"),
        (h % 4).cast("double").alias("gvkey_score"),
    )


def test_hot_key_needs_no_pairs(spark):
    """10,000 segments and 500 dates of one key: rows grow with segments plus dates, and the winners stay."""
    n, firms = 10_000, 700
    rows = hot_segments(spark, n, firms).cache()
    needs = spark.range(500).select(
        F.lit(TICKER).alias("key_kind"), F.lit("HOT").alias("key"), F.last_day(F.add_months(F.lit(DAY0), F.col("id").cast("int"))).alias("snapshot_date")
    )
    pieces = panel.firm_pieces(rows).cache()
    assert pieces.count() <= 2 * n
    order = ["key_kind", "key", "snapshot_date"]
    picked = ["n_candidates", "n_firms", "_by_firm.permno", "_by_security.permno"]
    envelope, pairs = (
        [tuple(r) for r in f(rows, needs).select(*order, *[F.col(c).alias(f"c{i}") for i, c in enumerate(picked)]).orderBy(*order).collect()]
        for f in (panel._by_envelope, panel._by_pairs)
    )
    assert envelope == pairs and len(envelope) > 450
    assert max(r[4] for r in envelope) > 50


def test_gathered_firms_have_the_pieces_of_blocks(spark):
    rows = hot_segments(spark, 600, 12).unionByName(hot_segments(spark, 90, 80).withColumn("key", F.lit("COLD"))).cache()
    found = [sorted(str(r) for r in panel.firm_pieces(rows, listed=n).collect()) for n in (0, 30, 10**6)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 500


def test_firms_with_few_segments_are_not_cut_into_blocks(spark):
    """Before, blocks of all firms were made, and sent to the driver."""
    plan = executed_plan(panel.firm_pieces(hot_segments(spark, 600, 100)))
    assert "_block" not in plan and "Broadcast" not in plan
    joins = [line for line in executed_plan(panel.firm_pieces(hot_segments(spark, 600, 2))).splitlines() if "Join" in line and "_block" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def any_day_needs(spark, keys, days):
    return spark.createDataFrame([(TICKER, k, DAY0 + dt.timedelta(days=d)) for k in keys for d in days], "key_kind string, key string, snapshot_date date")


def by_date(df):
    picked = ["n_candidates", "n_firms", "_by_firm.permno", "_by_security.permno"]
    return sorted(tuple(r) for r in df.select("key", "snapshot_date", *[F.col(c).alias(f"c{i}") for i, c in enumerate(picked)]).collect())


@pytest.mark.parametrize("days", [[700], [0, 1, 2, 16_000], [-5, 365, 366, 800, 801, 4000, 14_999, 15_500], list(range(3000, 3400, 3))])
def test_envelope_equals_pairs_on_any_days(spark, days):
    rows = hot_segments(spark, 1500, 60).unionByName(hot_segments(spark, 40, 3).withColumn("key", F.lit("COLD"))).cache()
    needs = any_day_needs(spark, ["HOT", "ABSENT"], days).unionByName(any_day_needs(spark, ["COLD"], days[:2]))
    assert by_date(panel._by_envelope(rows, needs)) == by_date(panel._by_pairs(rows, needs))


def test_envelope_takes_segments_valid_on_asked_dates_only(spark, monkeypatch):
    rows = hot_segments(spark, 2000, 60).unionByName(hot_segments(spark, 500, 3).withColumn("key", F.lit("UNASKED"))).cache()
    day, seen, pieces = DAY0 + dt.timedelta(days=700), [], panel.firm_pieces
    monkeypatch.setattr(panel, "firm_pieces", lambda segments, *a: seen.append(segments) or pieces(segments, *a))
    panel._by_envelope(rows, any_day_needs(spark, ["HOT"], [700])).collect()
    valid = rows.where((F.col("key") == "HOT") & (F.col("valid_from") <= F.lit(day)) & (F.col("valid_to") > F.lit(day))).count()
    assert 0 < seen[0].count() == valid < 300


def test_pieces_of_a_firm_do_not_overlap(spark):
    pieces = panel.firm_pieces(hot_segments(spark, 300, 5)).select("key", "gvkey", "day", "until").collect()
    by_firm = {}
    for r in pieces:
        by_firm.setdefault(r.gvkey, []).append((r.day, r.until))
    assert None in by_firm and len(by_firm) == 6
    for found in by_firm.values():
        found.sort()
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:])) and all(a < b for a, b in found)
