"""As-of join of index members to the master, and the monthly panel.

As in the provider cascade, the winner depends only on (kind of key, key, date). Distinct
(kind, key, date) needs are joined to the master, every need is aggregated to its best
segment, and the members look the result up. Keys with many segments have a winner envelope
instead of pairs of segments and dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idlink.functions import dates, scores
from idlink.operators import dyadic
from idlink.operators.cascade import CUSIP6, TICKER
from idlink.operators.ranking import asc, desc, keep_first
from idlink.operators.skew import counted, crowded_keys, spread_join

PANEL_COLUMNS = [
    "date", "ticker_sp500", "cusip_sp500", "gvkey", "permno", "ticker_crsp", "company_name",
    "match_type", "permno_type", "is_primary", "is_common", "exchange", "linkprim", "linktype",
    "rank_score", "year", "month", "year_month", "esg_knowledge_year",
]
GRID_COLUMNS = [
    "gvkey", "permno", "ticker_crsp", "company_name", "constituency_year", "formation_year",
    "prediction_year", "formation_date", "esg_baseline_year", "esg_outcome_year",
    "esg_knowledge_year", "match_type", "permno_type", "is_primary", "is_common", "exchange",
    "linkprim", "linktype",
]

_PAYLOAD = ["gvkey", "permno", "ticker", "comnam", "is_primary_permno", "is_common", "exch", "linkprim", "linktype"]
_NEED = ["key_kind", "key", "snapshot_date"]
_PLACE = ["permno", "namedt", "nameendt"]
#: Segments of a key up to which its dates are paired with them.
PAIRED = 2048
#: Segments of a firm under a key up to which they are gathered in one row.
LISTED = 64
#: Parts in which the firms of a key are dealt out.
FIRM_PARTS = 64


def panel_keys(master: DataFrame) -> DataFrame:
    """(key_kind, key) per segment: both CUSIP6 columns count once, plus the ticker.

    `valid_from` and `valid_to` are the intersection of name and link validity; segments
    without a link have none and drop out.
    """
    cusips = F.array_distinct(F.array("ncusip6", "cusip6_link"))
    keys = F.concat(
        F.transform(cusips, lambda c: F.struct(F.lit(CUSIP6).alias("key_kind"), c.alias("key"))),
        F.array(F.struct(F.lit(TICKER).alias("key_kind"), F.col("ticker").alias("key"))),
    )
    overlap = F.col("overlap_days")
    return (
        master.where("linkdt IS NOT NULL")
        .withColumns({"valid_from": F.greatest("namedt", "linkdt"), "valid_to": F.least("nameendt", "linkenddt")})
        .where("valid_from < valid_to")
        .select(
            F.explode(keys).alias("_k"),
            "valid_from",
            "valid_to",
            "namedt",
            "nameendt",
            *_PAYLOAD,
            scores.permno_rank_score(
                *[F.col(c) for c in ("is_primary_permno", "is_common", "cusip6_match")],
                F.col("linkprim_score"), F.col("linktype_rank"), overlap,
            ).alias("permno_score"),
            scores.gvkey_rank_score(F.col("linkprim_score"), F.col("linktype_rank"), overlap).alias("gvkey_score"),
        )
        .select("_k.key_kind", "_k.key", "*")
        .drop("_k")
        .where("key IS NOT NULL AND key <> ''")
    )


def key_needs(snapshots: DataFrame) -> DataFrame:
    """Distinct (key_kind, key, snapshot_date) the members ask for."""
    keys = F.array(
        F.struct(F.lit(CUSIP6).alias("key_kind"), F.col("cusip6").alias("key")),
        F.struct(F.lit(TICKER).alias("key_kind"), F.col("ticker_key").alias("key")),
    )
    exploded = snapshots.select("snapshot_date", F.explode(keys).alias("_k"))
    return exploded.select("_k.key_kind", "_k.key", "snapshot_date").where("key IS NOT NULL").distinct()


def _by_pairs(segments: DataFrame, needs: DataFrame) -> DataFrame:
    """Per need: n_candidates, n_firms and the winners by either score, from pairs of segments and dates.

    Both levels are partial aggregates, so a popular key shrinks before it is shuffled.
    """
    valid = dates.covers(F.col("valid_from"), F.col("valid_to"), F.col("snapshot_date"))
    candidates = spread_join(segments, needs, ["key_kind", "key"], ["permno", "namedt"], "inner", valid)
    payload = F.struct(*_PAYLOAD, "permno_score", "gvkey_score")
    per_firm = candidates.groupBy(*_NEED, "gvkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(payload, F.struct(-F.col("gvkey_score"), *_PLACE)).alias("_by_firm"),
        F.min_by(payload, F.struct(-F.col("permno_score"), *_PLACE)).alias("_by_security"),
        F.min(F.struct("permno", "namedt")).alias("_first_seen"),
    )
    firm_order = F.struct(F.col("gvkey").isNull(), -F.col("_by_firm.gvkey_score"), F.col("_first_seen"))
    return per_firm.groupBy(*_NEED).agg(
        F.sum("_n").alias("n_candidates"),
        F.count(F.lit(1)).alias("n_firms"),
        F.min_by("_by_firm", firm_order).alias("_by_firm"),
        F.min_by("_by_security", firm_order).alias("_by_security"),
    )


def _firm_keys() -> dict[str, Column]:
    return {"_firm": F.coalesce("gvkey", F.lit("")), "_none": F.col("gvkey").isNull()}


def _offer(score: Column, segment: Column, *place: Column) -> Column:
    """A segment with what it is ranked by: the score, then its place."""
    return F.struct((-score).alias("order"), *[p.alias(c) for p, c in zip(place, _PLACE)], segment.alias("segment"))


def firm_pieces(segments: DataFrame, low: str | None = None, high: str | None = None, listed: int = LISTED) -> DataFrame:
    """What a firm has to offer under a key, between the days on which that changes.

    Rows (key_kind, key, gvkey, day, until): the number of the firm's segments valid then, the first of
    them by either score and the first by security. Scores do not depend on the date, so these change only
    where a segment begins or ends. `low` and `high` name integer columns to take instead of the days of
    `valid_from` and `valid_to`.

    A firm's up to `listed` segments under a key are gathered in one row, so they are shuffled once and no wider than
    they are. Firms with more are counted first; theirs are added up per dyadic block, and every such day
    merges the blocks above it: rows grow with the segments, times the levels of the blocks.
    """
    days = {n: F.col(c) if c else dyadic.day_number(F.col(d)) for n, c, d in (("_low", low, "valid_from"), ("_high", high, "valid_to"))}
    ranges = segments.withColumns({**_firm_keys(), **days})
    keys = ["key_kind", "key", *_firm_keys()]
    crowd = crowded_keys(ranges, keys, listed)
    if crowd is None:
        pieces = _listed_pieces(ranges, keys)
    else:
        few = _listed_pieces(ranges.join(crowd, keys, "left_anti"), keys)
        pieces = few.unionByName(_block_pieces(spread_join(ranges, crowd, keys, ["permno", "namedt"]), keys))
    gvkey = F.when(~F.col("_none"), F.col("_firm")).alias("gvkey")
    return pieces.select("key_kind", "key", "day", "until", "n", "by_firm", "by_security", "first_seen", gvkey)


def _listed_pieces(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Firms lie together by key and part, so that a task has few keys, and later steps shrink within it."""
    part = F.pmod(F.xxhash64("_firm"), F.lit(FIRM_PARTS)).cast("int")
    segment = F.struct(*_PAYLOAD, "permno_score", "gvkey_score").alias("segment")
    firms = (
        ranges.withColumn("_part", part)
        .repartition("key_kind", "key", "_part")
        .groupBy("key_kind", "key", "_part", *keys[2:])
        .agg(F.collect_list(F.struct("_low", "_high", "namedt", "nameendt", segment)).alias("_s"))
    )
    bounds = F.flatten(F.transform("_s", lambda x: F.array(x["_low"], x["_high"])))
    cut = firms.withColumn("_days", F.array_sort(F.array_distinct(bounds)))
    valid = lambda day: F.filter("_s", lambda x: (x["_low"] <= day) & (x["_high"] > day))
    piece = lambda day, i: F.struct(day.alias("day"), F.get("_days", i + 1).alias("until"), valid(day).alias("valid"))
    pieces = cut.select(*keys, F.explode(F.transform(F.slice("_days", F.lit(1), F.size("_days") - 1), piece)).alias("_p"))
    first = lambda f: F.array_min(F.transform("_p.valid", f))
    offer = lambda score: lambda x: _offer(x["segment"][score], x["segment"], x["segment"]["permno"], x["namedt"], x["nameendt"])
    return pieces.where(F.size("_p.valid") > 0).select(
        *keys,
        "_p.day",
        "_p.until",
        F.size("_p.valid").cast("long").alias("n"),
        first(offer("gvkey_score")).alias("by_firm"),
        first(offer("permno_score")).alias("by_security"),
        first(lambda x: F.struct(x["segment"]["permno"].alias("permno"), x["namedt"].alias("namedt"))).alias("first_seen"),
    )


def _block_pieces(ranges: DataFrame, keys: list[str]) -> DataFrame:
    payload, place = F.struct(*_PAYLOAD, "permno_score", "gvkey_score"), [F.col(c) for c in _PLACE]
    blocks = (
        dyadic.in_ranges(ranges, "_low", "_high")
        .groupBy(*keys, dyadic.BLOCK)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(_offer(F.col("gvkey_score"), payload, *place)).alias("by_firm"),
            F.min(_offer(F.col("permno_score"), payload, *place)).alias("by_security"),
            F.min(F.struct("permno", "namedt")).alias("first_seen"),
        )
    )
    # At most one row per day and firm under a key, however many segments there are.
    days = ranges.select(*keys, F.explode(F.array("_low", "_high")).alias("day")).distinct()
    days = days.withColumn("until", F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))).where("until IS NOT NULL")
    found = dyadic.block_join(dyadic.on_day(days, "day"), blocks, keys)
    return found.groupBy(*keys, "day", "until").agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("by_firm", "by_security", "first_seen")]
    )


def _date_ranks(needs: DataFrame) -> DataFrame:
    """(day, rank) for every day from the first to after the last date asked for: the number of asked dates before it.

    Dates reach from 1677 to 2262, so there are at most 213,658 such days: a proven bound for the broadcasts, and for the
    window over the dates alone.
    """
    dates_asked = needs.select(dyadic.day_number(F.col("snapshot_date")).alias("day")).distinct()
    order = Window.orderBy("day")
    ranked = dates_asked.select(
        F.coalesce(F.lag("day").over(order) + 1, "day").alias("_since"), "day", F.lead("day").over(order).alias("_next"), F.row_number().over(order).alias("_n")
    )
    until = F.when(F.col("_next").isNull(), F.col("day") + 1).otherwise(F.col("day"))
    days = ranked.select("day", "_n", F.explode(F.sequence("_since", until)).alias("_d"))
    return days.select(F.col("_d").alias("day"), (F.col("_n") - (F.col("_d") <= F.col("day")).cast("int")).alias("rank"))


def _by_envelope(segments: DataFrame, needs: DataFrame) -> DataFrame:
    """As `_by_pairs`, without pairs: the pieces of all firms are added up per block again, and a date
    merges the blocks above it. A firm has one piece on a day, so pieces count firms.

    Days are counted in dates asked for here, so blocks are few, and segments valid on none of them drop out.
    """
    kinds = ["key_kind", "key"]
    days = needs.withColumn("_day", dyadic.day_number(F.col("snapshot_date")))
    span = days.groupBy(*kinds).agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
    span = counted(span) or span
    ranges = segments.withColumns({"_low": dyadic.day_number(F.col("valid_from")), "_high": dyadic.day_number(F.col("valid_to"))})
    held = spread_join(ranges, span, kinds, ["permno", "namedt"], "inner", (F.col("_low") <= F.col("_last")) & (F.col("_high") > F.col("_first")))
    held = held.withColumns({"_low": F.greatest("_low", "_first"), "_high": F.least("_high", F.col("_last") + 1)}).drop("_first", "_last")
    ranks = _date_ranks(needs)
    for c, n in (("_low", "_from"), ("_high", "_to")):
        held = held.join(F.broadcast(ranks.withColumnsRenamed({"day": c, "rank": n})), c).drop(c)
    order = F.struct(F.col("gvkey").isNull().alias("none"), F.col("by_firm.order").alias("score"), "first_seen")
    best = F.struct(order.alias("order"), F.col("by_firm.segment").alias("by_firm"), F.col("by_security.segment").alias("by_security"))
    blocks = (
        dyadic.in_ranges(firm_pieces(held.where("_from < _to"), "_from", "_to"), "day", "until")
        .groupBy(*kinds, dyadic.BLOCK)
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("firms"), F.min(best).alias("best"))
    )
    asked = dyadic.on_day(days.join(F.broadcast(ranks.withColumnRenamed("day", "_day")), "_day"), "rank")
    found = dyadic.block_join(asked, blocks, kinds)
    return (
        found.groupBy(*_NEED)
        .agg(F.sum("n").alias("n_candidates"), F.sum("firms").alias("n_firms"), F.min("best").alias("best"))
        .select(*_NEED, "n_candidates", "n_firms", F.col("best.by_firm").alias("_by_firm"), F.col("best.by_security").alias("_by_security"))
    )


def best_by_key_date(
    master: DataFrame, snapshots: DataFrame, score_single: bool = False, paired: int = PAIRED
) -> DataFrame:
    """Best segment valid on the snapshot date, per need, with its rank score.

    One firm among the candidates: rank by the security score. Several: rank by the firm
    score. A lone candidate keeps score 0 unless `score_single`.

    Keys of up to `paired` segments are paired with their dates, which makes at most that many rows for a
    date. The others get a winner envelope, whose rows grow with segments plus dates. Whether there are
    any such keys is counted first, so the master should be a stored table.
    """
    segments, needs = panel_keys(master), key_needs(snapshots)
    kinds = ["key_kind", "key"]
    popular = crowded_keys(segments, kinds, paired) if paired else None
    if not paired:
        best = _by_envelope(segments, needs)
    elif popular is None:
        best = _by_pairs(segments, needs)
    else:
        few, many = (needs.join(popular, kinds, how) for how in ("left_anti", "left_semi"))
        rest = segments.join(popular, kinds, "left_anti")
        best = _by_pairs(rest, few).unionByName(_by_envelope(segments, many))
    several = F.col("n_firms") > 1
    chosen = F.when(several, F.col("_by_firm")).otherwise(F.col("_by_security"))
    score = F.when(several, chosen["gvkey_score"]).otherwise(chosen["permno_score"])
    return best.withColumn("_best", chosen).select(
        *_NEED,
        "n_candidates",
        "n_firms",
        *[F.col("_best")[c].alias(c) for c in _PAYLOAD],
        (score if score_single else F.when(F.col("n_candidates") == 1, F.lit(0.0)).otherwise(score)).alias("rank_score"),
    )


def panel_best(
    snapshots: DataFrame,
    master: DataFrame,
    row_id: str = "row_id",
    kinds: tuple[str, ...] = (CUSIP6, TICKER),
    score_single: bool = False,
    paired: int = PAIRED,
) -> DataFrame:
    """Every member row with its best segment: by CUSIP6, else by ticker, else none."""
    best = best_by_key_date(master, snapshots, score_single, paired)
    labels = {CUSIP6: "CUSIP6", TICKER: "TICKER"}
    columns = {CUSIP6: "cusip6", TICKER: "ticker_key"}
    found = [c for c in best.columns if c not in _NEED]
    members = snapshots.withColumnsRenamed({"ticker": "ticker_sp500", "cusip": "cusip_sp500"})
    members = members.withColumn("match_type", F.lit(None).cast("string"))
    for i, kind in enumerate(kinds):
        entry = best.where(F.col("key_kind") == kind).select(
            F.col("key").alias("_key"), "snapshot_date", F.struct(*found).alias("_hit")
        )
        wanted = F.when(F.col("match_type").isNull(), F.col(columns[kind])) if i else F.col(columns[kind])
        members = spread_join(members.withColumn("_key", wanted), entry, ["_key", "snapshot_date"], [row_id], "left")
        hit = F.when(F.col("_hit").isNotNull(), F.lit(labels[kind]))
        members = members.withColumns(
            {
                "_found": F.coalesce("_found", "_hit") if i else F.col("_hit"),
                "match_type": F.coalesce(F.col("match_type"), hit),
            }
        ).drop("_hit", "_key")
    members = members.withColumns({c: F.col("_found")[c] for c in found}).drop("_found")
    matched = F.col("match_type").isNotNull()
    permno_type = F.when(F.col("is_primary_permno"), "PRIMARY").otherwise("SECONDARY")
    blank = {c: F.when(matched, F.col(c)).otherwise(F.lit("")) for c in ("comnam", "exch", "linkprim", "linktype")}
    blank["ticker_crsp"] = F.when(matched, F.col("ticker")).otherwise(F.lit(""))
    members = members.withColumnRenamed("date", "_observed").withColumnRenamed("snapshot_date", "date")
    return members.withColumns(
        {
            **blank,
            "permno_type": F.when(matched, permno_type).otherwise(F.lit("NO_MATCH")),
            "match_type": F.coalesce("match_type", F.lit("UNMATCHED")),
            "is_primary": F.coalesce("is_primary_permno", F.lit(False)),
            "is_common": F.coalesce("is_common", F.lit(False)),
            "rank_score": F.coalesce("rank_score", F.lit(0.0)),
            "n_candidates": F.coalesce("n_candidates", F.lit(0)),
        }
    ).withColumnsRenamed({"comnam": "company_name", "exch": "exchange"})


def panel_dedup(best: DataFrame, row_id: str = "row_id", collapse_unmatched: bool = False) -> DataFrame:
    """Highest-ranked row per (date, gvkey).

    Members without a firm are all kept: they get a group of their own each, which also
    keeps them from meeting in one task. `collapse_unmatched` keeps one per date instead.
    """
    keys: list = ["date", "gvkey"]
    if not collapse_unmatched:
        keys.append(F.when(F.col("gvkey").isNull(), F.col(row_id)))
    return keep_first(best, keys, [*desc("rank_score"), *asc(row_id)])


def with_calendar(panel: DataFrame) -> DataFrame:
    """Year, month and the latest year whose scores were known then (the one before)."""
    return panel.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "year_month": F.date_format("date", "yyyy-MM"),
            "esg_knowledge_year": F.year("date") - 1,
        }
    )


def monthly_panel(
    snapshots: DataFrame,
    master: DataFrame,
    row_id: str = "row_id",
    collapse_unmatched: bool = False,
    score_single: bool = False,
) -> DataFrame:
    """The monthly membership panel, at most one row per (date, firm)."""
    best = panel_best(snapshots, master, row_id, score_single=score_single)
    return with_calendar(panel_dedup(best, row_id, collapse_unmatched)).select(*PANEL_COLUMNS)


def ml_grid(panel: DataFrame) -> DataFrame:
    """December members with the year columns of a look-ahead-free design."""
    december = panel.where("month = 12")
    return december.withColumns(
        {
            "constituency_year": F.col("year"),
            "formation_year": F.col("year"),
            "prediction_year": F.col("year") + 1,
            "formation_date": F.col("date"),
            "esg_baseline_year": F.col("year") - 1,
            "esg_outcome_year": F.col("year"),
        }
    ).select(*GRID_COLUMNS)
