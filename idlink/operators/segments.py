"""Name-history segments linked to firms: interval join, then the best link per segment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlink.functions import dates, scores
from idlink.operators import dyadic
from idlink.operators.ranking import asc, desc, keep_first
from idlink.operators.skew import crowded_keys, keyed_join, spread_join
from idlink.schemas import SEGMENT_KEY

Stage = Callable[..., DataFrame]
#: Links of a security up to which its segments are paired with them.
PAIRED = 64
NAME_ORDER = ("shrcd", "exchcd", "ncusip", "ticker", "comnam", "permco")
LINK_COLUMNS = ["gvkey", "linkdt", "linkenddt", "cusip", "cusip6", "linkprim", "linktype"]
LINK_SCORES = ["linkprim_score", "linktype_rank"]
_LINK_CLASS = ["permno", *LINK_SCORES]
_LINK_ORDER = ["linkdt", "gvkey", "linkenddt", "cusip", "linkprim", "linktype"]


def dedup_segments(names: DataFrame, order_by: Sequence[str] = NAME_ORDER) -> DataFrame:
    """First row of each (permno, namedt, nameendt)."""
    return keep_first(names, SEGMENT_KEY, asc(*order_by))


def undominated_links(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop every link that can never be the best of its `keys` group for any segment.

    A link is dominated when another one of its group starts no later, ends no earlier
    and does not come after it in the tie order: whatever segment the first overlaps, the
    second overlaps at least as long and wins ties. What remains has strictly increasing
    end dates, so a group keeps at most one link per calendar day however many it had.
    The first step (one link per end date) is a partial top-1, which bounds the group
    before the running maximum looks at it.
    """
    per_end = keep_first(links, [*keys, "linkenddt"], asc(*_LINK_ORDER))
    before = Window.partitionBy(*keys).orderBy(*asc(*_LINK_ORDER)).rowsBetween(Window.unboundedPreceding, -1)
    latest_end = F.max("linkenddt").over(before)
    kept = per_end.withColumn("_latest", latest_end).where("_latest IS NULL OR _latest < linkenddt")
    return kept.drop("_latest")


def candidate_links(
    names: DataFrame,
    links: DataFrame,
    order_by: Sequence[str] = NAME_ORDER,
    stage: Stage | None = None,
    paired: int = PAIRED,
) -> DataFrame:
    """Segments with the links that can be their best one, and each segment with null link columns unless it
    has one of these and its security has few links.

    Two joins cover the two ways a link can win. Regardless of CUSIP, only the
    undominated links of a (permno, score class) compete. A link with the segment's own
    CUSIP6 beats the others of its class, so undominated links of a (permno, class,
    CUSIP6) that the first join lost are added through an equality on CUSIP6. Neither join
    pairs every name row with every link of a permno, and both follow the pattern whose
    skewed partitions adaptive execution splits.

    `stage` stores the reduced links, the two kinds apart. Their true sizes are then known
    before the wide segments move: the second is empty or tiny unless a security has many CUSIPs, and
    joining to it then needs no shuffle of the segments. It is then also counted which securities have more than
    `paired` reduced links. Their pairs come from an equality on date blocks, which makes touching
    pairs only; segments of the others meet at most that many links.
    """
    segments = keep_first(names, [*SEGMENT_KEY, "ncusip6"], asc(*order_by))
    narrow = links.select("permno", *LINK_COLUMNS, *LINK_SCORES)
    own_cusip = undominated_links(narrow.where("cusip6 IS NOT NULL"), [*_LINK_CLASS, "cusip6"])
    any_cusip = undominated_links(narrow, _LINK_CLASS)
    identity = [*_LINK_CLASS, "cusip6", "linkenddt"]
    only_by_cusip = own_cusip.join(any_cusip.select(*identity), identity, "left_anti")

    if stage is not None:
        marked = [t.withColumn("by_cusip", F.lit(i)) for i, t in enumerate((any_cusip, only_by_cusip))]
        reduced = stage(marked[0].unionByName(marked[1]), "by_cusip")
        any_cusip, only_by_cusip = [reduced.where(F.col("by_cusip") == i).drop("by_cusip") for i in (0, 1)]
    touching = dates.intervals_touch(F.col("namedt"), F.col("nameendt"), F.col("linkdt"), F.col("linkenddt"))
    # A key that is never null keeps the second branch free of extra filters, so that both
    # branches read one shuffle of the segments.
    keyed = segments.withColumn("_cusip_key", F.coalesce("ncusip6", F.lit("")))
    cusip_links = only_by_cusip.withColumn("_cusip_key", F.col("cusip6"))
    # Without a stage, counting would reduce the links once more.
    many = crowded_keys(any_cusip, ["permno"], paired) if stage else None
    many_cusip = crowded_keys(cusip_links, ["permno", "_cusip_key"], paired) if stage else None
    pairs = []
    for keys, left, right, crowd, how in (
        (["permno"], segments, any_cusip, many, "left"),
        (["permno", "_cusip_key"], keyed, cusip_links, many_cusip, "inner"),
    ):
        if crowd is not None:
            hot = spread_join(right, crowd, keys, _LINK_ORDER)
            crowded = spread_join(left, crowd, keys, ["namedt", "nameendt"])
            pairs.append(dyadic.touching_pairs(crowded, hot, keys, ("namedt", "nameendt"), ("linkdt", "linkenddt"), paired=0))
            right = right.join(crowd, keys, "left_anti")
        pairs.append(keyed_join(left, right, keys, how, touching))
    joined = reduce(lambda x, y: x.unionByName(y), [p.drop("_cusip_key") for p in pairs])
    return joined.withColumns(
        {
            "overlap_days": dates.touching_overlap_days(
                F.col("namedt"), F.col("nameendt"), F.col("linkdt"), F.col("linkenddt")
            ),
            "cusip6_match": scores.cusip6_match(F.col("ncusip6"), F.col("cusip6")),
        }
    )


def _best_first(order_by: Sequence[str]) -> list:
    return [
        *desc(*LINK_SCORES, "cusip6_match", "overlap_days"),
        *asc("linkdt", "gvkey", "linkenddt", "cusip", "linkprim", "linktype", *order_by),
    ]


def segment_links(
    names: DataFrame,
    links: DataFrame,
    order_by: Sequence[str] = NAME_ORDER,
    stage: Stage | None = None,
    paired: int = PAIRED,
) -> DataFrame:
    """The best overlapping link of every score class, per segment: at most six rows each."""
    candidates = candidate_links(names, links, order_by, stage, paired)
    linked = candidates.where("linkdt IS NOT NULL")
    return keep_first(linked, [*SEGMENT_KEY, *LINK_SCORES], _best_first(order_by))


def best_links(
    names: DataFrame,
    links: DataFrame,
    order_by: Sequence[str] = NAME_ORDER,
    stage: Stage | None = None,
    paired: int = PAIRED,
) -> DataFrame:
    """One row per segment with its best link, or with null link columns and zero scores."""
    candidates = candidate_links(names, links, order_by, stage, paired)
    best = keep_first(candidates, SEGMENT_KEY, _best_first(order_by))
    return best.na.fill(0, subset=[*LINK_SCORES, "overlap_days", "cusip6_match"])


def with_flags(segments: DataFrame) -> DataFrame:
    """Common-share flag and exchange label."""
    return segments.withColumns(
        {"is_common": scores.is_common(F.col("shrcd")), "exch": scores.exchange_label(F.col("exchcd"))}
    )
