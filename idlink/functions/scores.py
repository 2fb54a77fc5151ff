"""Flags, labels and ranking scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from idlink.schemas import (
    COMMON_SHARE_CODES,
    EXCHANGE_LABELS,
    LINK_TYPE_RANKS,
    PREFERRED_EXCHANGES,
    PRIMARY_LINK_CODES,
)


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def _lookup(c: Column, table: dict, default: Column) -> Column:
    chain = None
    for key, value in table.items():
        chain = F.when(c == key, value) if chain is None else chain.when(c == key, value)
    return chain.otherwise(default)


def linkprim_score(linkprim: Column) -> Column:
    return _flag(linkprim.isin(*PRIMARY_LINK_CODES))


def linktype_rank(linktype: Column) -> Column:
    return _lookup(linktype, LINK_TYPE_RANKS, F.lit(0))


def cusip6_match(left: Column, right: Column) -> Column:
    return _flag(left == right)


def is_common(shrcd: Column, codes: tuple[int, ...] = COMMON_SHARE_CODES) -> Column:
    return F.coalesce(shrcd.isin(*codes), F.lit(False))


def exchange_label(exchcd: Column) -> Column:
    return _lookup(exchcd, EXCHANGE_LABELS, F.lit(None).cast("string"))


def segment_score(
    common: Column, primary: Column, exchcd: Column, overlap: Column, link_primary: Column, link_type: Column
) -> Column:
    """Match score of a security segment for one year, before the points of the key that found it."""
    return (
        _flag(common) * 3
        + _flag(primary) * 2
        + _flag(exchcd.isin(*PREFERRED_EXCHANGES))
        + F.least(F.lit(3), F.coalesce(F.floor(overlap / 365).cast("int"), F.lit(0)))
        + F.coalesce(link_primary, F.lit(0))
        + F.coalesce(link_type, F.lit(0))
    ).cast("int")


def _years(overlap: Column) -> Column:
    return F.coalesce(overlap, F.lit(0)) / F.lit(365.0)


def permno_rank_score(
    primary: Column, common: Column, same_cusip: Column, link_primary: Column, link_type: Column, overlap: Column
) -> Column:
    """Ranks the securities of one firm."""
    whole = (
        _flag(primary) * 10000
        + _flag(common) * 1000
        + F.coalesce(same_cusip, F.lit(0)) * 100
        + F.coalesce(link_primary, F.lit(0)) * 10
        + F.coalesce(link_type, F.lit(0)) * 5
    )
    return whole + _years(overlap)


def gvkey_rank_score(link_primary: Column, link_type: Column, overlap: Column) -> Column:
    """Ranks firms against each other."""
    return F.coalesce(link_primary, F.lit(0)) * 100 + F.coalesce(link_type, F.lit(0)) * 10 + _years(overlap)
