"""Primary security per firm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlink.functions import dates
from idlink.operators.ranking import asc, desc, keep_first
from idlink.operators.skew import spread_join

PAIR = ["gvkey", "permno"]


def pair_statistics(segments: DataFrame) -> DataFrame:
    """Link quality and total segment length per (gvkey, permno)."""
    days = dates.segment_days(F.col("namedt"), F.col("nameendt"))
    return (
        segments.where("gvkey IS NOT NULL")
        .groupBy(*PAIR)
        .agg(
            F.max("linkprim_score").alias("linkprim_score"),
            F.max("linktype_rank").alias("linktype_rank"),
            F.sum(days.cast("long")).alias("seg_days"),
            F.bool_or(F.coalesce("is_common", F.lit(False))).alias("has_common"),
        )
    )


def one_to_one_pairs(pairs: DataFrame) -> DataFrame:
    """(gvkey, permno) pairs where each side has only the other.

    A side has degree one exactly when the smallest and largest partner agree, so two
    partial aggregates replace counting windows, and the join meets each pair once.
    """
    by_permno = (
        pairs.groupBy("permno")
        .agg(F.min("gvkey").alias("gvkey"), F.max("gvkey").alias("_last"))
        .where("gvkey = _last")
        .select(*PAIR)
    )
    by_gvkey = (
        pairs.groupBy("gvkey")
        .agg(F.min("permno").alias("permno"), F.max("permno").alias("_last"))
        .where("permno = _last")
        .select(*PAIR)
    )
    return by_permno.join(by_gvkey, PAIR)


def pair_statistics_with_degree(segments: DataFrame) -> DataFrame:
    """`pair_statistics` plus the one-to-one flag."""
    stats = pair_statistics(segments)
    one = one_to_one_pairs(stats.select(*PAIR)).withColumn("one2one", F.lit(True))
    return stats.join(one, PAIR, "left").na.fill(False, subset=["one2one"])


def primary_map(segments: DataFrame) -> DataFrame:
    """gvkey -> primary_permno.

    The one-to-one flag ranks second in the definition, but it can only be true for a firm
    with a single security, where there is nothing to rank; so it is not computed here.
    """
    order = [*desc("has_common", "linkprim_score", "linktype_rank", "seg_days"), *asc("permno")]
    best = keep_first(pair_statistics(segments), ["gvkey"], order)
    return best.select("gvkey", F.col("permno").alias("primary_permno"))


def with_primary(segments: DataFrame, primary: DataFrame) -> DataFrame:
    """Add the firm's primary security and whether the row is it (null without a firm)."""
    joined = spread_join(segments, primary, ["gvkey"], ["permno", "namedt", "nameendt"], "left")
    return joined.withColumn("is_primary_permno", F.expr("permno = primary_permno"))


def primary_table(master: DataFrame) -> DataFrame:
    """One (gvkey, primary_permno) row per firm; the value is the same on all rows of a firm."""
    known = master.where("gvkey IS NOT NULL AND primary_permno IS NOT NULL")
    return known.groupBy("gvkey").agg(F.min("primary_permno").alias("primary_permno"))
