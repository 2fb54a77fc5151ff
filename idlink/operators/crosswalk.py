"""From yearly matches to one firm per entity, and to one table over all providers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlink.operators.ranking import asc, desc, keep_first

CROSSWALK_COLUMNS = [
    "gvkey", "total_score", "years_covered", "max_overlap_days", "primary_permno", "first_seen", "last_seen",
]
CONSOLIDATED_COLUMNS = [
    "provider", "entity_id", "gvkey", "primary_permno", "years_covered", "first_seen", "last_seen",
]


def firm_candidates(matches: DataFrame, entity: str) -> DataFrame:
    """Score, coverage and modal security per (entity, gvkey).

    Matches hold one row per (entity, year), so an entity has at most one row per calendar
    year. One exchange by entity therefore stays balanced, and both aggregations and the
    choice of the firm after it reuse that partitioning.
    """
    per_security = (
        matches.where("gvkey IS NOT NULL")
        .repartition(entity)
        .groupBy(entity, "gvkey", "permno")
        .agg(
            F.count(F.lit(1)).alias("_years"),
            F.min("year").alias("_first_year"),
            F.sum("match_score").alias("_score"),
            F.max("overlap_days").alias("_overlap"),
            F.min("namedt").alias("_first"),
            F.max("nameendt").alias("_last"),
        )
    )
    return per_security.groupBy(entity, "gvkey").agg(
        F.sum("_score").alias("total_score"),
        F.sum("_years").alias("years_covered"),
        F.max("_overlap").alias("max_overlap_days"),
        F.min_by("permno", F.struct(-F.col("_years"), F.col("_first_year"), F.col("permno"))).alias("primary_permno"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
    )


def crosswalk(matches: DataFrame, entity: str) -> DataFrame:
    """Best firm per entity."""
    order = [*desc("total_score", "years_covered", "max_overlap_days"), *asc("gvkey")]
    return keep_first(firm_candidates(matches, entity), [entity], order).select(entity, *CROSSWALK_COLUMNS)


def tag_provider(table: DataFrame, provider: str, entity: str) -> DataFrame:
    """The provider's name as a column and its entity column as `entity_id`, a string."""
    return table.withColumns({"provider": F.lit(provider), "entity_id": F.col(entity).cast("string")})


def consolidate(crosswalks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Union of crosswalks: provider name -> (crosswalk, entity column)."""
    tagged = [tag_provider(t, name, entity).select(*CONSOLIDATED_COLUMNS) for name, (t, entity) in crosswalks.items()]
    return reduce(DataFrame.unionByName, tagged)
