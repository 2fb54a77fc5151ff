"""Coverage and summary tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idlink.operators.ranking import asc, desc

def _present(name: str) -> Column:
    return F.count(F.col(name))


def match_summary(candidates: DataFrame, entity: str) -> DataFrame:
    """One row: provider rows, matched rows and share, distinct entities and firms, year range.

    `candidates` are all provider rows, `match_src` null where unmatched. Distinct counts
    run on the (entity, gvkey) pairs left by a partial aggregate.
    """
    matched = F.col("match_src").isNotNull()
    pairs = candidates.groupBy(F.when(matched, F.col(entity)).alias("_entity"), F.when(matched, F.col("gvkey")).alias("_gvkey")).agg(
        F.count("*").alias("_rows"),
        F.count_if(matched).alias("_matched"),
        F.min(F.when(matched, F.col("year"))).alias("_first"),
        F.max(F.when(matched, F.col("year"))).alias("_last"),
    )
    return pairs.agg(
        F.sum("_rows").alias("n_input"),
        F.sum("_matched").alias("n_matched"),
        (F.sum("_matched") / F.sum("_rows")).alias("match_rate"),
        F.count_distinct("_entity").alias("n_entities"),
        F.count_distinct("_gvkey").alias("n_gvkeys"),
        F.min("_first").alias("min_year"),
        F.max("_last").alias("max_year"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def availability(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Present count and share of each column: one aggregate row, unpivoted."""
    counts = df.agg(F.count("*").alias("n_rows"), *[_present(c).alias(c) for c in columns])
    long = counts.unpivot(["n_rows"], list(columns), "column_name", "n_present")
    return long.withColumn("share", F.col("n_present") / F.col("n_rows"))


def matches_by_year(matches: DataFrame) -> DataFrame:
    return matches.groupBy("year").agg(F.count("*").alias("n_matches"))


def panel_coverage(panel: DataFrame, years: int = 10) -> DataFrame:
    """Firms, securities and rows per year, for the latest `years` years."""
    yearly = panel.groupBy("year").agg(
        F.count_distinct("gvkey").alias("n_gvkeys"),
        F.count_distinct("permno").alias("n_permnos"),
        F.count("*").alias("n_rows"),
    )
    return yearly.orderBy(F.desc("year")).limit(years)


def panel_match_rate(panel: DataFrame) -> DataFrame:
    """Rows, date range, firms, securities, and the shares of rows with a firm and with a security."""
    return panel.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("gvkey").alias("n_gvkeys"),
        F.count_distinct("permno").alias("n_permnos"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg(F.col("gvkey").isNotNull().cast("int")).alias("gvkey_rate"),
        F.avg(F.col("permno").isNotNull().cast("int")).alias("permno_rate"),
    )


def id_coverage(constituents: DataFrame) -> DataFrame:
    """Shares of rows with an ISIN and with a CUSIP."""
    return constituents.agg(
        F.count("*").alias("n_rows"),
        F.avg(F.col("isin").isNotNull().cast("int")).alias("isin_rate"),
        F.avg(F.col("cusip").isNotNull().cast("int")).alias("cusip_rate"),
    )


def unmatched_constituents(panel: DataFrame) -> DataFrame:
    unmatched = panel.where("match_type = 'UNMATCHED'")
    return unmatched.select("date", "ticker_sp500", "cusip_sp500").distinct()


_AUDIT = ["date", "gvkey", "permno", "match_type", "permno_type", "is_primary", "linkprim", "linktype"]


def audit_sample(panel: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows of the sorted panel, for review by eye."""
    order = asc("date", "gvkey", "cusip_sp500", "ticker_sp500", "match_type")
    return panel.orderBy(*order).limit(rows).select(*_AUDIT)


def top_gvkeys(consolidated: DataFrame, rows: int = 10) -> DataFrame:
    """Firms with the most entity mappings."""
    counts = consolidated.where("gvkey IS NOT NULL").groupBy("gvkey").agg(F.count("*").alias("n_mappings"))
    return counts.orderBy(*desc("n_mappings"), *asc("gvkey")).limit(rows)


def grid_summary(grid: DataFrame) -> DataFrame:
    """Firm-years, year range and firms of the annual grid."""
    return grid.agg(
        F.count("*").alias("n_rows"),
        F.min("constituency_year").alias("min_year"),
        F.max("constituency_year").alias("max_year"),
        F.count_distinct("gvkey").alias("n_gvkeys"),
    )


def constituent_summary(constituents: DataFrame) -> DataFrame:
    """Rows, instruments and date span of collected constituents."""
    return constituents.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("ric").alias("n_rics"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def master_summary(master: DataFrame) -> DataFrame:
    """Segments, those with a firm, and firms."""
    return master.agg(
        F.count("*").alias("n_segments"),
        F.count("gvkey").alias("n_linked"),
        F.count_distinct("gvkey").alias("n_gvkeys"),
    )


def provider_summary(matches_by_provider: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per provider (matches, entity column): matches, entities, firms and year range."""
    parts = [
        m.groupBy(F.lit(name).alias("provider")).agg(
            F.count("*").alias("n_matches"),
            F.count_distinct(entity).alias("n_entities"),
            F.count_distinct("gvkey").alias("n_gvkeys"),
            F.min("year").alias("min_year"),
            F.max("year").alias("max_year"),
        )
        for name, (m, entity) in matches_by_provider.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def consolidated_summary(consolidated: DataFrame) -> DataFrame:
    """Mappings and firms per provider of the consolidated table."""
    return consolidated.groupBy("provider").agg(
        F.count("*").alias("n_mappings"), F.count_distinct("gvkey").alias("n_gvkeys")
    )


# ---- firms across providers ------------------------------------------------------------


def _together(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames, as a balanced tree: one after another would nest as deep as they are many."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def _known_firms(matches: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """(provider, gvkey) from one frame per provider, or from one frame with a provider column."""
    if isinstance(matches, DataFrame):
        rows = matches.select("provider", "gvkey")
    else:
        rows = _together([m.select(F.lit(name).alias("provider"), "gvkey") for name, m in matches.items()])
    return rows.where("gvkey IS NOT NULL")


def firm_providers(matches_by_provider: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """gvkey -> sorted array of the providers that have it, never longer than the provider list."""
    known = _known_firms(matches_by_provider)
    return known.groupBy("gvkey").agg(F.array_sort(F.collect_set("provider")).alias("providers"))


def firm_bitmaps(matches_by_provider: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """(provider, bucket, bitmap): the firms of a provider as bits. Numbers of firms hold within one evaluation only."""
    numbered = firm_providers(matches_by_provider).withColumn("_n", F.monotonically_increasing_id())
    bits = numbered.select("_n", F.explode("providers").alias("provider"))
    bits = bits.groupBy("provider", F.bitmap_bucket_number("_n").alias("bucket"))
    return bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bitmap"))


def gvkey_common(matches_by_provider: dict[str, DataFrame]) -> DataFrame:
    """Firms every provider has."""
    n = len(matches_by_provider)
    return firm_providers(matches_by_provider).where(F.size("providers") == n).select("gvkey")


def gvkey_pairwise(matches_by_provider: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """Number of shared firms per pair of providers, zero included.

    The plan is the same for any number of providers: sets of firms are bitmaps, which are and-ed
    bucket by bucket; a bucket has one bitmap of 4 KB per provider at most.
    """
    spark = SparkSession.active()
    if isinstance(matches_by_provider, DataFrame):
        found = matches_by_provider.select("provider").where("provider IS NOT NULL").distinct()
        names = sorted(r["provider"] for r in found.collect())  # the list of providers
    else:
        names = list(matches_by_provider)
    of = F.array(*map(F.lit, names))
    number = F.array_position(of, F.col("provider")).cast("int")
    sets = firm_bitmaps(matches_by_provider).groupBy("bucket").agg(F.collect_list(F.struct(number.alias("p"), "bitmap")).alias("sets"))
    one = sets.select("bucket", "sets", F.explode("sets").alias("a"))
    two = one.select("bucket", "a", F.explode(F.filter("sets", lambda x: x["p"] > F.col("a.p"))).alias("b"))
    both = two.select(F.col("a.p").alias("i"), F.col("b.p").alias("j"), "bucket", F.explode(F.array("a.bitmap", "b.bitmap")).alias("bitmap"))
    shared = both.groupBy("i", "j", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bitmap")).alias("n"))
    shared = shared.groupBy("i", "j").agg(F.sum("n").alias("n_shared"))
    pairs = spark.range(1, len(names)).select(
        F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.col("id").cast("int") + 1, F.lit(len(names)))).alias("j")
    )
    counted = pairs.join(shared, ["i", "j"], "left")
    name = lambda c: F.element_at(of, F.col(c))
    n_shared = F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared")
    return counted.select(name("i").alias("provider_1"), name("j").alias("provider_2"), n_shared)


def gvkey_exclusive(matches_by_provider: dict[str, DataFrame]) -> DataFrame:
    """Firms only one provider has, with that provider."""
    only = firm_providers(matches_by_provider).where(F.size("providers") == 1)
    return only.select("gvkey", F.col("providers")[0].alias("provider"))


def universe_coverage(panel: DataFrame, matches_by_provider: dict[str, DataFrame]) -> DataFrame:
    """Per provider and year: panel rows, and those whose firm the provider covers that year.

    Both sides shrink to one row per (firm, year) before they meet.
    """
    names = list(matches_by_provider)
    members = panel.groupBy("gvkey", "year").agg(F.count("*").alias("_rows"))
    covered = None
    for name, matches in matches_by_provider.items():
        part = matches.where("gvkey IS NOT NULL").select("gvkey", "year", F.lit(name).alias("_provider"))
        covered = part if covered is None else covered.unionByName(part)
    covered = covered.groupBy("gvkey", "year").agg(
        *[F.bool_or(F.col("_provider") == name).alias(f"_has_{i}") for i, name in enumerate(names)]
    )
    flags = F.array(
        *[
            F.struct(F.lit(name).alias("provider"), F.coalesce(F.col(f"_has_{i}"), F.lit(False)).alias("has"))
            for i, name in enumerate(names)
        ]
    )
    long = members.join(covered, ["gvkey", "year"], "left").select("year", "_rows", F.explode(flags).alias("_p"))
    sums = long.groupBy(F.col("_p.provider").alias("provider"), "year").agg(
        F.sum("_rows").alias("n_members"),
        F.sum(F.when(F.col("_p.has"), F.col("_rows")).otherwise(F.lit(0))).alias("n_covered"),
    )
    return sums.withColumn("coverage", F.col("n_covered") / F.col("n_members"))
