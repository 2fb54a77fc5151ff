"""Inputs shared by the registered queries, derived from the tables in `sf_dir`.

Stages that the published pipeline keeps as files (the master, the yearly matches, the
panel) are stored once per application in the shared folder and read back from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idlink.functions import coerce
from idlink.operators.cascade import PROVIDER_A, PROVIDER_B, PROVIDER_C, ProviderSpec, match_provider
from idlink.operators.crosswalk import crosswalk
from idlink.operators.panel import monthly_panel
from idlink.operators.snapshots import month_snapshots
from idlink.plans.master import build_security_master, get_or_build_table
from idlink.session import shared_dir
from idlink.sources import conform
from idlink.sources.derived import derive
from idlink.sources.readers import extract_year, file_year
from idlink.sources.sinks import stored

SPECS = {"a": PROVIDER_A, "b": PROVIDER_B, "c": PROVIDER_C}


def stage_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{folder}/{name}"


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return get_or_build_table(spark, stage_path(spark, sf_dir, name), build)


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.clean_names(derive(spark, sf_dir, "names"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.clean_links(derive(spark, sf_dir, "links"))


def new_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_security_master(names(spark, sf_dir), links(spark, sf_dir), stage=stored(spark, "segments"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "master", lambda: new_master(spark, sf_dir))


def loaded_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.load_master(master(spark, sf_dir))


def provider_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive(spark, sf_dir, "provider_b")
    return extract_year(raw, "file_name")


def provider(spark: SparkSession, sf_dir: str, letter: str) -> DataFrame:
    if letter == "a":
        return conform.clean_provider_a(derive(spark, sf_dir, "provider_a"))
    if letter == "b":
        return conform.clean_provider_b(provider_b_raw(spark, sf_dir), ["file_name", "src_id"])
    return conform.clean_provider_c(derive(spark, sf_dir, "provider_c"), ["src_id"])


def provider_years(spark: SparkSession, sf_dir: str, letter: str) -> DataFrame:
    """Years that cover the provider's, from one narrow scan before de-duplication."""
    if letter == "a":
        return conform.provider_a_rows(derive(spark, sf_dir, "provider_a")).select("year")
    if letter == "b":
        raw = derive(spark, sf_dir, "provider_b")
        years = F.array(F.year(coerce.to_date(F.col("as_of_date"))), file_year("file_name"))
        return raw.select(F.explode(years).alias("year"))
    return conform.provider_c_rows(derive(spark, sf_dir, "provider_c")).select("year")


def match(spark: SparkSession, sf_dir: str, letter: str, spec: ProviderSpec | None = None, passes=None) -> DataFrame:
    """Year matches of a provider, with its own or a varied spec or passes."""
    rows, master = provider(spark, sf_dir, letter), loaded_master(spark, sf_dir)
    return match_provider(rows, master, spec or SPECS[letter], passes, provider_years(spark, sf_dir, letter))


def new_matches(spark: SparkSession, sf_dir: str, letter: str) -> DataFrame:
    return match(spark, sf_dir, letter)


def matches(spark: SparkSession, sf_dir: str, letter: str) -> DataFrame:
    return staged(spark, sf_dir, f"matches_{letter}", lambda: new_matches(spark, sf_dir, letter))


def all_matches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {SPECS[x].name: matches(spark, sf_dir, x) for x in SPECS}


def crosswalks(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    return {
        SPECS[x].name: (crosswalk(matches(spark, sf_dir, x), SPECS[x].entity), SPECS[x].entity) for x in SPECS
    }


def constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.clean_constituents(derive(spark, sf_dir, "constituents"), keep=["row_id"])


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_snapshots(constituents(spark, sf_dir))


def new_panel(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return monthly_panel(snapshots(spark, sf_dir), loaded_master(spark, sf_dir), **options)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "panel", lambda: new_panel(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles rounded to six places, so that the order of a sum cannot show."""
    return df.withColumns({c: F.round(c, 6) for c in columns})
