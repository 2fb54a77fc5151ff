"""A corpus pipeline of five stages: from `documents` to token-id files.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; `run` writes what
a stage returns to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from idlink.llm import decontaminate, jaccard, mixing, planes, quality  # noqa: E402
from idlink.llm.common import kept, table  # noqa: E402
from idlink.llm.queries import prepare  # noqa: E402
from idlink.session import configure  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    prepare(configure(spark))
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: texts of five-word shingles, at 80 in a hundredths or more."""
    prepare(configure(spark))
    return jaccard.keep_one(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    prepare(configure(spark))
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(configure(spark))
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids of all documents and reports what the files hold."""
    prepare(configure(spark))
    return planes.token_output(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: Token ids come from a tokenizer file, so SQL cannot express the rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
