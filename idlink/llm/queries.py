"""Registered queries of this folder, each over whole tables with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from idlink.llm import (
    attribution,
    decontaminate,
    doc_classifier,
    jaccard,
    langid,
    licenses,
    merkle,
    mixing,
    planes,
    quality,
    suffix_tree,
    vector_codes,
    warc,
)
from idlink.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def prepared(fn):
    """The query on a session with this folder's settings."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)

    return run


@query
def op1_language_id(spark, sf):
    return langid.language_report(table(spark, sf, "documents"))


@query
def op2_lm_scoring(spark, sf):
    return suffix_tree.score_report(table(spark, sf, "documents"))


@query
def op3_token_counts(spark, sf):
    return attribution.attribute(table(spark, sf, "documents"))


@query
def op4_mixing(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_token_output(spark, sf):
    return planes.token_output(table(spark, sf, "documents"))


@query
def op6_warc(spark, sf):
    return warc.read_archives(warc.write_archives(table(spark, sf, "pages")))


@query
def op7_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query
def op8_decontamination(spark, sf):
    return decontaminate.contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_ngram_jaccard(spark, sf):
    return jaccard.jaccard_report(table(spark, sf, "documents"))


@query
def op10_quality_rules(spark, sf):
    df = quality.quality(table(spark, sf, "documents"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return df.select("doc.doc_id", *columns)


@query
def op11_merkle_manifest(spark, sf):
    return merkle.manifest_report(table(spark, sf, "documents"))


@query
def op12_vector_codes(spark, sf):
    return vector_codes.code_report(table(spark, sf, "embeddings"))


@query
def op13_quality_classifier(spark, sf):
    return doc_classifier.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))
