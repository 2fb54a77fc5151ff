"""Providers that are mapped at once: overlap, isolation, cancellation."""

from __future__ import annotations

import random
import threading
import time

from idlink.operators.cascade import PROVIDER_A, PROVIDER_B, PROVIDER_C
from idlink.plans import mapping
from idlink.sources.conform import clean_provider_a
from idlink.sources.sinks import stored
from tests.test_cascade import load, random_master

RAW = [(str(i % 9), 2001 + i % 3, f"10000{i % 6}103", None, f"T{i % 5}", "N") for i in range(60)]
COLUMNS = "orgpermid string, year int, cusip string, isin string, ticker string, comname string"


def rows_of(spark):
    return clean_provider_a(spark.createDataFrame(RAW, COLUMNS))


def as_b(df):
    return df.withColumnsRenamed({"orgpermid": "issuer_id", "comname": "company_name"})


def test_providers_overlap(spark):
    """Each waits for the other within its own job's preparation, so one after another would time out."""
    master = load(spark, random_master(random.Random(1), 60))
    both, tags = threading.Barrier(2, timeout=60), {}

    def loading(name, rows):
        both.wait()
        tags[name] = (set(map(str, spark.sparkContext.getJobTags())), spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return rows

    sources = [
        mapping.Source(PROVIDER_A, lambda: loading("a", rows_of(spark))),
        mapping.Source(PROVIDER_B, lambda: loading("b", as_b(rows_of(spark)))),
    ]
    done, failed = mapping.map_all(sources, master, stored(spark, "provider"), at_once=2)
    assert list(done) == ["provider_a", "provider_b"] and not failed
    assert tags == {"a": ({"map-provider_a"}, "provider_a"), "b": ({"map-provider_b"}, "provider_b")}
    assert not spark.sparkContext.getJobTags()
    assert mapping.consolidated(done).count() > 0


def test_one_fails_while_running_and_the_others_come_out(spark):
    master = load(spark, random_master(random.Random(2), 60))
    broken = as_b(rows_of(spark)).where("assert_true(issuer_id IS NULL, 'unreadable') IS NULL")
    sources = [mapping.Source(PROVIDER_B, lambda: broken), mapping.Source(PROVIDER_A, lambda: rows_of(spark))]
    alone, _ = mapping.map_all(sources[1:], master, stored(spark, "provider"))
    for at_once in (1, 2):
        done, failed = mapping.map_all(sources, master, stored(spark, "provider"), at_once=at_once)
        assert set(done) == {"provider_a"} and "unreadable" in str(failed["provider_b"])
        assert sorted(map(str, done["provider_a"].crosswalk.collect())) == sorted(map(str, alone["provider_a"].crosswalk.collect()))


def test_first_failure_cancels_the_others(spark):
    master = load(spark, random_master(random.Random(3), 60))
    started = threading.Event()

    def slow():
        started.set()
        # Hours of work unless cancelled.
        busy = spark.range(10**13).where("id % 7 = 9").selectExpr("CAST(id AS STRING) AS orgpermid")
        return rows_of(spark).join(busy, "orgpermid", "left_semi")

    def broken():
        started.wait(60)
        time.sleep(5)
        raise ValueError("no such file")

    sources = [mapping.Source(PROVIDER_A, slow), mapping.Source(PROVIDER_B, broken), mapping.Source(PROVIDER_C, broken)]
    begun = time.time()
    done, failed = mapping.map_all(sources, master, stored(spark, "provider"), at_once=2, fail_fast=True)
    assert not done and list(failed) == ["provider_a", "provider_b", "provider_c"] and time.time() - begun < 120
    assert "cancel" in str(failed["provider_a"]).lower() and "no such file" in str(failed["provider_b"])
    assert spark.range(3).count() == 3
