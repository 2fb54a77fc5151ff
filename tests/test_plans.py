"""Plan shape: no nested loops, no Python, skewed joins split at run time."""

from __future__ import annotations

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from idlink.operators import cascade, panel, primary, segments
from idlink.operators.skew import spread_join
from idlink.operators.snapshots import month_snapshots
from idlink.sources import readers
from idlink.sources.conform import clean_constituents, clean_links, clean_names, clean_provider_a, load_master

SF = "/root/testdata/sf0.001"
COMPOSITE = [
    "security_master", "best_link", "segment_links", "match_provider_a", "match_provider_c", "semi_filter_ticker",
    "consolidated_crosswalk", "monthly_panel", "universe_coverage", "extract_year", "gvkey_pairwise", "month_fallback",
]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", COMPOSITE)
def test_no_nested_loops_and_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Cartesian", "Python", "Pandas", "ArrowEval"):
        assert word not in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    queries()["load_master"](spark, SF).write.parquet(str(tmp_path / "m"))
    plan = executed(spark.read.parquet(str(tmp_path / "m")).where("permno = 7").select("permno", "gvkey"))
    assert "PushedFilters: [IsNotNull(permno), EqualTo(permno,7)]" in plan
    assert "ReadSchema: struct<permno:bigint,gvkey:string>" in plan


def test_top_one_is_limited_before_the_shuffle(spark):
    plan = queries()["dedup_entity_year"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_a_crosswalk_needs_one_shuffle(spark):
    plan = queries()["crosswalk_a"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_staged_link_tables_spare_the_segments_a_shuffle(spark):
    """With the size of the links known, segments are shuffled to be de-duplicated and to be ranked only."""
    from catalog import inputs
    from idlink.sources.sinks import stored

    names, links = inputs.names(spark, SF), inputs.links(spark, SF)
    best = segments.best_links(stored(spark, "names")(names), links, stage=stored(spark, "links"))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert sum(line.count("Exchange hash") for line in plan.splitlines()) == 3


@contextlib.contextmanager
def small_thresholds(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2048",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def day(n):
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)


def hot_names(spark, n=6000):
    """A third of the rows and more belong to security 1."""
    rows = [(1 if i % 2 else i, day(i % 2000), day(i % 2000 + 20), f"{i % 50:06d}10", 10, 1, f"T{0 if i % 2 else i}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "permno long, namedt date, nameendt date, ncusip string, shrcd int, exchcd int, ticker string, src int")
    return clean_names(df.repartition(8), keep=["src"])


def hot_links(spark, n=400):
    rows = [(1 if i % 2 else i, f"{i % 2 * 5:06d}", day(i), day(i + 700), f"{i % 50:06d}101", "P", "LU") for i in range(n)]
    df = spark.createDataFrame(rows, "permno long, gvkey string, linkdt date, linkenddt date, cusip string, linkprim string, linktype string")
    return clean_links(df.repartition(4))


def hot_master(spark, n=6000):
    rows = [
        (i, "000001" if i % 2 else f"{i:06d}", day(i % 900), day(i % 900 + 400), day(0), None, "SAME" if i % 2 else f"T{i}",
         "10000010" if i % 2 else f"{i:06d}10") for i in range(n)
    ]
    schema = "permno long, gvkey string, namedt date, nameendt date, linkdt date, linkenddt date, ticker string, ncusip string"
    return load_master(spark.createDataFrame(rows, schema).repartition(8))


def test_hot_security_is_split_when_linking(spark):
    with small_thresholds(spark):
        linked = segments.best_links(hot_names(spark), hot_links(spark), order_by=("src",))
        assert "skew=true" in executed(linked)


def test_hot_and_missing_firms_are_split_when_adding_the_primary(spark):
    with small_thresholds(spark):
        linked = segments.with_flags(segments.best_links(hot_names(spark), hot_links(spark), order_by=("src",)))
        plan = executed(primary.with_primary(linked, primary.primary_map(linked)))
        joins = [line for line in plan.splitlines() if "skew=true" in line and "gvkey" in line]
        assert joins


def test_rows_without_a_key_go_to_all_tasks(spark):
    """Without broadcasts and without help of adaptive execution."""
    big = spark.range(20_000).select("id", F.lit(None).cast("string").alias("k"), F.lit(2001).alias("year"))
    small = spark.createDataFrame([("x", 2001, 1)], "k string, year int, found int")
    with small_thresholds(spark):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            joined = spread_join(big, small, ["k", "year"], ["id"], "left")
            rows = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(rows) == 20_000 and len(rows) == tasks and max(rows) < 2 * 20_000 / tasks


def test_hot_key_is_split_when_providers_look_it_up(spark):
    rows = [(f"E{i}", "2001", "100000103" if i % 2 else f"{i:06d}103", None) for i in range(8000)]
    raw = spark.createDataFrame(rows, "orgpermid string, year string, cusip string, isin string").repartition(8)
    with small_thresholds(spark):
        matches = cascade.match_provider(clean_provider_a(raw), hot_master(spark), cascade.PROVIDER_A)
        assert "skew=true" in executed(matches)


def test_hot_key_is_split_in_the_as_of_join(spark):
    rows = [(day(30 * i), f"R{i}.N", None, "100000103", "SAME", i) for i in range(40)]
    raw = spark.createDataFrame(rows, "date date, ric string, isin string, cusip string, ticker string, row_id long")
    snaps = month_snapshots(clean_constituents(raw, keep=["row_id"]))
    with small_thresholds(spark):
        best = panel.best_by_key_date(hot_master(spark), snaps)
        assert "skew=true" in executed(best)


def test_hot_file_is_split_when_years_are_looked_up(spark):
    rows = [("big.csv" if i % 2 else f"f{i % 40}.csv", str(day(i % 900)), i) for i in range(8000)]
    df = spark.createDataFrame(rows, f"{readers.FILE} string, date string, {readers.ROW} long").repartition(8)
    with small_thresholds(spark):
        assert "skew=true" in executed(readers.extract_year(df))


def test_hot_key_is_split_when_the_panel_looks_it_up(spark):
    rows = [(day(30), f"R{i}.N", None, "100000103" if i % 2 else f"{i:06d}103", None, i) for i in range(8000)]
    raw = spark.createDataFrame(rows, "date date, ric string, isin string, cusip string, ticker string, row_id long")
    snaps = month_snapshots(clean_constituents(raw.repartition(8), keep=["row_id"]))
    small = hot_master(spark, 600)
    with small_thresholds(spark):
        plan = executed(panel.panel_best(snaps, small))
        assert any("skew=true" in line and "LeftOuter" in line for line in plan.splitlines())
