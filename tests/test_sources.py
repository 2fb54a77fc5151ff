"""Readers, sinks and the incremental job."""

from __future__ import annotations

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from idlink.plans.master import get_or_build_master, get_or_build_table
from idlink.session import scratch_path, shared_dir
from idlink.sources import conform, readers, sinks
from idlink.streaming.snapshots import accumulate


def write(path, *lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


def test_headers_and_selection(spark, tmp_path):
    path = write(tmp_path / "x.csv", "PERMNO,Ticker,Extra", "1, a ,z", "2,NA,z")
    df = readers.read_delimited(spark, path, columns=["permno", "TICKER"])
    assert df.columns == ["permno", "ticker"]
    assert [tuple(r) for r in df.orderBy("permno").collect()] == [("1", " a "), ("2", "NA")]
    df.collect()
    assert "Extra" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_encodings(spark, tmp_path):
    path = write(tmp_path / "l.csv", "name", "Société", encoding="latin-1")
    assert readers.read_delimited(spark, path, encoding="ISO-8859-1").first().name == "Société"


def test_first_row_wins_in_file_order(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "orgpermid,year,cusip", "E,2001,first", "E,2001,second")
    write(tmp_path / "d" / "b.csv", "orgpermid,year,cusip", "E,2001,third", "F,2001,x")
    raw = readers.read_delimited(spark, str(tmp_path / "d"), ordered=True)
    rows = conform.clean_provider_a(raw, readers.SOURCE_ORDER).orderBy("orgpermid").collect()
    assert [(r.orgpermid, r.cusip) for r in rows] == [("E", "FIRST"), ("F", "X")]


B = ["ISSUERID", "ISSUER_NAME", "ISSUER_CUSIP"]


def annual(spark, path, **options):
    raw = readers.read_annual(spark, str(path), [c.lower() for c in B], **options)
    return {r.issuerid: r.year for r in raw.collect()}


def test_year_column_decides(spark, tmp_path):
    write(tmp_path / "r 1999.csv", "ISSUERID,YEAR,AS_OF_DATE", "A,2001,1990-01-01", "B,x,1990-01-01")
    assert annual(spark, tmp_path) == {"A": 2001, "B": None}


def test_format_is_chosen_per_file(spark, tmp_path):
    write(tmp_path / "one.csv", "ISSUERID,AS_OF_DATE", "A,20010203", "B,2002-01-01", "C,")
    write(tmp_path / "two.csv", "ISSUERID,AS_OF_DATE", "D,2002-01-01", "E,03/04/2003")
    write(tmp_path / "three.csv", "ISSUERID,Period,DATE", "F,2004-01-01,bad", "G,2005-05-05,bad")
    assert annual(spark, tmp_path) == {"A": 2001, "B": None, "C": None, "D": 2002, "E": None, "F": 2004, "G": 2005}


def test_file_name_gives_the_year_when_no_date_does(spark, tmp_path):
    write(tmp_path / "Ratings 2007 v1999.csv", "ISSUERID,AS_OF_DATE", "A,nothing")
    write(tmp_path / "report=2008" / "part-000.csv", "ISSUERID,ISSUER_NAME", "B,n")
    write(tmp_path / "plain.csv", "ISSUERID,ISSUER_NAME", "C,n")
    assert annual(spark, tmp_path) == {"A": 2007, "B": 2008, "C": None}


def test_unusable_files_are_skipped(spark, tmp_path):
    write(tmp_path / "good 2001.csv", "ISSUERID,ISSUER_NAME", "A,n")
    write(tmp_path / "other.csv", "FOO,BAR", "1,2")
    with gzip.open(tmp_path / "cut.csv.gz", "wb") as f:
        f.write(b"ISSUERID,ISSUER_NAME\n" * 50000)
    data = (tmp_path / "cut.csv.gz").read_bytes()
    (tmp_path / "cut.csv.gz").write_bytes(data[: len(data) // 2])
    rows = annual(spark, tmp_path, skip_corrupt=True)
    assert rows.get("A") == 2001
    with pytest.raises(FileNotFoundError):
        readers.read_annual(spark, write(tmp_path / "n" / "x.csv", "FOO", "1"), ["issuerid"])


def test_year_by_file(spark):
    rows = [("a 2001.csv", None, 1), ("b.csv", "2003-04-05", 2), ("b.csv", "03/04/2003", 3)]
    df = spark.createDataFrame(rows, "file string, date string, n int")
    assert {r.n: r.year for r in readers.extract_year(df, "file").collect()} == {1: 2001, 2: 2003, 3: None}


def test_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,comnam,ticker\n1,"ACME ""A"", INC",X\n2,"two\nlines",Y\n')
    rows = readers.read_delimited(spark, str(tmp_path / "q.csv"), multiLine="true").collect()
    assert [tuple(r) for r in rows] == [("1", 'ACME "A", INC', "X"), ("2", "two\nlines", "Y")]


def test_cp1252(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("id,name\n1,caf\u00e9 \u20ac \u201cx\u201d \u0178\n".encode("cp1252"))
    assert readers.read_delimited(spark, str(tmp_path / "c.csv"), encoding="cp1252").first()["name"] == "café € “x” Ÿ"


def test_names_like_patterns_are_files(spark, tmp_path):
    (tmp_path / "Ratings 2001 [final].csv").write_text("ISSUERID\nA\n")
    (tmp_path / "Ratings 2002 {x}.csv").write_text("ISSUERID\nB\n")
    rows = readers.read_annual(spark, str(tmp_path), ["issuerid"])
    assert {(r.issuerid, r.year) for r in rows.collect()} == {("A", 2001), ("B", 2002)}


def test_cut_file_is_not_a_short_file(spark, tmp_path):
    import gzip

    whole = gzip.compress(("ISSUERID\n" + "\n".join(map(str, range(200_000)))).encode())
    (tmp_path / "r 2001.csv.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):  # noqa: B017
        readers.read_annual(spark, str(tmp_path), ["issuerid"]).count()


def test_half_written_table_is_built_again(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(10).repartition(2).write.parquet(path)
    (tmp_path / "m" / "_SUCCESS").unlink()
    from idlink.plans.master import drop_stage, get_or_build_table

    assert get_or_build_table(spark, path, lambda: spark.range(10)).count() == 10
    assert get_or_build_table(spark, path, lambda: 1 / 0).count() == 10
    drop_stage(spark, path)
    assert not (tmp_path / "m").exists()


def test_stream_without_its_checkpoint_is_refused(spark, tmp_path):
    schema = "date date, ric string, row_id int"
    spark.sql("SELECT DATE'2020-01-31' AS date, 'B.N' AS ric, 1 AS row_id").write.parquet(str(tmp_path / "in" / "a"))
    table, schema = str(tmp_path / "t"), spark.createDataFrame([], schema).schema
    (tmp_path / "none").mkdir()
    assert accumulate(spark, str(tmp_path / "none"), schema, str(tmp_path / "e"), str(tmp_path / "c0")).count() == 0
    assert accumulate(spark, f"{tmp_path}/in/*", schema, table, str(tmp_path / "c1")).count() == 1
    with pytest.raises(ValueError):
        accumulate(spark, f"{tmp_path}/in/*", schema, table, str(tmp_path / "c2"))


def test_headers_are_matched_by_whole_words():
    assert conform.tolerant_headers(["Price Close", "Instrument RIC"]) == {"Instrument RIC": "ric"}
    assert conform.tolerant_headers(["CUSIP old", "CUSIP new"]) == {"CUSIP old": "cusip"}


def test_tolerant_headers():
    assert conform.tolerant_headers(["Instrument", "TR.ISIN", "Other CUSIP x"]) == {
        "Instrument": "ric", "TR.ISIN": "isin", "Other CUSIP x": "cusip",
    }


def test_epoch_year_falls_back(spark):
    df = spark.createDataFrame([(0, "a")], "periodEndDate long, symbol string")
    assert conform.epoch_year(df).first().year == 1970
    df = spark.createDataFrame([(1999, "a")], "Year int, symbol string")
    assert conform.epoch_year(df).first().year == 1999
    assert conform.epoch_year(df.drop("Year")).first().year is None


def test_suffix_picks_the_format(spark, tmp_path):
    df = spark.createDataFrame([(2, " b "), (1, "a")], "k int, v string")
    assert sinks.write_by_suffix(df, str(tmp_path / "o.parquet"), ["k"]) == "parquet"
    assert sinks.write_by_suffix(df, str(tmp_path / "o.csv"), ["k"]) == "csv"
    text = readers.read_delimited(spark, str(tmp_path / "o.csv")).orderBy("k").collect()
    assert [tuple(r) for r in text] == [("1", "a"), ("2", " b ")]
    with pytest.raises(ValueError):
        sinks.write_by_suffix(df, str(tmp_path / "o.xlsx"), ["k"])


def test_master_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, dt.date(2000, 1, 1), dt.date(2001, 1, 1))], "permno long, namedt date, nameendt date")

    for _ in range(2):
        assert get_or_build_master(spark, str(tmp_path / "m"), build).count() == 1
    assert len(calls) == 1


class Session:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_shared_folder_comes_from_the_session():
    cluster = Session("yarn", "hdfs:///shared")
    assert shared_dir(cluster) == "hdfs:///shared"
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/x-")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"))
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local) != shared_dir(Session("local[3]"))


SCHEMA = "date date, ric string, isin string, cusip string, row_id long"


def drop_file(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_stream_equals_batch_over_restarts_and_repeats(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    from idlink.operators.snapshots import dedup_date_ric

    source, table, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    months = [
        [(dt.date(2000, 1, 31), "A.N", None, "1", 1), (dt.date(2000, 1, 31), "A.N", "I", "2", 2), (dt.date(2000, 1, 31), "B.N", None, None, 3)],
        [(dt.date(2000, 2, 29), "A.N", None, "3", 4), (dt.date(2000, 1, 31), "B.N", "late", "9", 5)],
        [(dt.date(2001, 1, 31), "C.N", None, "3", 6), (dt.date(2000, 2, 29), "A.N", "again", "3", 7)],
    ]
    schema = _parse_datatype_string(SCHEMA)
    for i, rows in enumerate(months):
        drop_file(spark, source, f"m{i}", rows)
        got = accumulate(spark, f"{source}/*", schema, table, check)
    every = spark.createDataFrame([r for m in months for r in m], SCHEMA)
    want = dedup_date_ric(every, ["row_id"]).select("date", "ric", "isin", "cusip", "ticker")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    again = accumulate(spark, f"{source}/*", schema, table, check)
    assert again.count() == want.count()
    assert sorted(d for d in os.listdir(table) if d.startswith("year=")) == ["year=2000", "year=2001"]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    from idlink.streaming.snapshots import merge_batch

    table = str(tmp_path / "t")
    first = spark.createDataFrame([(dt.date(2000, 1, 31), "A.N", None, None, 1)], SCHEMA)
    second = spark.createDataFrame([(dt.date(2000, 1, 31), "A.N", None, None, 2), (dt.date(2000, 1, 31), "B.N", None, None, 3)], SCHEMA)
    merge_batch(first, 0, table, ["row_id"])
    for _ in range(2):
        merge_batch(second, 1, table, ["row_id"])
    rows = spark.read.parquet(table).orderBy("ric").collect()
    assert [(r.ric, r.row_id, r.batch_id) for r in rows] == [("A.N", 1, 0), ("B.N", 3, 1)]


def test_sorted_sink(spark, tmp_path):
    df = spark.range(1000).withColumn("permno", F.rand(1)).withColumn("namedt", F.lit(1)).withColumn("nameendt", F.lit(2))
    sinks.write_master(df, str(tmp_path / "m"))
    files = sorted(p for p in os.listdir(tmp_path / "m") if p.endswith(".parquet"))
    seen = []
    for f in files:
        seen += [r.permno for r in spark.read.parquet(str(tmp_path / "m" / f)).collect()]
    assert seen == sorted(seen) and len(seen) == 1000


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    first = sinks.stored(spark, "counts")(rows)
    second = get_or_build_table(
        spark, scratch_path(spark, "counted"), lambda: sinks.stored(spark, "inner")(first.select("count").distinct()).distinct()
    )
    assert shuffle_files(spark) <= before
    assert first.count() == 700 and second.count() == 2
    assert rows.count() == 700 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
