"""Bad lines of delimited files, dates parsed once, columns of moments, headers alike."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from idlink.functions import coerce
from idlink.schemas import DATE_SHAPES
from idlink.sources import conform, readers

LINES = [
    "Id,Date,Name",
    "1,2001-01-01,plain",
    "2,2001-01-01,B,EXTRA",
    '3,2001-01-01,"quoted, comma"',
    '4,"2001-01-01","a ""b"", c",',
    "5,2001-01-01",
    "6",
    '7,"2001-01-01,open',
    "8,,",
    '9,2001-01-01,5" pipe',
]


@pytest.fixture
def ragged(tmp_path):
    (tmp_path / "r.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "r.csv")


def test_bad_rows_fail_by_default(spark, ragged):
    for columns in (None, ["id"]):
        with pytest.raises(Exception, match="bad row"):
            readers.read_delimited(spark, ragged, columns=columns).collect()
        with pytest.raises(Exception, match="bad row"):
            readers.read_delimited(spark, ragged, columns=columns).count()


def test_quarantine_takes_bad_rows_and_no_others(spark, ragged, tmp_path, caplog):
    good = readers.read_delimited(spark, ragged, quarantine=str(tmp_path / "q"), ordered=True)
    assert "3 bad rows" in caplog.text
    kept = {r.id: (r.date, r.name) for r in good.collect()}
    assert kept == {
        "1": ("2001-01-01", "plain"), "3": ("2001-01-01", "quoted, comma"), "5": ("2001-01-01", None), "6": (None, None),
        "8": (None, None), "9": ("2001-01-01", '5" pipe'),
    }
    bad = spark.read.parquet(str(tmp_path / "q")).orderBy(readers.ROW).collect()
    assert [(r.reason, r.fields, r.line) for r in bad] == [
        ("surplus", 4, LINES[2]),
        ("surplus", 4, LINES[4]),
        ("quotes", 3, LINES[7]),
    ]
    assert all(r[readers.FILE].endswith("r.csv") and r[readers.BLOCK] == 0 for r in bad)
    # A second file adds to the folder.
    readers.read_delimited(spark, ragged, quarantine=str(tmp_path / "q"), short_rows="bad")
    assert spark.read.parquet(str(tmp_path / "q")).groupBy("reason").count().orderBy("reason").collect() == [
        ("quotes", 2), ("short", 2), ("surplus", 4),
    ]


def test_clean_files_have_no_bad_rows(spark, tmp_path):
    (tmp_path / "c.csv").write_text('a;b\n1;"x;\ny"\n2;z\n')
    options = {"sep": ";", "multiLine": "true"}
    rows = readers.read_delimited(spark, str(tmp_path / "c.csv"), quarantine=str(tmp_path / "q"), **options).collect()
    assert [tuple(r) for r in rows] == [("1", "x;\ny"), ("2", "z")]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 0
    assert readers.read_delimited(spark, str(tmp_path / "c.csv"), short_rows="bad", **options).count() == 2
    with pytest.raises(ValueError, match="short_rows"):
        readers.read_delimited(spark, str(tmp_path / "c.csv"), short_rows="x")


def test_bad_rows_of_annual_files(spark, tmp_path):
    folder = tmp_path / "annual"
    folder.mkdir()
    (folder / "f 2004.csv").write_text("IssuerId,x\nI1,1\nI2,2,3\n")
    (folder / "g 2005.csv").write_text("IssuerId\nI3\nI4,9\n")
    rows = readers.read_annual(spark, str(folder), ["issuerid"], quarantine=str(tmp_path / "q"))
    assert sorted((r.issuerid, r.year) for r in rows.collect()) == [("I1", 2004), ("I3", 2005)]
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "q")).collect()) == ["I2,2,3", "I4,9"]
    with pytest.raises(Exception, match="bad row"):
        readers.read_annual(spark, str(folder), ["issuerid"]).collect()


def test_date_of_shape_is_parse_date(spark):
    texts = [
        "2020-02-29", "2021-02-29", "20200131", "2020-1-5", "1/31/2020", "31/1/2020", "2020/1/5", "1/5/68", "1/5/69", "31-Dec-2020", "31DEC2020",
        "Dec 31, 2020", "Dec. 1, 2020", "Foo 1, 2020", "", "x", None, "2020", "12/2020", "99999999",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    one_by_one = F.coalesce(*[coerce.parse_date(t, f) for f in DATE_SHAPES])
    rows = df.select("t", one_by_one.alias("a"), coerce.parse_any_date(t).alias("b"), coerce.date_of_shape(t, coerce.shape_number(t)).alias("c")).collect()
    assert all(r.a == r.b == r.c for r in rows) and sum(r.a is not None for r in rows) == 11
    assert all(sum(bool(r[0]) for r in df.select(t.rlike(s)).where(t.isNotNull()).collect()) > 0 for s, _ in DATE_SHAPES.values())


def test_moments_of_any_type(spark):
    day = dt.datetime(2015, 12, 31, 23, 30)
    df = spark.createDataFrame([(1, day), (2, None)], "k int, t timestamp_ntz")
    kinds = {
        "timestamp": F.to_utc_timestamp("t", "UTC").cast("timestamp"),
        "timestamp_ntz": F.col("t"),
        "date": F.col("t").cast("date"),
        "milliseconds": F.lit(1451604600000),
        "text": F.lit("1451604600000"),
    }
    for name, column in kinds.items():
        raw = df.where("k = 1").select(column.alias("periodEndDate"))
        assert tuple(conform.epoch_year(raw).select("period_end", "year").first()) == (day.date(), 2015), name
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        raw = df.where("k = 1").select(F.timestamp_millis(F.lit(1451604600000)).alias("periodEndDate"))
        assert conform.epoch_year(raw).first()["year"] == 2015
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert conform.epoch_year(df.where("k = 2").withColumnRenamed("t", "periodEndDate")).first()["year"] is None


def test_first_of_headers_alike(spark, caplog):
    df = spark.createDataFrame([("2020-01-31", "R.N", "US1", "US2")], "Date string, RIC string, `ISIN Old` string, `ISIN New` string")
    row = conform.clean_constituents(df).first()
    assert (row.isin, row.ric) == ("US1", "R.N") and "ISIN Old" in caplog.text
