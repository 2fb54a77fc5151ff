from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType

from idlink.functions import coerce, dates, identifiers, scores


def values(spark, inputs, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def test_norm_string_strips_all_whitespace_and_blanks(spark):
    got = values(spark, ["\t ab ", "  ", None, "x"], identifiers.norm_string)
    assert got == ["AB", None, None, "X"]


def test_norm_gvkey(spark):
    got = values(spark, [" 1234.0", "G-00123", "", "12345678", None, "abc", "1.0.0"], identifiers.norm_gvkey)
    assert got == ["001234", "000123", None, "12345678", None, None, "000010"]


def test_cusip6_from_isin_needs_country_and_length(spark):
    got = values(spark, ["US0378331005", "CA0378331005", "GB0378331005", "US037833", None], identifiers.isin_cusip6)
    assert got == ["037833", "037833", None, None, None]


def test_clean_symbol_also_strips_share_classes(spark):
    got = values(spark, ["BRK.B", "VOD.L", "A.1", "X.n", None], identifiers.clean_symbol)
    assert got == ["BRK", "VOD", "A.1", "X.n", None]


def test_ric_ticker(spark):
    assert values(spark, ["aapl.OQ", "IBM", ".N", None], identifiers.ric_ticker) == ["AAPL", "IBM", None, None]


def test_null_tokens_hit_a_real_ticker(spark):
    assert values(spark, ["NA", "NAN", "null", "", " "], coerce.null_tokens) == [None, "NAN", None, None, " "]


def test_null_tokens_by_name_agree(spark):
    tokens = (*coerce.NULL_TOKENS, "it's")
    df = spark.createDataFrame([(t,) for t in (*tokens, "x", " NA", None)], "v string")
    both = df.select(coerce.null_tokens(F.col("v"), tokens).alias("a"), coerce.null_tokens_of("v", tokens).alias("b"))
    assert both.where("NOT a <=> b").count() == 0 and both.where("a IS NOT NULL").count() == 2


def test_integer_coercion(spark):
    got = values(spark, ["12", "12.0", " 7 ", "12.5", "x", None], lambda c: coerce.to_integer(c, LongType()))
    assert got == [12, 12, 7, None, None, None]


def test_boolean_coercion_by_source_type(spark):
    assert values(spark, [" True ", "y", "1", "1.0", "no", None], coerce.to_boolean) == [True, True, True, False, False, False]
    numbers = values(spark, [0.0, 2.5, None], lambda c: coerce.to_boolean(c, DoubleType()), "double")
    assert numbers == [False, True, False]
    flags = values(spark, [True, None], lambda c: coerce.to_boolean(c, BooleanType()), "boolean")
    assert flags == [True, False]


def test_dates_by_value_and_out_of_range_is_open(spark):
    texts = ["2001-02-03", "20010203", "02/03/2001", "2/3/2001", "2001-02-03 10:00:00", "E", "9999-12-31", "2001-02-30"]
    day = dt.date(2001, 2, 3)
    assert values(spark, texts, coerce.to_date) == [day] * 5 + [None] * 3
    assert values(spark, ["E"], lambda c: coerce.open_end(coerce.to_date(c))) == [dt.date(2262, 4, 11)]


def test_other_spellings_of_dates(spark):
    texts = ["2020/12/31", "12/31/20", "31-Dec-2020", "31DEC2020", "Dec 31, 2020", "December 31 2020", "31 december 2020", "2020-12-31T10:00Z"]
    assert values(spark, texts, coerce.to_date) == [dt.date(2020, 12, 31)] * len(texts)
    assert values(spark, ["12/31/99", "1/1/68"], coerce.to_date) == [dt.date(1999, 12, 31), dt.date(2068, 1, 1)]
    assert values(spark, ["31-Foo-2020", "31-Decem-2020", "Dec 32, 2020", "2020-12-31 x", ""], coerce.to_date) == [None] * 5


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_epoch_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, [978307199999, -1], coerce.epoch_ms_date, "bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.date(2000, 12, 31), dt.date(1969, 12, 31)]


def test_absurd_years_and_epochs_are_null(spark):
    years = [-5, 1677, 1678, 2261, 2262, 20010, 2147483647, None]
    starts = values(spark, years, dates.year_start, "int")
    ends = values(spark, years, dates.year_end, "int")
    assert [d and d.year for d in starts] == [None, None, 1678, 2261, 2262, None, None, None]
    assert [d and d.year for d in ends] == [None, 1678, 1679, 2262, None, None, None, None]
    millis = lambda c: coerce.in_range(coerce.epoch_ms_date(c))
    assert values(spark, [9 * 10**18, -9 * 10**18, None], millis, "bigint") == [None, None, None]


def overlap(spark, a, b, c, d, fn=dates.overlap_days):
    schema = "a string, b string, c string, d string"
    df = spark.createDataFrame([(a, b, c, d)], schema).select(*[F.col(x).cast("date") for x in "abcd"])
    return df.select(fn(*[F.col(x) for x in "abcd"]).alias("o")).first()["o"]


def test_overlap_end_is_exclusive(spark):
    year = ("2001-01-01", "2002-01-01")
    assert overlap(spark, *year, "2001-01-01", "2001-12-31") == 364
    assert overlap(spark, "2004-01-01", "2005-01-01", "2004-01-01", "2004-12-31") == 365
    assert overlap(spark, *year, "2002-01-01", "2003-01-01") == 0
    assert overlap(spark, *year, None, "2003-01-01") is None


def test_builder_overlap_needs_touching_intervals(spark):
    fn = dates.touching_overlap_days
    assert overlap(spark, "2001-01-01", "2001-06-30", "2001-06-30", "2002-01-01", fn) == 0
    assert overlap(spark, "2001-01-01", "2001-06-30", "2001-06-01", "2002-01-01", fn) == 29
    assert overlap(spark, "2001-01-01", "2001-06-30", "1900-01-01", "2262-04-11", fn) == 180
    assert overlap(spark, "2001-01-01", "2001-06-30", None, "2002-01-01", fn) == 0


def test_labels_and_flags(spark):
    assert values(spark, [10, 11, 12, None], scores.is_common, "int") == [True, True, False, False]
    assert values(spark, [12, 13], lambda c: scores.is_common(c, (10, 11, 12)), "int") == [True, False]
    assert values(spark, [1, 2, 3, 4, None], scores.exchange_label, "int") == ["NYSE", "AMEX", "NASDAQ", None, None]
    assert values(spark, ["P", "C", "J", None], scores.linkprim_score) == [1, 1, 0, 0]
    assert values(spark, ["LU", "LC", "NR", None], scores.linktype_rank) == [2, 1, 0, 0]


def test_segment_score_terms(spark):
    rows = [(True, True, 1, 366, 1, 2), (False, False, 2, 364, 0, 0), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "c boolean, p boolean, e int, o int, lp int, lt int")
    out = df.select(scores.segment_score(*[F.col(x) for x in ("c", "p", "e", "o", "lp", "lt")]).alias("s")).collect()
    assert [r["s"] for r in out] == [3 + 2 + 1 + 1 + 1 + 2, 0, 0]
    assert df.select(scores.segment_score(*[F.col(x) for x in df.columns])).schema[0].dataType == IntegerType()
