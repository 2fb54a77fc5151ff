"""Stream state: the same table as by looking earlier batches up, late files, restarts."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql.types import _parse_datatype_string

from idlink.operators.snapshots import dedup_date_ric
from idlink.streaming.snapshots import accumulate

SCHEMA = "date date, ric string, isin string, cusip string, row_id long"


def drop_file(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, path, delay, name="out"):
    table, check = str(path / name), str(path / f"{name}-check")
    return accumulate(spark, f"{path}/in/*", _parse_datatype_string(SCHEMA), table, check, delay=delay)


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("date", "ric", "isin", "cusip", "ticker", "row_id").collect())


def test_state_gives_the_same_table_over_restarts(spark, tmp_path):
    rng = random.Random(6)
    every = []
    for month in range(1, 5):
        rows = []
        for _ in range(40):
            back = rng.choice([0, 0, 0, 1]) if month > 1 else 0  # some files repeat the month before
            date = dt.date(2000, month - back, 28)
            rows.append((date, f"R{rng.randrange(15)}.N", rng.choice([None, "I"]), str(rng.randrange(9)), len(every) + len(rows)))
        rng.shuffle(rows)
        every += rows
        drop_file(spark, tmp_path / "in", f"m{month}", rows)
        by_state = run(spark, tmp_path, "400 days")
        by_table = run(spark, tmp_path, None, "plain")
    assert rows_of(by_state) == rows_of(by_table)
    want = dedup_date_ric(spark.createDataFrame(every, SCHEMA), ["row_id"])
    assert by_state.count() == want.count()
    assert rows_of(run(spark, tmp_path, "400 days")) == rows_of(by_state)


def test_rows_that_come_too_late_are_dropped_and_logged(spark, tmp_path, caplog):
    day = dt.date
    drop_file(spark, tmp_path / "in", "a", [(day(2000, 1, 31), "A.N", None, "1", 1)])
    run(spark, tmp_path, "40 days")
    drop_file(spark, tmp_path / "in", "b", [(day(2000, 6, 30), "A.N", None, "1", 2), (day(2000, 5, 31), "B.N", None, "1", 3)])
    run(spark, tmp_path, "40 days")
    # Within 40 days of the newest date: one row is new, one is known. Beyond: dropped, known or not.
    late = [(day(2000, 5, 31), "C.N", None, "1", 4), (day(2000, 5, 31), "B.N", "x", "1", 5), (day(2000, 1, 31), "A.N", "x", "1", 6), (day(2000, 1, 31), "Z.N", None, "1", 7)]
    drop_file(spark, tmp_path / "in", "c", late)
    found = run(spark, tmp_path, "40 days")
    assert sorted(r.row_id for r in found.collect()) == [1, 2, 3, 4]
    assert caplog.text.count("rows that came later than 40 days were dropped") == 1


def test_nulls_sort_last_and_first_batch_wins(spark, tmp_path):
    date = dt.date(2000, 1, 31)
    drop_file(spark, tmp_path / "in", "a", [(date, "A.N", "later", "1", None), (date, "A.N", "first", "1", 8)])
    run(spark, tmp_path, "10 days")
    drop_file(spark, tmp_path / "in", "b", [(date, "A.N", "smaller", "1", 1)])
    assert [r.isin for r in run(spark, tmp_path, "10 days").collect()] == ["first"]
