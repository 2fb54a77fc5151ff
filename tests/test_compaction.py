"""Compaction: readers see the same rows before, between and after its steps."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql.types import _parse_datatype_string

from idlink.streaming import compaction
from idlink.streaming.snapshots import accumulate, merge_batch

SCHEMA = "date date, ric string, isin string, cusip string, row_id long"


def batch(spark, *rows):
    return spark.createDataFrame([(dt.date(y, m, 28), ric, None, "1", i) for y, m, ric, i in rows], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_batch(batch(spark, (2000, 1, "A.N", 1), (2000, 1, "B.N", 2), (2001, 1, "A.N", 3)), 0, path, ["row_id"])
    merge_batch(batch(spark, (2000, 2, "A.N", 4), (2001, 2, "A.N", 5)), 1, path, ["row_id"])
    merge_batch(batch(spark, (2000, 2, "C.N", 6), (2002, 2, "A.N", 7)), 2, path, ["row_id"])
    return path


def rows_of(spark, path):
    return sorted(tuple(r) for r in compaction.read_table(spark, path).select("row_id", "date", "ric", "year", "batch_id").collect())


def folders(path, year):
    return sorted(os.listdir(f"{path}/year={year}")) if os.path.isdir(f"{path}/year={year}") else []


def test_compaction_keeps_rows_and_merges_closed_years(spark, table):
    before = rows_of(spark, table)
    assert [r[0] for r in before] == [1, 2, 3, 4, 5, 6, 7]
    sets = compaction.compact(spark, table, before_year=2002)
    assert {y: s.last_batch for y, s in sets.items()} == {2000: 2, 2001: 1}
    assert rows_of(spark, table) == before
    assert len([f for f in os.listdir(f"{table}/{sets[2000].folder}") if f.endswith(".parquet")]) == 1
    assert len(folders(table, 2000)) == 3  # still there for readers that have planned with them
    assert compaction.vacuum(spark, table) == 2
    assert rows_of(spark, table) == before and folders(table, 2000) == [] and folders(table, 2002) == ["batch_id=2"]
    assert compaction.compact(spark, table, before_year=2002) == sets and compaction.vacuum(spark, table) == 0


def test_new_batches_join_a_compacted_year(spark, table):
    compaction.compact(spark, table)
    compaction.vacuum(spark, table)
    merge_batch(batch(spark, (2000, 1, "A.N", 90), (2000, 3, "A.N", 8), (2002, 2, "A.N", 91)), 3, table, ["row_id"])
    assert [r[0] for r in rows_of(spark, table)] == [1, 2, 3, 4, 5, 6, 7, 8]
    merge_batch(batch(spark, (2000, 4, "A.N", 9)), 4, table, ["row_id"])
    sets = compaction.compact(spark, table)
    assert sets[2000].last_batch == 4 and sets[2001].last_batch == 1
    compaction.vacuum(spark, table)
    assert [r[0] for r in rows_of(spark, table)] == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert len(os.listdir(f"{table}/_compacted")) == 2 and len([n for n in os.listdir(f"{table}/_manifest") if n.endswith(".json")]) == 1


def test_crash_before_the_commit_changes_nothing(spark, table, monkeypatch):
    before = rows_of(spark, table)

    def crash(*args):
        raise OSError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(compaction.Folder, "write_new", crash)
        with pytest.raises(OSError):
            compaction.compact(spark, table)
    assert compaction.manifest(spark, table) == (0, {}) and len(os.listdir(f"{table}/_compacted")) == 2
    assert rows_of(spark, table) == before
    compaction.compact(spark, table)
    assert rows_of(spark, table) == before
    compaction.vacuum(spark, table)  # takes the orphans along
    assert rows_of(spark, table) == before and len(os.listdir(f"{table}/_compacted")) == 2


def test_repeated_batch_after_compaction_is_skipped(spark, table):
    before = rows_of(spark, table)
    compaction.compact(spark, table)
    merge_batch(batch(spark, (2000, 2, "C.N", 6), (2002, 2, "A.N", 7)), 2, table, ["row_id"])
    assert rows_of(spark, table) == before
    compaction.vacuum(spark, table)
    merge_batch(batch(spark, (2000, 2, "C.N", 6), (2002, 2, "A.N", 7)), 2, table, ["row_id"])
    assert rows_of(spark, table) == before


def test_manifest_is_not_overwritten(spark, table):
    compaction.compact(spark, table)
    folder = compaction.Folder(spark, table)
    with pytest.raises(FileExistsError):
        folder.write_new("_manifest/00000001.json", "{}")
    assert compaction.manifest(spark, table)[0] == 1
    assert [n for n in os.listdir(f"{table}/_manifest") if n.startswith(".") and not n.endswith(".crc")] == []


def test_stream_goes_on_after_compaction(spark, tmp_path):
    source, path, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    schema = _parse_datatype_string(SCHEMA)
    for i, month in enumerate((1, 2, 3)):
        batch(spark, (2000, month, "A.N", i), (2000, 1, "A.N", 50 + i)).coalesce(1).write.parquet(f"{source}/m{i}")
        accumulate(spark, f"{source}/*", schema, path, check)
        compaction.compact(spark, path)
        compaction.vacuum(spark, path)
    assert sorted(r.row_id for r in accumulate(spark, f"{source}/*", schema, path, check).collect()) == [0, 1, 2]
    assert compaction.compact(spark, str(tmp_path / "none")) == {}
