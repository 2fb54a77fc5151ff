"""Sinks. Parquet between stages; delimited text is an export format."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from idlink.operators.reports import unmatched_constituents
from idlink.session import scratch_path, shuffles_dropped


# Without the last two the writer trims texts.
_TEXT_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def stored(spark: SparkSession, name: str) -> Callable[..., DataFrame]:
    """A stage that writes a frame to the shared folder and reads it back.

    It cuts lineage in a way that survives lost executors. Columns named after the frame
    become directories, so that a filter on them leaves a table whose size is known.
    """

    def write_and_read(df: DataFrame, *partitions: str) -> DataFrame:
        path = scratch_path(spark, name)
        with shuffles_dropped(spark):
            df.write.partitionBy(*partitions).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write_and_read


def write_quarantine(lines: DataFrame, path: str) -> int:
    """Adds lines to a folder of bad input and returns how many they are, counted while they are written."""
    count = Observation()
    lines.observe(count, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return count.get["n"]


def write_sorted(df: DataFrame, path: str, sort: Sequence[str], fmt: str = "parquet") -> None:
    """Range-partitioned, sorted output: sorted as a whole, written in parallel."""
    ordered = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    ordered.write.mode("overwrite").format(fmt).options(**(_TEXT_OPTIONS if fmt == "csv" else {})).save(path)


def write_by(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str]) -> None:
    """Directory per `partitions` value. Ranges over the sort key split a large value over many tasks."""
    ordered = df.repartitionByRange(*partitions, *sort).sortWithinPartitions(*partitions, *sort)
    ordered.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_master(master: DataFrame, path: str) -> None:
    write_sorted(master, path, ["permno", "namedt", "nameendt"])


def write_primary_table(table: DataFrame, path: str) -> None:
    write_sorted(table, path, ["gvkey"])


def write_matches(matches: DataFrame, path: str, entity: str) -> None:
    """Year matches, with a `provider` column, one directory per provider."""
    write_by(matches, path, ["provider"], [entity, "year"])


def write_crosswalks(consolidated: DataFrame, path: str) -> None:
    write_by(consolidated, path, ["provider"], ["entity_id"])


def write_panel(panel: DataFrame, path: str) -> None:
    """By year; the security's keys part the members of a date that have no firm."""
    write_by(panel, path, ["year"], ["date", "gvkey", *[c for c in ("cusip_sp500", "ticker_sp500") if c in panel.columns]])


def write_grid(grid: DataFrame, path: str) -> None:
    write_by_suffix(grid, path, [c for c in ("gvkey", "year") if c in grid.columns])


def write_audit(sample: DataFrame, path: str) -> None:
    write_by_suffix(sample, path, [c for c in ("date", "gvkey") if c in sample.columns])


def write_by_suffix(df: DataFrame, path: str, sort: Sequence[str]) -> str:
    """Format from the path's suffix: parquet, else delimited text. Workbooks are not written."""
    if path.lower().endswith((".xlsx", ".xls")):
        raise ValueError("workbooks are not supported; use .parquet or .csv")
    fmt = "parquet" if path.lower().endswith(".parquet") else "csv"
    write_sorted(df, path, sort, fmt)
    return fmt


def write_unmatched(panel: DataFrame, path: str) -> None:
    write_sorted(unmatched_constituents(panel), path, ["date", "cusip_sp500", "ticker_sp500"], "csv")


def append_batch(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str]) -> None:
    """Replace exactly the partitions present in `df`, so that a repeated batch is harmless."""
    ordered = df.repartitionByRange(*partitions, *sort).sortWithinPartitions(*partitions, *sort)
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)
