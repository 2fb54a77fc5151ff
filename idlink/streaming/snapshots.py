"""Resumable accumulation of constituent files with Structured Streaming."""

from __future__ import annotations

import logging
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.functions import identifiers
from idlink.operators.ranking import asc, keep_first
from idlink.session import path_exists
from idlink.sources.sinks import append_batch
from idlink.streaming.compaction import has_rows, read_table

log = logging.getLogger(__name__)

KEY = ["date", "ric"]


def _labelled(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.withColumns(
        {
            "ticker": identifiers.ric_ticker(F.col("ric")),
            "year": F.year("date"),
            "batch_id": F.lit(batch_id).cast("long"),
        }
    )


def first_arrivals(rows: DataFrame, order_by: Sequence[str], delay: str) -> DataFrame:
    """Per (date, ric) the row that came first, kept as stream state until the watermark passes its date.

    All rows of a micro-batch arrive at its one timestamp, which a repeated batch has again; within
    a batch `order_by` decides. `last` is when the key was last seen: it is new where that is when it first came.
    Rows older than the newest date by more than `delay` come too late and are dropped.
    """
    order = [x for c in order_by for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c).alias(f"_by_{c}"))]
    arrived = F.current_timestamp().alias("arrived")
    stamped = rows.select(F.col("date").cast("timestamp").alias("moment"), F.col("ric"), F.struct(arrived, *order, F.struct("*").alias("row")).alias("entry"))
    kept = stamped.withWatermark("moment", delay).groupBy("moment", "ric")
    return kept.agg(F.min("entry").alias("first"), F.max("entry.arrived").alias("last"))


def merge_batch(batch: DataFrame, batch_id: int, table: str, order_by: Sequence[str]) -> None:
    """Add the first row of every (date, ric) that no earlier batch has delivered.

    The output of a batch lives in its own (year, batch_id) partitions, which a repeated
    batch overwrites: with the query's checkpoint that makes each batch count once.
    The batch's own years, few as dates are bounded, are the partitions read back of the table.
    All batches but this one count as known.
    """
    spark = batch.sparkSession
    rows = _labelled(keep_first(batch, KEY, asc(*order_by)), batch_id)
    if has_rows(spark, table):
        years = [r["year"] for r in rows.select("year").distinct().collect()]
        known = read_table(spark, table, rows.schema).where(F.col("year").isin(years) & (F.col("batch_id") != batch_id))
        rows = rows.join(known.select(*KEY, "year"), [*KEY, "year"], "left_anti")
    append_batch(rows, table, ["year", "batch_id"], KEY)


def accumulate(
    spark: SparkSession,
    source: str,
    schema: StructType,
    table: str,
    checkpoint: str | None = None,
    order_by: Sequence[str] = ("row_id",),
    transform=None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    pattern: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Process the constituent files that arrived since the last run, then return the table.

    What earlier batches delivered is looked up in the years of a batch. With a `delay` (such as
    `400 days`) it is kept as stream state instead, and no year is read again: the state holds the
    keys of that many days, and rows that come later still are dropped, which is logged. A table is
    built either way, but not by both in turn. Large states belong in the RocksDB state store.

    `transform` shapes a raw batch into (date, ric, ...) rows and may be any stateless
    DataFrame function. A table without its checkpoint is refused: batch numbers would start again
    and overwrite what earlier batches delivered.
    """
    checkpoint = checkpoint or os.path.join(table, "_checkpoint")
    if has_rows(spark, table) and not path_exists(spark, checkpoint):
        raise ValueError(f"{table} has batches, but their checkpoint {checkpoint} is gone")
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    shaped = transform or (lambda df: df)

    def by_table(batch: DataFrame, batch_id: int) -> None:
        merge_batch(shaped(batch), batch_id, table, order_by)

    def by_state(batch: DataFrame, batch_id: int) -> None:
        new = batch.where(F.col("first.arrived") == F.col("last")).select("first.row.*")
        append_batch(_labelled(new, batch_id), table, ["year", "batch_id"], KEY)

    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    stream = reader.load(source)
    if delay:
        writer = first_arrivals(shaped(stream), order_by, delay).writeStream.outputMode("update").foreachBatch(by_state)
    else:
        writer = stream.writeStream.foreachBatch(by_table)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if any(state.numRowsDroppedByWatermark for p in query.recentProgress for state in p.stateOperators):
        log.warning("rows that came later than %s were dropped", delay)
    if has_rows(spark, table):
        return read_table(spark, table)
    # No file has come yet: the empty table.
    columns = shaped(spark.createDataFrame([], schema))
    return columns.withColumns({"ticker": F.lit("").cast("string"), "year": F.lit(0), "batch_id": F.lit(0).cast("long")})
