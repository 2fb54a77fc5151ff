"""Monthly index-membership snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlink.functions import identifiers
from idlink.operators.ranking import keep_first, source_order


def month_snapshots(constituents: DataFrame) -> DataFrame:
    """All rows of the last observed date of each month, with `snapshot_date` = the month end.

    Dates reach from 1677 to 2262, so there are at most 7,021 last dates: a proven bound for
    the broadcast. A window per month would put a whole month into one task.
    """
    last_dates = (
        constituents.groupBy(F.last_day("date").alias("_month"))
        .agg(F.max("date").alias("date"))
        .select("date")
    )
    rows = constituents.join(F.broadcast(last_dates), "date", "left_semi")
    return rows.withColumn("snapshot_date", F.last_day("date"))


def dedup_date_ric(constituents: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """First row per (date, ric), with the ticker read from the instrument code."""
    keys = ["date", "ric"]
    first = keep_first(constituents, keys, source_order(constituents, keys, order_by))
    return first.withColumn("ticker", identifiers.ric_ticker(F.col("ric")))


def month_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary feed's months, and from the fallback feed only the months the primary lacks.

    Months are bounded by the calendar (see `month_snapshots`), hence the broadcast.
    """
    month = F.last_day("date")
    present = primary.select(month.alias("_month")).distinct()
    extra = fallback.withColumn("_month", month).join(F.broadcast(present), "_month", "left_anti").drop("_month")
    return primary.unionByName(extra, allowMissingColumns=True)


def month_spine(frame: DataFrame, start: Column, end: Column) -> DataFrame:
    """Month ends from `start` to `end`, both aggregates of `frame`."""
    bounds = frame.agg(start.alias("_start"), end.alias("_end"))
    months = F.sequence(F.trunc("_start", "month"), F.trunc("_end", "month"), F.expr("INTERVAL 1 MONTH"))
    spine = bounds.select("_start", "_end", F.explode(months).alias("_month"))
    return spine.select(F.last_day("_month").alias("month_end"), "_end").where("month_end <= _end").select("month_end")


def monthly_counts(constituents: DataFrame) -> DataFrame:
    """Distinct members per month."""
    return constituents.groupBy(F.last_day("date").alias("month_end")).agg(F.count_distinct("ric").alias("n_members"))


def monthly_count_summary(constituents: DataFrame) -> DataFrame:
    """Smallest, largest and mean monthly membership."""
    return monthly_counts(constituents).agg(
        F.min("n_members").alias("min_members"),
        F.max("n_members").alias("max_members"),
        F.avg("n_members").alias("avg_members"),
        F.count(F.lit(1)).alias("n_months"),
    )
