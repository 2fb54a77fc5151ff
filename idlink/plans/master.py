"""The security master: linked segments with flags and the primary security of each firm."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from idlink.operators.primary import primary_map, with_primary
from idlink.operators.segments import NAME_ORDER, Stage, best_links, with_flags
from idlink.schemas import SECURITY_MASTER
from idlink.session import path_exists, shuffles_dropped
from idlink.sources.sinks import write_master


def linked_segments(
    names: DataFrame, links: DataFrame, order_by: Sequence[str] = NAME_ORDER, stage: Stage | None = None
) -> DataFrame:
    """Best link and flags per segment, before the primary security is known."""
    return with_flags(best_links(names, links, order_by, stage))


def build_security_master(
    names: DataFrame,
    links: DataFrame,
    order_by: Sequence[str] = NAME_ORDER,
    stage: Stage | None = None,
) -> DataFrame:
    """The 30-column master from clean names and links.

    The linked segments feed both the choice of primaries and the final rows. `stage`
    (see `sinks.stored`) writes them, and the reduced links, once to the shared folder
    instead of linking twice.
    """
    segments = linked_segments(names, links, order_by, stage)
    if stage is not None:
        segments = stage(segments)
    return with_primary(segments, primary_map(segments)).select(*SECURITY_MASTER.columns)


def get_or_build_table(spark: SparkSession, path: str, build: Callable[[], DataFrame], write=None) -> DataFrame:
    """The table stored at `path`, else build it, store it and read it back.

    Only a table with its success marker counts as stored: a write that was cut short is done again.
    Any other error while reading is an error.
    """
    if not path_exists(spark, path, "_SUCCESS"):
        table = build()
        with shuffles_dropped(spark):
            (write or (lambda df, p: df.write.mode("overwrite").parquet(p)))(table, path)
    return spark.read.parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stored stage. Intermediate tables stay in the shared folder until this is called."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def get_or_build_master(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    return get_or_build_table(spark, path, build, write_master)
