"""Top-1 per group with a total order.

`row_number() == 1` is planned with a group limit on both sides of the shuffle, so a
task sends at most one row per group and a hot group never travels whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asc(*names: str) -> list[Column]:
    """Ascending, nulls last."""
    return [F.col(n).asc_nulls_last() for n in names]


def desc(*names: str) -> list[Column]:
    """Descending, nulls last."""
    return [F.col(n).desc_nulls_last() for n in names]


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Iterable[Column]) -> DataFrame:
    """The first row of each group; nulls in `keys` are equal to each other."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def source_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> list[Column]:
    """Order for "first row wins": the given columns, else every non-key column ascending."""
    return asc(*(order_by or [c for c in df.columns if c not in keys]))
