"""Equi-joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed partition of a sort-merge join into pieces of bounded
size and repeats its partner's partition for each. `session.SETTINGS` lets it do so also
where a later step would have reused the join's partitioning. It costs nothing while no
partition is skewed, but needs both sides to come straight from a shuffle made for the
join. Most joins in this package have that shape, as their inputs were grouped by other
keys before.

Where the lookup side was grouped by exactly the join key there is no such shuffle.
`spread_join` gives these joins the shape: it adds a slice number, from a hash of other
columns, to the join key, and repeats the small side once per slice. Two slices are enough:
what matters is the shuffle, after which adaptive execution splits whatever is too large.
Rows with a null key are spread without its help.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlink.session import shuffles_dropped

SLICES = 2
NULL_SLICES = 1 << 20
#: Bytes of a row of keys in a broadcast, roughly.
KEY_BYTES = 64


def crowded_keys(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame | None:
    """Keys with more than `most` rows, or None if there are none. They are counted here."""
    return counted(df.groupBy(*keys).count().where(F.col("count") > most).select(*keys))


def counted(small: DataFrame) -> DataFrame | None:
    """The small side of a join, marked for a broadcast if its rows are within Spark's own limit, else for a merge; None if empty.

    Spark only estimates sizes before it has run, and takes packed files and rows to be exploded for far
    smaller than they are. It would shuffle the large side for nothing, or send it to the driver.
    """
    spark = small.sparkSession
    with shuffles_dropped(spark):
        n = small.count()
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return None if not n else F.broadcast(small) if n * KEY_BYTES <= limit else small.hint("merge")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Join on `keys`, and `residual` if given, with the rows of each key spread over slices.

    `spread_by` are columns of `big`. Apart from `keys` the sides share no column name.
    `how` is inner or left. Rows with a null key match nothing, so they get slices that the small
    side does not have, and go to as many tasks as there are.
    """
    spread = F.xxhash64(*spread_by)
    absent = reduce(or_, [F.col(k).isNull() for k in keys])
    apart = F.lit(slices) + F.pmod(spread, F.lit(NULL_SLICES))
    left = big.withColumn("_slice", F.when(absent, apart).otherwise(F.pmod(spread, F.lit(slices))).cast("int"))
    right = small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    joined = keyed_join(left, right, [*keys, "_slice"], how, residual)
    return joined.drop("_slice")


def keyed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", residual: Column | None = None
) -> DataFrame:
    """Equi-join on same-named keys with an optional residual condition; the keys come out once, from the left."""
    partner = {k: f"_right_{k}" for k in keys}
    condition = F.lit(True) if residual is None else residual
    for k in keys:
        condition = condition & (F.col(k) == F.col(partner[k]))
    return left.join(right.withColumnsRenamed(partner), condition, how).drop(*partner.values())
