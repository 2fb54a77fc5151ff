"""Date ranges as aligned blocks, so that range conditions become equalities.

Days are the leaves of a binary tree; a block is a node of it, named by its number in heap order (the root
is 1, the children of b are 2b and 2b+1). A range of days is the disjoint union of at most two blocks per
level, and a day lies in exactly one block per level. So "the day lies in the range" is "they share a
block", and they share exactly one:

- an aggregate over all ranges that hold a day is merged from one aggregate per block above the day, and
  no day ever meets a range;
- two ranges touch exactly if one's first day lies in the other, so a join on equal blocks gives
  the touching pairs, each once, and none besides.

Everything is an equi-join or a partial aggregate, which no single key keeps in one task. A row becomes up to
44 rows of blocks, though, so few ranges of a key are compared as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlink.functions import dates
from idlink.operators.skew import crowded_keys, keyed_join, spread_join

#: 2^22 days from the year 1 on reach beyond the year 9999, the last that Spark's dates have.
LEVELS = 22
_ORIGIN = "0001-01-01"
BLOCK = "_block"
#: Right rows of a key up to which its left rows are compared with them.
PAIRED = 64


def day_number(day: Column) -> Column:
    return F.date_diff(day, F.lit(_ORIGIN).cast("date"))


def day_of(number: Column) -> Column:
    return F.date_add(F.lit(_ORIGIN).cast("date"), number)


def range_blocks(low: str, high: str, levels: int = LEVELS) -> Column:
    """Blocks of the days from column `low` to before column `high`, both from 0 to 2^levels; none if there is no such day."""
    size = 1 << levels
    left = f"shiftright({low} + {size - 1} + shiftleft(1, k), k)"
    right = f"shiftright({high} + {size}, k)"
    sides = [f"CASE WHEN {left} < {right} AND {x} % 2 = 1 THEN {x} - {d} END" for x, d in ((left, 0), (right, 1))]
    return F.expr(f"flatten(transform(sequence(0, {levels}), k -> array_compact(array({', '.join(sides)}))))")


def day_blocks(day: str, levels: int = LEVELS) -> Column:
    """The blocks that hold the day number in column `day`, one per level."""
    return F.expr(f"transform(sequence(0, {levels}), k -> shiftright({day} + {1 << levels}, k))")


def in_ranges(df: DataFrame, low: str, high: str) -> DataFrame:
    """The rows, once for every block of their range."""
    return df.withColumn(BLOCK, F.explode(range_blocks(low, high)))


def on_day(df: DataFrame, day: str) -> DataFrame:
    """The rows, once for every block that holds their day."""
    return df.withColumn(BLOCK, F.explode(day_blocks(day)))


def block_join(left: DataFrame, right: DataFrame, keys: Sequence[str], residual: Column | None = None) -> DataFrame:
    """Inner join of rows made by `in_ranges` or `on_day`, on `keys` and the block.

    Spark takes such rows for as many as there were before, so it would broadcast sides far beyond its limit.
    """
    return keyed_join(left, right.hint("merge"), [*keys, BLOCK], "inner", residual)


def touching_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    paired: int = PAIRED,
) -> DataFrame:
    """Pairs with equal keys whose closed date ranges share a day, each once; `keys` come out once, from the left.

    Apart from `keys` the sides share no column name. Ranges that end before they begin touch as the
    comparison of their bounds says. A missing bound touches nothing.

    Where a key has up to `paired` right rows, its left rows are compared with each of them, so both sides are shuffled
    as they are. The other keys are counted first; their rows meet by blocks, which makes touching pairs only.
    """
    touch = dates.intervals_touch(*[F.col(c) for c in (*left_range, *right_range)])
    if not paired:
        return _by_blocks(left, right, keys, left_range, right_range, touch)
    crowd = crowded_keys(right, keys, paired)
    if crowd is None:
        return keyed_join(left, right.hint("merge"), keys, "inner", touch)
    few = keyed_join(left, right.join(crowd, list(keys), "left_anti").hint("merge"), keys, "inner", touch)
    many = [spread_join(side, crowd, keys, bounds) for side, bounds in ((left, left_range), (right, right_range))]
    return few.unionByName(_by_blocks(*many, keys, left_range, right_range, touch))


def _by_blocks(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_range: tuple[str, str], right_range: tuple[str, str], touch: Column
) -> DataFrame:
    a = left.withColumns({f"_a{i}": day_number(F.col(c)) + i for i, c in enumerate(left_range)})
    b = right.withColumns({f"_b{i}": day_number(F.col(c)) + i for i, c in enumerate(right_range)})
    begins_within = block_join(on_day(a, "_a0"), in_ranges(b, "_b0", "_b1"), keys, touch)
    # The right range begins on a later day than the left one.
    begins_later = block_join(in_ranges(a.withColumn("_a0", F.col("_a0") + 1), "_a0", "_a1"), on_day(b, "_b0"), keys, touch)
    return begins_within.unionByName(begins_later).drop(BLOCK, "_a0", "_a1", "_b0", "_b1")
