"""Mixing sources to target weights by systematic sampling, in built-in functions only.

Targets: the sources share the whole by weight; none gets more than `most` times its own size, and
the excess goes to the others by weight (water filling, solved in closed form over the sources).
Sampling: every document of a source is expected `target / source_size` times. Expected copies are
summed along the source's documents in order of size, one random offset per source (a hash of source
and seed) is added, and a document is emitted once per integer boundary that its interval crosses. As
the order is by size, the words taken differ from the target by one largest document at most.

The running sum needs no sort of a whole source. Expected copies are equal within a source, so the sum
is rank times a constant. The rank is the number of documents of smaller size (a histogram by size),
plus those of equal size in earlier blocks, plus the row number in the block. Sizes with n documents are
dealt over about sqrt(n) blocks, so a third of all rows with one size spreads over many tasks. A
histogram by size is short: k different sizes need at least k * k / 2 words.

Defined results: a null source is a source of its own, last in order; null and empty texts have size 0
and take no words; rows with equal id, source and size are one unit and taken equally often. Sources
without words have target 0. An empty table gives an empty mix. Reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idlink.llm.common import WORD, joined, kept


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """`sizes` has one row per `source` with `source_size`; adds `target`. One row per source is all it sorts."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    df = sizes.withColumn("weight", F.get(given, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    df = df.withColumns({"cap": F.lit(most) * F.col("source_size"), "ratio": F.lit(most) * F.col("source_size") / F.col("weight")})
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # The level at which the sources from this one on share what the capped ones before leave.
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    free = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    df = df.withColumns({"level": left / free, "place": F.row_number().over(by_ratio)})
    df = df.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)["level"])
    return df.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _sqrt_blocks(n: Column, key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.ceil(F.sqrt(n)).cast("long"))


def copies(units: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0, seed: int = 0) -> DataFrame:
    """How often each document is taken: `units` has id, source, size; adds source_size, target, copies.

    Repeated rows come back once, with their number in `rows`.
    """
    units = kept(units.groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "mix_units")
    tall = units.groupBy("source", "size").agg(F.count("*").alias("n"), F.sum(F.col("size") * F.col("rows")).alias("words"))
    tall = kept(tall, "mix_sizes")
    per_source = targets(tall.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    tall = tall.select("source", "size", "n", F.coalesce(F.sum("n").over(by_size), F.lit(0)).alias("smaller"))
    df = joined(units, tall, ["source", "size"])
    df = df.withColumn("block", _sqrt_blocks(F.col("n"), F.col("id")))
    blocks = df.groupBy("source", "size", "block").agg(F.count("*").alias("m"), F.first("smaller").alias("smaller"))
    earlier = Window.partitionBy("source", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "size", "block", (F.col("smaller") + F.coalesce(F.sum("m").over(earlier), F.lit(0))).alias("base"))
    df = joined(df.drop("n", "smaller"), blocks, ["source", "size", "block"])
    within = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy(F.col("id").asc_nulls_first()))
    df = df.withColumn("rank", F.col("base") + within)
    df = joined(df, per_source, ["source"])
    offset = F.pmod(F.xxhash64(F.col("source"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda rank: F.floor(rank * expected + offset)
    taken = (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).cast("long")
    return df.select("id", "source", "size", "rows", "source_size", "target", taken.alias("copies"))


def mix(docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    df = docs.select(F.struct("*").alias("doc"), F.col(id_).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    plan = copies(df.drop("doc"), **options).where(F.col("copies") > 0).select("id", "source", "size", "copies")
    taken = joined(df, plan, ["id", "source", "size"]).select("doc", "copies")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def mix_report(docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words that the mix takes of it."""
    units = docs.select(F.col(id_).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    df = copies(units, **options)
    again = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row")
    return df.select("*", again).select(
        F.col("id").alias(id_), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
