"""Merges the small partitions of closed years, behind a manifest that readers follow.

Every batch of the stream leaves partitions (year, batch_id). `compact` writes all rows of a year to one
new file set and then commits a manifest that names it and the last batch in it. Readers take the newest
manifest: the file sets it names, and those batches that are newer. `vacuum` later deletes what the
manifest made superfluous.

- A crash before the commit leaves a file set that no manifest names.
- A crash after it leaves batches that readers skip.
- A batch that the stream repeats after it was compacted writes partitions that readers skip as well.
- The commit is the rename of a complete file to the next number, so a reader sees it whole or not at all.

One compaction runs at a time, while no batch does. Readers that planned with an older manifest must have
ended before `vacuum`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.operators.ranking import asc

FILE_SETS, MANIFESTS = "_compacted", "_manifest"
#: Rows of a file set go to as many files as there are millions of them, and are ordered by these.
ROWS_PER_FILE = 1_000_000
ORDER = ["date", "ric"]


@dataclass(frozen=True)
class FileSet:
    """`folder` holds all rows of its year from batches up to `last_batch`."""

    folder: str
    last_batch: int


class Folder:
    """Hadoop's file system at a table, for names relative to it."""

    def __init__(self, spark: SparkSession, table: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.table = table
        self.fs = self._path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.table}/{name}")

    def names(self, pattern: str) -> list[str]:
        """Last parts of the paths that match."""
        return [s.getPath().getName() for s in self.fs.globStatus(self.at(pattern)) or ()]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """The whole file under its name, or an error if there is one already."""
        part = f"{MANIFESTS}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(part), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(self.at(part), self.at(name)):
            self.fs.delete(self.at(part), False)
            raise FileExistsError(f"{self.table}/{name}: another compaction was faster")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def manifest(spark: SparkSession, table: str) -> tuple[int, dict[int, FileSet]]:
    """Number and content of the newest manifest: year -> file set; 0 and nothing if there is none."""
    folder = Folder(spark, table)
    numbers = sorted(int(n.removesuffix(".json")) for n in folder.names(f"{MANIFESTS}/*.json"))
    if not numbers:
        return 0, {}
    found = json.loads(folder.read(f"{MANIFESTS}/{numbers[-1]:08d}.json"))
    return numbers[-1], {int(year): FileSet(**entry) for year, entry in found.items()}


def has_batches(spark: SparkSession, table: str) -> bool:
    """Whether the table has a partition; its folder may exist for the checkpoint only."""
    return bool(Folder(spark, table).names("year=*"))


def has_rows(spark: SparkSession, table: str) -> bool:
    return has_batches(spark, table) or bool(manifest(spark, table)[1])


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """The table as its newest manifest has it, with `year` and `batch_id`."""
    _, sets = manifest(spark, table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = []
    if has_batches(spark, table):
        rows = reader.parquet(table)
        for year, found in sets.items():
            rows = rows.where(~((F.col("year") == year) & (F.col("batch_id") <= found.last_batch)))
        parts.append(rows)
    parts += [reader.parquet(f"{table}/{found.folder}") for found in sets.values()]
    return reduce(lambda a, b: a.unionByName(b.select(*[F.col(c).cast(a.schema[c].dataType) for c in a.columns])), parts)


def compact(spark: SparkSession, table: str, before_year: int | None = None, least_batches: int = 2) -> dict[int, FileSet]:
    """Merges every year before `before_year` (all, if it is None) that has `least_batches` partitions or more
    outside its file set. Returns the file sets of the new manifest."""
    number, sets = manifest(spark, table)
    if not has_batches(spark, table):
        return sets
    loose = spark.read.parquet(table).select("year", "batch_id").distinct()
    batches: dict[int, list[int]] = {}
    for year, batch in loose.collect():  # a row per partition folder
        if (before_year is None or year < before_year) and (year not in sets or batch > sets[year].last_batch):
            batches.setdefault(year, []).append(batch)
    due = {year: max(found) for year, found in batches.items() if len(found) >= least_batches}
    if not due:
        return sets
    rows = read_table(spark, table)
    new = dict(sets)
    for year, last in sorted(due.items()):
        folder = f"{FILE_SETS}/{year}-{uuid.uuid4().hex}"
        own = rows.where(F.col("year") == year)
        files = max(1, -(-own.count() // ROWS_PER_FILE))
        own.repartitionByRange(files, *asc(*ORDER)).sortWithinPartitions(*asc(*ORDER)).write.parquet(f"{table}/{folder}")
        new[year] = FileSet(folder, last)
    text = json.dumps({year: vars(found) for year, found in sorted(new.items())})
    Folder(spark, table).write_new(f"{MANIFESTS}/{number + 1:08d}.json", text)
    return new


def vacuum(spark: SparkSession, table: str) -> int:
    """Deletes batches and file sets that the newest manifest does without, and older manifests; returns how many."""
    folder = Folder(spark, table)
    number, sets = manifest(spark, table)
    named = {found.folder for found in sets.values()}
    gone = [f"{FILE_SETS}/{n}" for n in folder.names(f"{FILE_SETS}/*") if f"{FILE_SETS}/{n}" not in named]
    for year, found in sets.items():
        batches = [int(n.removeprefix("batch_id=")) for n in folder.names(f"year={year}/batch_id=*")]
        old = [b for b in batches if b <= found.last_batch]
        gone += [f"year={year}"] if len(old) == len(batches) and old else [f"year={year}/batch_id={b}" for b in old]
    gone += [f"{MANIFESTS}/{n}" for n in folder.names(f"{MANIFESTS}/*.json") if int(n.removesuffix(".json")) < number]
    for name in gone:
        folder.delete(name)
    return len(gone)
