"""Delimited, annual-file and Parquet sources."""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from idlink.functions import coerce, identifiers
from idlink.operators.skew import spread_join
from idlink.schemas import ANNUAL_DATE_COLUMNS, DATE_SHAPES
from idlink.sources.conform import lower_headers
from idlink.sources.sinks import write_quarantine

log = logging.getLogger(__name__)

FILE, BLOCK, ROW = "_file", "_block", "_row"
SOURCE_ORDER = [FILE, BLOCK, ROW]
BAD, _LINE = "_bad", "_line"
#: Ordinary CSV doubles a quote within a quoted field; Spark expects a backslash unless told.
DIALECT = {"header": "true", "escape": '"'}
#: What Windows-1252 has where ISO-8859-1 has control characters, from 0x80 on; unused places are blank.
_CP1252 = "€ ‚ƒ„…†‡ˆ‰Š‹Œ Ž  ‘’“”•–—˜™š›œ žŸ"
_CP1252_PAIRS = [(chr(0x80 + i), c) for i, c in enumerate(_CP1252) if c != " "]


def with_source_order(df: DataFrame) -> DataFrame:
    """File path, block offset and running id: together the row order of the files.

    The running id alone is not: scans pack splits by size.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def _n_fields(line: F.Column, separator: str) -> F.Column:
    """Fields of a line; quoted ones count as one whatever they hold."""
    mark = re.escape(separator)
    plain = F.regexp_replace(line, rf'(^|{mark})"(?:[^"]|"")*"(?={mark}|$)', "$1")
    return ((F.length(plain) - F.length(F.replace(plain, F.lit(separator), F.lit("")))) / len(separator) + 1).cast("int")


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    ordered: bool = False,
    short_rows: str = "null",
    **options: str,
) -> DataFrame:
    """As `read_delimited`, with bad rows among the others: `_bad` tells their reason, fields and line, and is null elsewhere.

    Reasons: `surplus`, more fields than headers; `short`, fewer (by default such rows are fine, what they lack
    is null; `short_rows="bad"` objects); `quotes`, a quote that does not close and hides fields after it.
    """
    if short_rows not in ("null", "bad"):
        raise ValueError("short_rows must be null or bad")
    cp1252 = encoding.lower() in ("windows-1252", "cp1252")
    options = {**DIALECT, "encoding": "ISO-8859-1" if cp1252 else encoding, **options}
    header = spark.read.options(**options).csv(path).schema
    schema = StructType([*header.fields, StructField(_LINE, StringType())])
    # A pruned parser would not see all fields of a line.
    options |= {"columnNameOfCorruptRecord": _LINE, "columnPruning": "false"}
    df = spark.read.options(**options).schema(schema).csv(path)
    if ordered:
        df = with_source_order(df)
    if cp1252:
        old, new = ("".join(x) for x in zip(*_CP1252_PAIRS))
        texts = {*header.names, _LINE}
        df = df.select(*[F.translate(c, old, new).alias(n.translate(str.maketrans(old, new))) if n in texts else c for n, c in _named(df)])
    line, expected = F.col(_LINE), len(header)
    found = _n_fields(line, options.get("sep") or options.get("delimiter") or ",")
    reason = F.when(found > expected, "surplus").when(found == expected, "quotes").otherwise("short")
    bad = F.struct(reason.alias("reason"), found.alias("fields"), line.alias("line"))
    # Spark refuses plans that read nothing but the line, so a column of the file takes part.
    is_bad = line.isNotNull() & F.coalesce(F.col(f"`{df.columns[0]}`"), line).isNotNull()
    if short_rows == "null":
        is_bad &= found >= expected
    df = lower_headers(df.withColumn(BAD, F.when(is_bad, bad)).drop(_LINE))
    if columns is None:
        return df
    wanted = {c.lower() for c in columns} | {BAD, *(SOURCE_ORDER if ordered else ())}
    return df.select(*[c for n, c in _named(df) if n in wanted])


def _named(df: DataFrame) -> list[tuple[str, F.Column]]:
    return [(c, F.col(f"`{c}`")) for c in df.columns]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    ordered: bool = False,
    quarantine: str | None = None,
    short_rows: str = "null",
    **options: str,
) -> DataFrame:
    """Text columns with lower-case headers; `columns` picks some, whatever their case.

    A selection is pruned in the scan. `ordered` adds the source-order columns. `multiLine="true"`
    among the options reads quoted line breaks, at the price of one task per file. Windows-1252
    is read as ISO-8859-1 and its own characters are put in place, so no session setting is needed.

    Bad rows (`read_checked`) fail the job that meets them, unless `quarantine` names a folder: then they are
    added to it first, with file and place, counted and logged, and the other rows are returned.
    """
    kind = {"encoding": encoding, "short_rows": short_rows, **options}
    df = read_checked(spark, path, columns, ordered=ordered, **kind)
    if quarantine is None:
        bad = F.col(BAD)
        said = F.concat(F.lit("bad row, its fields are not those of the header: "), bad["line"])
        return df.where(F.when(bad.isNotNull(), F.raise_error(said).cast("boolean")).otherwise(True)).drop(BAD)
    lines = read_checked(spark, path, [], ordered=True, **kind).where(F.col(BAD).isNotNull())
    found = write_quarantine(lines.select(*SOURCE_ORDER, f"{BAD}.*"), quarantine)
    if found:
        log.warning("%s bad rows of %s are in %s", found, path, quarantine)
    return df.where(F.col(BAD).isNull()).drop(BAD)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = lower_headers(spark.read.parquet(path))
    return df if columns is None else df.select(*[c for c in df.columns if c in {x.lower() for x in columns}])


def file_year(path: str | F.Column) -> F.Column:
    """First year (1900-2099) in the last part of a path that has one: the file's name, else its folder's."""
    c = F.col(path) if isinstance(path, str) else path
    plain = F.replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), F.lit("\\"), F.lit("/"))
    name = F.regexp_extract(F.substring_index(plain, "/", -1), r"((?:19|20)\d{2})", 1)
    folder = F.regexp_extract(F.substring_index(F.substring_index(plain, "/", -2), "/", 1), r"((?:19|20)\d{2})", 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(folder, F.lit(""))).cast("int")


def extract_year(df: DataFrame, file_column: str = FILE) -> DataFrame:
    """Add `year` to rows of annual files with lower-case text columns.

    A `year` column decides where there is one. Otherwise each file takes the first
    (date column, format) pair that gives any of its rows a date, and without one the year
    in its name. The pair is found by one partial aggregate per file, so a file of any size
    is never gathered, and looked up by the rows in a spread join.
    """
    if "year" in df.columns:
        return df.withColumn("year", coerce.to_integer(coerce.null_tokens(F.col("year").cast("string")), IntegerType()))
    fallback = file_year(file_column)
    found = [c for c in ANNUAL_DATE_COLUMNS if c in df.columns]
    if not found:
        return df.withColumn("year", fallback)
    # A text is matched and converted once; pair k * width + n is date column k in format n, the last one any format.
    width = len(DATE_SHAPES) + 1
    rows = df.withColumns({f"_text{k}": identifiers.strip(F.col(f"`{c}`").cast("string")) for k, c in enumerate(found)})
    rows = rows.withColumns({f"_day{k}": coerce.date_text(F.col(f"_text{k}")) for k in range(len(found))})
    rows = rows.withColumns({f"_shape{k}": coerce.shape_number(F.col(f"_day{k}")) for k in range(len(found))})
    dates = {f"_date{k}": coerce.date_of_shape(F.col(f"_day{k}"), F.col(f"_shape{k}")) for k in range(len(found))}
    rows = rows.withColumns(dates)
    rows = rows.withColumns({f"_year{k}": F.year(coerce.in_range(F.col(f"_date{k}"))) for k in range(len(found))})
    pure = {f"_shape{k}": F.when(F.col(f"_day{k}") == F.col(f"_text{k}"), F.col(f"_shape{k}")) for k in range(len(found))}
    rows = rows.withColumns(pure).drop(*[f"_{x}{k}" for x in ("text", "day", "date") for k in range(len(found))])
    pairs = [F.when(F.col(f"_year{k}").isNotNull(), k * width + F.coalesce(f"_shape{k}", F.lit(width - 1))) for k in range(len(found))]
    first = F.least(*pairs) if len(pairs) > 1 else pairs[0]
    choice = rows.groupBy(file_column).agg(F.min(first).alias("_pair"))
    spread_by = [ROW] if ROW in df.columns else [c for c in df.columns if c != file_column]
    rows = spread_join(rows, choice, [file_column], spread_by, "left")
    year = F.when(F.col("_pair").isNull(), fallback)
    for k in range(len(found)):
        form = F.col("_pair") - k * width
        fits = form.between(0, width - 1) & ((form == width - 1) | (form == F.col(f"_shape{k}")))
        year = year.when(fits, F.col(f"_year{k}"))
    return rows.withColumn("year", year).select(*df.columns, "year")


def _glob_escaped(path: str) -> str:
    """A path that names one file even if it holds the characters of a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _plain(uri: str) -> str:
    """A path without escapes and with one slash after the scheme, as listings spell it either way."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(uri))


def _headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """The header of every file that can be read, found in one job: the first line of its first block."""
    lines = spark.read.option("ignoreCorruptFiles", "true").text([_glob_escaped(f) for f in files])
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumn("row", F.monotonically_increasing_id()).where("block = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "row").alias("value"))
    found = {}
    for file, value in first.collect():  # one row per file
        cells = next(csv.reader([value.removeprefix("\ufeff")]), [])
        found[_plain(file)] = tuple(c.strip().lower() for c in cells)
    return found


def read_annual(
    spark: SparkSession,
    path: str,
    wanted: Sequence[str],
    pattern: str = "*",
    encoding: str = "UTF-8",
    skip_corrupt: bool = False,
    quarantine: str | None = None,
    **options: str,
) -> DataFrame:
    """Yearly delimited files under `path` as one table with `year` and the source-order columns.

    Headers may differ between files: files with the same header are read together, and
    files that have none of the `wanted` columns are skipped. A file whose header cannot be read
    is skipped and logged. One that breaks off later fails the job, unless `skip_corrupt` asks to
    keep the rows before the break. Bad rows are treated as `read_delimited` does. `options` go to the reader.
    """
    base = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    listed = sorted(unquote(f) for f in base.text(path).inputFiles())
    headers = _headers(spark, listed) if listed else {}
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    relevant = {c.lower() for c in wanted} | set(ANNUAL_DATE_COLUMNS) | {"year"}
    for file in listed:
        header = headers.get(_plain(file))
        if header is None:
            log.warning("skipping unreadable file %s", file)
        elif relevant & set(header):
            by_header[header].append(_glob_escaped(file))
    if not by_header:
        raise FileNotFoundError(f"no usable files under {path}")
    if skip_corrupt:
        options["ignoreCorruptFiles"] = "true"
    parts = []
    for files in by_header.values():
        df = extract_year(read_delimited(spark, files, sorted(relevant), encoding, ordered=True, quarantine=quarantine, **options))
        keep = [c for c in df.columns if c in {w.lower() for w in wanted} | {"year", *SOURCE_ORDER}]
        parts.append(df.select(*[F.col(f"`{c}`") for c in keep]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
