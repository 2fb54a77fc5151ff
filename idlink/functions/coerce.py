"""Type coercion that turns bad values into nulls instead of failing the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from idlink.functions.identifiers import strip
from idlink.schemas import CENTURY_TURN, DATE_SHAPES, EARLIEST_DATE, FAR_FUTURE, MONTHS, NULL_TOKENS, TRUE_TOKENS

_MS_PER_DAY = 86_400_000


def null_tokens(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """The usual delimited-file spellings of "missing" become null."""
    if not tokens:
        return c
    return F.when(~c.isin(*tokens), c)


def null_tokens_of(name: str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """`null_tokens` of a named column, as one SQL expression: quicker to build for wide tables."""
    if not tokens:
        return F.col(f"`{name}`")
    listed = ", ".join("'" + t.replace("'", "\\'") + "'" for t in tokens)
    return F.expr(f"CASE WHEN `{name}` NOT IN ({listed}) THEN `{name}` END")


def to_integer(c: Column, target: DataType, source: DataType | None = None) -> Column:
    """Whole numbers, also when written like `12.0`; anything else becomes null."""
    if isinstance(source, IntegralType):
        return c.try_cast(target)
    number = c.try_cast("double")
    return F.coalesce(c.try_cast(target), F.when(number == F.floor(number), number).try_cast(target))


def to_boolean(c: Column, source: DataType | None = None) -> Column:
    """True for true, a number other than 0, or one of the accepted words; null counts as false."""
    if isinstance(source, BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(source, NumericType):
        return F.coalesce(c != 0, F.lit(False))
    return F.coalesce(F.lower(strip(c)).isin(*TRUE_TOKENS), F.lit(False))


def in_range(c: Column) -> Column:
    return F.when(c.between(F.lit(EARLIEST_DATE).cast("date"), F.lit(FAR_FUTURE).cast("date")), c)


def _iso_form(text: Column, fmt: str) -> Column:
    """A text of one format's shape, written as ISO dates are."""
    shape, iso = DATE_SHAPES[fmt]
    written = F.regexp_replace(text, shape, iso) if iso else text
    if "MMM" in fmt:
        year, name, day = [F.split_part(written, F.lit("-"), F.lit(i)) for i in (1, 2, 3)]
        return F.concat(year, F.lit("-"), _month_number(name), F.lit("-"), day)
    if fmt.endswith("/yy"):
        return F.concat(F.when(written < CENTURY_TURN, "20").otherwise("19"), written)
    return written


def parse_date(text: Column, fmt: str) -> Column:
    """Date in one format, by a cast of its ISO form: format parsers are slow, failing ones most of all."""
    return F.when(text.rlike(DATE_SHAPES[fmt][0]), _iso_form(text, fmt).try_cast("date"))


#: No text has two of the shapes. The commonest is looked for first.
_SHAPES = sorted(DATE_SHAPES, key=lambda fmt: DATE_SHAPES[fmt][1] is not None)


def _by_shape(of: Callable[[str], Column], test: Callable[[str], Column]) -> Column:
    first, *rest = _SHAPES
    chain = F.when(test(first), of(first))
    for fmt in rest:
        chain = chain.when(test(fmt), of(fmt))
    return chain


def shape_number(text: Column) -> Column:
    """Which of DATE_SHAPES a text has, by number; null for none."""
    return _by_shape(lambda fmt: F.lit(list(DATE_SHAPES).index(fmt)), lambda fmt: text.rlike(DATE_SHAPES[fmt][0]))


def date_of_shape(text: Column, number: Column) -> Column:
    """The date of a text whose shape number is known."""
    return _by_shape(lambda fmt: _iso_form(text, fmt), lambda fmt: number == list(DATE_SHAPES).index(fmt)).try_cast("date")


def _month_number(name: Column) -> Column:
    """Number, as text, of an English month's name or its first three letters; null for other texts."""
    names = [(spelling, str(i)) for i, month in enumerate(MONTHS, 1) for spelling in dict.fromkeys((month, month[:3]))]
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names for x in pair]), F.upper(name))


def date_text(c: Column) -> Column:
    """The date part of a text: trimmed, a time of day after it dropped."""
    return F.regexp_replace(strip(c.cast("string")), r"[T ]+\d{1,2}:\d{2}.*$", "")


def parse_any_date(text: Column) -> Column:
    return _by_shape(lambda fmt: _iso_form(text, fmt), lambda fmt: text.rlike(DATE_SHAPES[fmt][0])).try_cast("date")


def to_date(c: Column) -> Column:
    """Date by value, in any of the known formats; out-of-range dates are null."""
    return in_range(parse_any_date(date_text(c)))


def open_end(c: Column) -> Column:
    """End date of a validity interval; missing means still open."""
    return F.coalesce(c, F.lit(FAR_FUTURE).cast("date"))


def moment_date(c: Column, source: DataType) -> Column:
    """UTC date of a date, a timestamp with or without zone, or else of epoch milliseconds."""
    if isinstance(source, (DateType, TimestampNTZType)):
        return c.cast("date")
    if isinstance(source, TimestampType):
        return epoch_ms_date(F.unix_millis(c))
    return epoch_ms_date(c.try_cast("long"))


def epoch_ms_date(c: Column) -> Column:
    """UTC date of an epoch-millisecond value, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(c / _MS_PER_DAY).try_cast("int"))


def coerce_steps(name: str, source: DataType, target: DataType, tokens: tuple[str, ...] = NULL_TOKENS) -> list[Column]:
    """Column `name` of type `source` to `target` in three projections, bad values null.

    Each step refers to the column the step before made. A value that is used more than
    once is computed once that way; as one expression it would be computed for every use.
    """
    c = F.col(f"`{name}`")
    if isinstance(target, DateType):
        if isinstance(source, StringType):
            steps = [date_text(c), parse_any_date(c), in_range(c)]
        else:
            steps = [c, c.cast("date"), in_range(c)]
    elif isinstance(target, BooleanType):
        steps = [to_boolean(c, source), c, c]
    elif isinstance(target, IntegralType):
        steps = [to_integer(c, target, source), c, c]
    else:
        text = null_tokens_of(name, tokens) if isinstance(source, StringType) else c
        steps = [text.try_cast(target) if isinstance(target, FractionalType) else text.cast(target), c, c]
    return [step.alias(name) for step in steps]
