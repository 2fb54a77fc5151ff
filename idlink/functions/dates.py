"""Interval arithmetic on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from idlink.schemas import FIRST_YEAR, LAST_YEAR


def year_start(year: Column) -> Column:
    """January 1; null for years outside the supported dates, which would fail the job otherwise."""
    return F.when(year.between(FIRST_YEAR, LAST_YEAR), F.make_date(year, F.lit(1), F.lit(1)))


def year_end(year: Column) -> Column:
    """Exclusive end of a calendar year."""
    return F.when(year.between(FIRST_YEAR - 1, LAST_YEAR - 1), F.make_date(year + 1, F.lit(1), F.lit(1)))


def overlap_days(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Days shared by two intervals with exclusive ends, never negative; null if a bound is missing."""
    known = start1.isNotNull() & end1.isNotNull() & start2.isNotNull() & end2.isNotNull()
    days = F.date_diff(F.least(end1, end2), F.greatest(start1, start2))
    return F.when(known, F.greatest(F.lit(0), days))


def intervals_touch(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Closed intervals share at least one day."""
    return F.coalesce((start1 <= end2) & (end1 >= start2), F.lit(False))


def touching_overlap_days(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """`overlap_days` where the closed intervals touch, else 0."""
    touch = intervals_touch(start1, end1, start2, end2)
    return F.when(touch, overlap_days(start1, end1, start2, end2)).otherwise(F.lit(0))


def covers(start: Column, end: Column, day: Column) -> Column:
    """`day` lies in the half-open interval [start, end)."""
    return (start <= day) & (end > day)


def segment_days(start: Column, end: Column) -> Column:
    return F.greatest(F.lit(0), F.date_diff(end, start))
