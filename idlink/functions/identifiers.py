"""Identifier clean-up. Everything here is a built-in column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from idlink.schemas import GVKEY_WIDTH, NORTH_AMERICAN_PREFIXES

# Plain trim() strips only blanks; headers and exports also carry tabs and no-break spaces.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def norm_string(c: Column) -> Column:
    """Trimmed, upper case; blank becomes null so that it never joins as a key."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def pad_gvkey(c: Column) -> Column:
    """Left-pad with zeros to six; longer keys stay whole (a fixed length would cut them)."""
    return F.lpad(c, F.greatest(F.lit(GVKEY_WIDTH), F.length(c)), F.lit("0"))


def gvkey_digits(c: Column) -> Column:
    """Digits of a firm key, a trailing `.0` dropped; null without any."""
    return F.nullif(F.regexp_replace(strip(c), r"\.0$|[^0-9]", ""), F.lit(""))


def norm_gvkey(c: Column) -> Column:
    """Firm key as digits only, padded to six."""
    return pad_gvkey(gvkey_digits(c))


def cusip6(c: Column) -> Column:
    return F.substring(c, 1, 6)


def isin_cusip6(c: Column) -> Column:
    """Issuer part of a US or Canadian ISIN; null for other countries and short codes."""
    north_american = F.substring(c, 1, 2).isin(*NORTH_AMERICAN_PREFIXES)
    return F.when(north_american & (F.length(c) >= 12), F.substring(c, 3, 6))


def clean_symbol(c: Column) -> Column:
    """Symbol without a trailing `.LETTERS` exchange suffix."""
    return F.regexp_replace(c, r"\.[A-Z]+$", "")


def ric_ticker(c: Column) -> Column:
    """Ticker part of an instrument code: the text before its first dot."""
    return F.upper(F.nullif(F.regexp_extract(c, r"^([^.]+)", 1), F.lit("")))
