"""Canonical table schemas, header aliases and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---- fixed values -------------------------------------------------------------------
# They must equal the published pipeline's for results to agree.

FAR_FUTURE = "2262-04-11"  # open end of a segment or link
FIRST_LINK_DATE = "1900-01-01"  # missing start of a link
EARLIEST_DATE = "1677-09-22"  # dates outside [EARLIEST_DATE, FAR_FUTURE] count as missing
FIRST_YEAR, LAST_YEAR = 1678, 2262  # years whose January 1 is such a date
DATE_SHAPES = {  # accepted date formats: the texts each applies to, and how to write them in ISO form
    "yyyyMMdd": (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    "yyyy-M-d": (r"^\d{4}-\d{1,2}-\d{1,2}$", None),
    "M/d/yyyy": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    "yyyy/M/d": (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    "M/d/yy": (r"^(\d{1,2})/(\d{1,2})/(\d{2})$", "$3-$1-$2"),
    "d MMM yyyy": (r"^(\d{1,2})[- ]?([A-Za-z]{3,9})[- ,]*(\d{4})$", "$3-$2-$1"),
    "MMM d, yyyy": (r"^([A-Za-z]{3,9})[. ]+(\d{1,2}),? +(\d{4})$", "$3-$1-$2"),
}
MONTHS = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
)
CENTURY_TURN = "69"  # two-digit years from here on are 19xx
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("1", "true", "t", "y", "yes")
PREFERRED_EXCHANGES = (1, 3)
EXCHANGE_LABELS = {1: "NYSE", 2: "AMEX", 3: "NASDAQ"}
COMMON_SHARE_CODES = (10, 11)
COMMON_SHARE_CODES_RELOAD = (10, 11, 12)
PRIMARY_LINK_CODES = ("P", "C")
LINK_TYPE_RANKS = {"LU": 2, "LC": 1}
NORTH_AMERICAN_PREFIXES = ("US", "CA")
PASS_POINTS = {"CUSIP6": 5, "ISIN_CUSIP6": 4, "ISIN": 6, "TICKER": 3}
ANNUAL_DATE_COLUMNS = ("as_of_date", "as of date", "asof_date", "date", "period")
GVKEY_WIDTH = 6

# ---- tables -------------------------------------------------------------------------


def _schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


@dataclass(frozen=True)
class Table:
    """A canonical table: column types, header aliases (alias -> name), required columns."""

    name: str
    schema: StructType
    aliases: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_S, _L, _I, _D, _B, _F = StringType(), LongType(), IntegerType(), DateType(), BooleanType(), DoubleType()

NAMES = Table(
    "names",
    _schema(
        permno=_L, permco=_L, namedt=_D, nameendt=_D, comnam=_S, ticker=_S, tsymbol=_S, shrcls=_S,
        ncusip=_S, shrcd=_I, exchcd=_I, primexch=_S, siccd=_I, naics=_I,
    ),
    aliases={"date": "namedt"},
    required=("permno", "namedt"),
)

LINKS = Table(
    "links",
    _schema(
        permno=_L, permco=_L, gvkey=_S, linkdt=_D, linkenddt=_D, cusip=_S, linkprim=_S, linktype=_S,
    ),
    aliases={"lpermno": "permno", "lpermco": "permco"},
    required=("permno",),
)

SECURITY_MASTER = Table(
    "security_master",
    _schema(
        permno=_L, permco=_L, gvkey=_S, namedt=_D, nameendt=_D, linkdt=_D, linkenddt=_D,
        comnam=_S, ticker=_S, tsymbol=_S, shrcls=_S, shrcd=_I, is_common=_B, exchcd=_I, exch=_S,
        primexch=_S, siccd=_I, naics=_I, ncusip=_S, ncusip6=_S, cusip=_S, cusip6=_S,
        linkprim=_S, linktype=_S, linkprim_score=_I, linktype_rank=_I, overlap_days=_I,
        cusip6_match=_I, primary_permno=_L, is_primary_permno=_B,
    ),
    required=("permno", "namedt", "nameendt"),
)

PROVIDER_A = Table(
    "provider_a",
    _schema(orgpermid=_S, year=_I, cusip=_S, isin=_S, sedol=_S, ticker=_S, comname=_S),
    required=("orgpermid", "year"),
)

PROVIDER_B = Table(
    "provider_b",
    _schema(issuer_id=_S, year=_I, company_name=_S, ticker=_S, cusip=_S, isin=_S, sedol=_S),
    aliases={
        "issuerid": "issuer_id",
        "issuer_name": "company_name",
        "issuer_ticker": "ticker",
        "issuer_cusip": "cusip",
        "issuer_isin": "isin",
        "issuer_sedol": "sedol",
    },
    required=("issuer_id", "year"),
)

PROVIDER_C = Table(
    "provider_c",
    _schema(
        symbol=_S, year=_I, isin=_S, environmental=_F, social=_F, governance=_F, esg=_F, period_end=_D,
    ),
    required=("symbol", "year"),
)

CONSTITUENTS = Table(
    "constituents",
    _schema(date=_D, ric=_S, isin=_S, cusip=_S, ticker=_S),
    required=("date",),
)

SEGMENT_KEY = ["permno", "namedt", "nameendt"]
