"""Match yearly provider records to security segments through an ordered list of keys.

Which segment wins for a record depends only on (kind of key, key, year): the points of
the key that found it are the same for all candidates. So the best segment is chosen once
per (kind, key, year) on the master side, and the provider rows look it up. No provider
row ever meets more than one segment per pass, however popular its CUSIP6 or ticker is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idlink.functions import dates, scores
from idlink.operators.ranking import asc, desc, keep_first
from idlink.operators.skew import spread_join
from idlink.schemas import PASS_POINTS

CUSIP6, TICKER = "C", "T"
MASTER_KEYS = {CUSIP6: "ncusip6", TICKER: "ticker"}

_SEGMENT = [
    "permno", "gvkey", "primary_permno", "is_primary_permno", "is_common", "exchcd",
    "namedt", "nameendt", "ncusip6", "ticker", "linkprim_score", "linktype_rank",
]


def _best_first() -> list[Column]:
    return [
        *desc("segment_score", "overlap_days", "is_primary_permno", "is_common"),
        *asc("exchcd", "namedt", "permno", "nameendt", "ncusip6", "ticker"),
    ]


@dataclass(frozen=True)
class Pass:
    """One step of the cascade: a label, the provider's key column and the kind of master key."""

    label: str
    key: str
    kind: str = CUSIP6

    @property
    def points(self) -> int:
        return PASS_POINTS.get(self.label, 0)


@dataclass(frozen=True)
class ProviderSpec:
    """Everything that distinguishes a provider. A new provider is a new value of this class."""

    name: str
    entity: str
    passes: tuple[Pass, ...]
    columns: tuple[str, ...]  # provider columns kept in the matches
    master_ticker: str = "ticker_master"  # name of the matched segment's ticker
    prefilter: bool = False  # restrict the master to issuers the provider names by CUSIP6 or `ticker`
    availability: tuple[str, ...] = field(default=())

    @property
    def output(self) -> list[str]:
        return [
            self.entity, "year", "match_src", "match_score", "overlap_days", "permno", "gvkey",
            "primary_permno", "is_primary_permno", "is_common", "exchcd", *self.columns,
            "namedt", "nameendt", "ncusip6", self.master_ticker,
        ]


PROVIDER_A = ProviderSpec(
    name="provider_a",
    entity="orgpermid",
    passes=(Pass("CUSIP6", "cusip6_from_cusip"), Pass("ISIN_CUSIP6", "cusip6_from_isin")),
    columns=("comname", "ticker", "cusip", "isin", "sedol"),
    availability=("cusip", "isin", "sedol", "ticker"),
)
PROVIDER_B = ProviderSpec(
    name="provider_b",
    entity="issuer_id",
    passes=(Pass("CUSIP6", "cusip6_from_cusip"), Pass("ISIN_CUSIP6", "cusip6_from_isin")),
    columns=("company_name", "ticker", "cusip", "isin", "sedol"),
    availability=("cusip", "isin", "sedol", "ticker"),
)
PROVIDER_C = ProviderSpec(
    name="provider_c",
    entity="symbol",
    passes=(Pass("ISIN", "cusip6_from_isin"), Pass("TICKER", "clean_symbol", TICKER)),
    columns=("clean_symbol", "isin", "environmental", "social", "governance", "esg"),
    master_ticker="ticker",
    prefilter=True,
    availability=("isin", "cusip6_from_isin", "clean_symbol"),
)
PROVIDERS = {p.name: p for p in (PROVIDER_A, PROVIDER_B, PROVIDER_C)}


def master_keys(master: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per segment and usable key: (key_kind, key) and the segment's columns."""
    pairs = [F.struct(F.lit(k).alias("key_kind"), F.col(MASTER_KEYS[k]).alias("key")) for k in kinds]
    if len(pairs) == 1:
        keyed = master.withColumn("_k", pairs[0])
    else:
        keyed = master.withColumn("_k", F.explode(F.array(*pairs)))
    return keyed.select("_k.key_kind", "_k.key", *_SEGMENT).where("key IS NOT NULL AND key <> ''")


def provider_identifiers(provider: DataFrame) -> DataFrame:
    """Distinct identifiers a provider names: kind C from its CUSIP and ISIN columns, kind T from `ticker`."""
    sources = {"cusip6_from_cusip": CUSIP6, "cusip6_from_isin": CUSIP6, "ticker": TICKER}
    pairs = [
        F.struct(F.lit(kind).alias("key_kind"), F.col(name).alias("key"))
        for name, kind in sources.items()
        if name in provider.columns
    ]
    exploded = provider.select(F.explode(F.array(*pairs)).alias("_k")).select("_k.*")
    return exploded.where("key IS NOT NULL").distinct()


def filter_by_identifiers(master: DataFrame, provider: DataFrame) -> DataFrame:
    """Segments whose CUSIP6, or whose ticker, the provider names.

    Two lookups against distinct keys instead of an OR in a join condition.
    """
    named = provider_identifiers(provider)
    flags = []
    for kind, column in MASTER_KEYS.items():
        if kind == TICKER and "ticker" not in provider.columns:
            continue
        flag = f"_named_{kind}"
        keys = named.where(F.col("key_kind") == kind).select(F.col("key").alias(column), F.lit(True).alias(flag))
        master = spread_join(master, keys, [column], ["permno", "namedt"], "left")
        flags.append(F.coalesce(F.col(flag), F.lit(False)))
    keep = flags[0] if len(flags) == 1 else flags[0] | flags[1]
    return master.where(keep).drop("_named_C", "_named_T")


def year_bounds(provider: DataFrame) -> tuple[Column, Column]:
    """First and last year of a provider, from one scalar subquery."""
    bounds = provider.select(F.struct(F.min("year").alias("first"), F.max("year").alias("last"))).scalar()
    return bounds["first"], bounds["last"]


def filter_by_years(master: DataFrame, provider: DataFrame) -> DataFrame:
    """Segments valid at some time within the provider's years."""
    first, last = year_bounds(provider)
    return master.where((F.col("namedt") < dates.year_end(last)) & (F.col("nameendt") >= dates.year_start(first)))


def best_by_key_year(keyed: DataFrame, first: Column, last: Column) -> DataFrame:
    """Best segment per (key_kind, key, year) for the years from `first` to `last`.

    A segment is repeated once per year it covers, at most `last - first + 1` times, and the
    partial top-1 keeps one row per key and year in each task before anything is shuffled.
    """
    from_year = F.greatest(F.year("namedt"), first)
    to_year = F.least(F.year("nameendt"), last)
    yearly = (
        keyed.withColumns({"_from": from_year, "_to": to_year})
        .where("_from <= _to")
        .withColumn("year", F.explode(F.sequence("_from", "_to")))
        .drop("_from", "_to")
        .withColumn(
            "overlap_days",
            dates.overlap_days(
                dates.year_start(F.col("year")), dates.year_end(F.col("year")), F.col("namedt"), F.col("nameendt")
            ),
        )
        .where("overlap_days > 0")
        .withColumn(
            "segment_score",
            scores.segment_score(*[F.col(c) for c in ("is_common", "is_primary_permno", "exchcd", "overlap_days")],
                                 F.col("linkprim_score"), F.col("linktype_rank")),
        )
    )
    return keep_first(yearly, ["key_kind", "key", "year"], _best_first())


def match_provider(
    provider: DataFrame,
    master: DataFrame,
    spec: ProviderSpec,
    passes: Sequence[Pass] | None = None,
    years: DataFrame | None = None,
) -> DataFrame:
    """Best segment per (entity, year); the first pass that finds any decides.

    `provider` has one row per (entity, year) with its key columns; `master` is a loaded
    master (`conform.load_master`). `years` may be a cheaper frame whose
    years cover the provider's, such as its rows before de-duplication: they only bound how
    far segments are spread over years.
    """
    matched = provider_candidates(provider, master, spec, passes, years)
    return matched.where("match_src IS NOT NULL").select(*spec.output)


def provider_candidates(
    provider: DataFrame,
    master: DataFrame,
    spec: ProviderSpec,
    passes: Sequence[Pass] | None = None,
    years: DataFrame | None = None,
) -> DataFrame:
    """All provider rows, with the match columns null where nothing was found."""
    passes = tuple(passes or spec.passes)
    if spec.prefilter:
        master = filter_by_identifiers(master, provider)
    kinds = list(dict.fromkeys(p.kind for p in passes))
    best = best_by_key_year(master_keys(master, kinds), *year_bounds(provider if years is None else years))
    found_columns = [*_SEGMENT[:-2], "overlap_days", "segment_score"]

    result = provider.withColumn("_found", F.lit(None)).withColumn("match_src", F.lit(None).cast("string"))
    result = result.withColumn("_points", F.lit(None).cast("int"))
    first = True
    for step in passes:
        entry = best.where(F.col("key_kind") == step.kind).select(
            F.col("key").alias("_key"), F.col("year"), F.struct(*found_columns).alias("_hit")
        )
        # Rows an earlier pass already matched no longer look anything up.
        wanted = F.col(step.key) if first else F.when(F.col("match_src").isNull(), F.col(step.key))
        result = spread_join(result.withColumn("_key", wanted), entry, ["_key", "year"], [spec.entity], "left")
        new = F.col("match_src").isNull() & F.col("_hit").isNotNull()
        result = result.withColumns(
            {
                "_found": F.col("_hit") if first else F.coalesce("_found", "_hit"),
                "_points": F.when(new, F.lit(step.points)).otherwise(F.col("_points")),
                "match_src": F.when(new, F.lit(step.label)).otherwise(F.col("match_src")),
            }
        ).drop("_hit", "_key")
        first = False

    fields = {c: F.col("_found")[c] for c in found_columns if c not in ("ticker", "segment_score")}
    fields[spec.master_ticker] = F.col("_found")["ticker"]
    fields["match_score"] = F.col("_points") + F.col("_found")["segment_score"]
    return result.withColumns(fields).drop("_found", "_points")


def unmatched_after(provider: DataFrame, matches: DataFrame, entity: str) -> DataFrame:
    """Provider rows whose (entity, year) is not among `matches`; both sides hold each pair once."""
    return provider.join(matches.select(entity, "year"), [entity, "year"], "left_anti")
