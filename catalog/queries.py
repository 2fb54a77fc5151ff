"""One query per operator. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from catalog import inputs
from idlink import schemas
from idlink.functions import coerce, dates, identifiers, scores
from idlink.operators import cascade, crosswalk, dyadic, panel, primary, quality, reports, segments, snapshots
from idlink.operators.cascade import CUSIP6, PROVIDER_A, PROVIDER_C, TICKER, Pass
from idlink.plans import mapping
from idlink.plans.master import get_or_build_master, linked_segments
from idlink.session import scratch_path
from idlink.sources import conform, readers, sinks
from idlink.sources.derived import TABLES, derive
from idlink.streaming import compaction
from idlink.streaming.snapshots import accumulate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_c = F.col


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _odd(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "odd_values")


# ---- sources ---------------------------------------------------------------------------


def _export(spark: SparkSession, df: DataFrame, name: str, **options: str) -> str:
    path = scratch_path(spark, name)
    # The writer would trim texts by default; an export must not change them.
    trim = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    df.write.option("header", True).options(**trim, **options).csv(path)
    return path


@query
def scan_csv_lower(spark, sf):
    raw = derive(spark, sf, "names_raw")
    path = _export(spark, raw.toDF(*[c.upper() for c in raw.columns]), "names_csv")
    rows = readers.read_delimited(spark, path).withColumns({"src_id": _c("src_id").cast("long"), "copy_no": _c("copy_no").cast("int")})
    return conform.clean_names(rows, keep=["src_id", "copy_no"])


@query
def scan_pruned(spark, sf):
    raw = derive(spark, sf, "names")
    path = _export(spark, raw.toDF(*[c.upper() for c in raw.columns]), "names_csv")
    return readers.read_delimited(spark, path, columns=["Permno", "ncusip", "TICKER"])


@query
def scan_encoding(spark, sf):
    raw = derive(spark, sf, "provider_a").select("orgpermid", "year", F.concat(F.lit("Société "), "comname").alias("comname"))
    path = _export(spark, raw, "provider_csv", encoding="ISO-8859-1")
    rows = readers.read_delimited(spark, path, encoding="ISO-8859-1")
    return rows.select("orgpermid", _c("year").try_cast("int").alias("year"), "comname")


@query
def scan_quoted(spark, sf):
    """Texts with quotes, commas and line breaks, out and back."""
    raw = derive(spark, sf, "provider_a").select("orgpermid", "year", F.concat(F.lit('"A", '), "comname", F.lit('\n""b')).alias("comname"))
    path = _export(spark, raw, "quoted_csv")
    rows = readers.read_delimited(spark, path, multiLine="true")
    return rows.select("orgpermid", _c("year").try_cast("int").alias("year"), "comname")


@query
def scan_cp1252(spark, sf):
    raw = derive(spark, sf, "provider_a").select("orgpermid", "year", F.concat(F.lit("Société \x80\x93 "), "comname").alias("comname"))
    path = _export(spark, raw, "cp1252_csv", encoding="ISO-8859-1")
    rows = readers.read_delimited(spark, path, encoding="windows-1252")
    return rows.select("orgpermid", _c("year").try_cast("int").alias("year"), "comname")


def _ragged(spark, sf):
    """Lines of a delimited file: every seventh provider has a field too many, every eleventh one too few."""
    raw = derive(spark, sf, "provider_a")
    number, name = _c("orgpermid").cast("long"), F.concat(F.lit(',"'), "comname", F.lit('"'))
    last = F.when(number % 7 == 0, F.concat(name, F.lit(",extra"))).when(number % 11 == 0, "").otherwise(name)
    line = F.concat("orgpermid", F.lit(","), _c("year").cast("string"), last).alias("ORGPERMID,YEAR,COMNAME")
    path, bad = scratch_path(spark, "ragged_csv"), scratch_path(spark, "quarantine")
    raw.select(line).write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return readers.read_delimited(spark, path, quarantine=bad), bad


@query
def scan_ragged(spark, sf):
    """The rows that are left when those with too many fields go to quarantine."""
    rows, _ = _ragged(spark, sf)
    return rows.select("orgpermid", _c("year").try_cast("int").alias("year"), "comname")


@query
def scan_quarantine(spark, sf):
    _, bad = _ragged(spark, sf)
    return spark.read.parquet(bad).select("reason", "fields", "line")


@query
def scan_multifile(spark, sf):
    raw = derive(spark, sf, "provider_b")
    label = F.regexp_extract("file_name", r"(\d{4})", 1)
    path = scratch_path(spark, "annual")
    raw.withColumn("report", label).drop("file_name").write.partitionBy("report").option("header", True).csv(path)
    rows = readers.read_annual(spark, path, ["issuerid", "issuer_name", "issuer_cusip", "issuer_isin", "src_id"], "*.csv")
    rows = rows.withColumn("src_id", _c("src_id").cast("long"))
    return conform.clean_provider_b(rows, ["src_id"])


@query
def scan_parquet(spark, sf):
    path = scratch_path(spark, "provider_parquet")
    derive(spark, sf, "provider_c").withColumnRenamed("environmental", "Environmental").write.parquet(path)
    return readers.read_parquet(spark, path, ["symbol", "year", "Environmental", "src_id"])


@query
def scan_constituents(spark, sf):
    raw = derive(spark, sf, "constituents").withColumnsRenamed(
        {"date": "Date", "ric": "Instrument RIC", "isin": "TR.ISIN", "cusip": "CUSIP code", "ticker": "Ticker"}
    ).withColumn("Price Close", F.lit("1.0"))
    return conform.clean_constituents(raw, keep=["row_id"])


@query
def scan_alike_headers(spark, sf):
    raw = derive(spark, sf, "constituents").withColumn("ISIN New", F.reverse("isin"))
    raw = raw.withColumnsRenamed({"isin": "ISIN Old", "cusip": "CUSIP code"}).withColumn("CUSIP other", F.lit("x"))
    return conform.clean_constituents(raw.select("date", "ric", "ISIN Old", "ISIN New", "CUSIP other", "CUSIP code", "ticker", "row_id"), keep=["row_id"])


_LINK_COLUMNS = ["linkdt", "linkenddt", "overlap_days", "cusip6_match"]
_MATCHING_COLUMNS = ["shrcd", "exchcd", "ncusip", "primary_permno"]
_NOT_LOADED = {
    "permco", "comnam", "tsymbol", "shrcls", "exch", "primexch", "siccd", "naics", "cusip", "cusip6", "linkprim", "linktype",
}
_LOADED = [c for c in schemas.SECURITY_MASTER.columns if c not in _NOT_LOADED]
_MAPPER_COLUMNS = [c for c in _LOADED if c not in _LINK_COLUMNS]
_PANEL_COLUMNS = [*[c for c in _LOADED if c not in _MATCHING_COLUMNS], "cusip6_link"]


@query
def load_master(spark, sf):
    return inputs.loaded_master(spark, sf).select(*_MAPPER_COLUMNS)


@query
def load_master_panel(spark, sf):
    return inputs.loaded_master(spark, sf).select(*_PANEL_COLUMNS)


@query
def is_common_fallback(spark, sf):
    stored = inputs.master(spark, sf).drop("is_common", "is_primary_permno", "ncusip6")
    return conform.load_master(stored).select(*schemas.SEGMENT_KEY, "shrcd", "is_common", "is_primary_permno", "ncusip6")


# ---- sinks -----------------------------------------------------------------------------


@query
def sink_master(spark, sf):
    path = scratch_path(spark, "master")
    sinks.write_master(inputs.master(spark, sf), path)
    return spark.read.parquet(path)


@query
def sink_matches(spark, sf):
    path = scratch_path(spark, "matches")
    for letter in inputs.SPECS:
        spec = inputs.SPECS[letter]
        rows = inputs.matches(spark, sf, letter).withColumn("provider", F.lit(spec.name))
        sinks.write_matches(rows, f"{path}/{spec.name}", spec.entity)
    parts = [
        spark.read.parquet(f"{path}/{s.name}").select("provider", _c(s.entity).alias("entity_id"), "year", "match_src", "gvkey")
        for s in inputs.SPECS.values()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def sink_format(spark, sf):
    path = scratch_path(spark, "export")
    rows = snapshots.dedup_date_ric(inputs.constituents(spark, sf), ["row_id"]).select("date", "ric", "ticker")
    sinks.write_by_suffix(rows, f"{path}.parquet", ["date", "ric"])
    sinks.write_by_suffix(rows, f"{path}.csv", ["date", "ric"])
    text = readers.read_delimited(spark, f"{path}.csv").withColumn("date", coerce.to_date(_c("date")))
    both = spark.read.parquet(f"{path}.parquet").withColumn("fmt", F.lit("parquet"))
    return both.unionByName(text.withColumn("fmt", F.lit("csv")))


@query
def sink_panel(spark, sf):
    path = scratch_path(spark, "panel")
    sinks.write_panel(inputs.panel(spark, sf), path)
    return inputs.rounded(spark.read.parquet(path), "rank_score")


@query
def sink_primary(spark, sf):
    path = scratch_path(spark, "primary")
    sinks.write_primary_table(primary.primary_table(inputs.master(spark, sf)), path)
    return spark.read.parquet(path)


@query
def sink_crosswalk(spark, sf):
    path = scratch_path(spark, "crosswalks")
    sinks.write_crosswalks(crosswalk.consolidate(inputs.crosswalks(spark, sf)), path)
    return spark.read.parquet(path)


@query
def sink_grid(spark, sf):
    path = scratch_path(spark, "grid") + ".parquet"
    sinks.write_grid(panel.ml_grid(inputs.panel(spark, sf)), path)
    return spark.read.parquet(path)


@query
def sink_audit(spark, sf):
    path = scratch_path(spark, "audit") + ".parquet"
    sinks.write_audit(reports.audit_sample(inputs.panel(spark, sf)), path)
    return spark.read.parquet(path)


@query
def sink_unmatched(spark, sf):
    path = scratch_path(spark, "unmatched")
    rows = inputs.panel(spark, sf)
    sinks.write_unmatched(rows, path)
    # Read back with the types it was written with: a delimited file has none.
    return spark.read.schema(reports.unmatched_constituents(rows).schema).csv(path, header=True, escape='"')


@query
def master_cached(spark, sf):
    path = scratch_path(spark, "master_cached")
    get_or_build_master(spark, path, lambda: inputs.new_master(spark, sf))
    return get_or_build_master(spark, path, lambda: inputs.new_master(spark, sf))


# ---- scalar functions ------------------------------------------------------------------


@query
def norm_string(spark, sf):
    return _odd(spark, sf).select("row_id", identifiers.norm_string(_c("ticker_text")).alias("ticker"))


@query
def norm_upper(spark, sf):
    return _odd(spark, sf).select("row_id", F.upper("ticker_text").alias("ticker"))


@query
def null_tokens(spark, sf):
    return _odd(spark, sf).select("row_id", coerce.null_tokens(_c("ticker_text")).alias("ticker"))


@query
def norm_gvkey(spark, sf):
    return _odd(spark, sf).select("row_id", identifiers.norm_gvkey(_c("gvkey_text")).alias("gvkey"))


@query
def cusip6(spark, sf):
    return derive(spark, sf, "names").select("src_id", identifiers.cusip6(_c("ncusip")).alias("ncusip6"))


@query
def isin_cusip6(spark, sf):
    return _odd(spark, sf).select("row_id", identifiers.isin_cusip6(_c("isin_text")).alias("cusip6"))


@query
def clean_symbol(spark, sf):
    return _odd(spark, sf).select("row_id", identifiers.clean_symbol(_c("symbol_text")).alias("symbol"))


@query
def ric_ticker(spark, sf):
    return _odd(spark, sf).select("row_id", identifiers.ric_ticker(_c("symbol_text")).alias("ticker"))


@query
def coerce_bool(spark, sf):
    odd = _odd(spark, sf)
    number = coerce.to_boolean(F.when(_c("custkey") > 100, _c("custkey") % 2), LongType())
    return odd.select("row_id", coerce.to_boolean(_c("flag_text")).alias("flag"), number.alias("odd_customer"))


@query
def coerce_num(spark, sf):
    return _odd(spark, sf).select("row_id", coerce.to_integer(_c("number_text"), LongType()).alias("number"))


@query
def coerce_dates(spark, sf):
    parsed = coerce.to_date(_c("date_text"))
    return _odd(spark, sf).select("row_id", parsed.alias("start_date"), coerce.open_end(parsed).alias("end_date"))


@query
def epoch_year(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    seconds = F.unix_date(_c("ts").cast("date")).cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    raw = events.select("event_id", (seconds * 1000).alias("periodEndDate"))
    return conform.epoch_year(raw).select("event_id", "period_end", "year")


@query
def epoch_year_timestamp(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return conform.epoch_year(events.select("event_id", _c("ts").alias("periodEndDate"))).select("event_id", "period_end", "year")


@query
def year_window(spark, sf):
    return conform.with_year_window(_odd(spark, sf).select("row_id", "year"))


@query
def extract_year(spark, sf):
    return inputs.provider_b_raw(spark, sf).select("src_id", "file_name", "year")


@query
def extract_year_from_name(spark, sf):
    raw = derive(spark, sf, "provider_b").drop("as_of_date")
    return readers.extract_year(raw, "file_name").select("src_id", "file_name", "year")


@query
def month_end(spark, sf):
    return _odd(spark, sf).select("row_id", F.last_day("day").alias("month_end"))


@query
def overlap_days(spark, sf):
    windows = conform.with_year_window(derive(spark, sf, "names").withColumn("year", F.year("namedt")))
    bounds = [_c(x) for x in ("valid_from", "valid_to", "namedt", "nameendt")]
    return windows.select("src_id", dates.overlap_days(*bounds).alias("overlap_days"))


@query
def overlap_builder(spark, sf):
    windows = conform.with_year_window(derive(spark, sf, "names").withColumn("year", F.year("namedt")))
    bounds = [_c(x) for x in ("namedt", "nameendt", "valid_from", "valid_to")]
    return windows.select("src_id", dates.touching_overlap_days(*bounds).alias("overlap_days"))


@query
def cusip6_match(spark, sf):
    same = scores.cusip6_match(identifiers.cusip6(_c("cusip")), identifiers.isin_cusip6(_c("isin")))
    return derive(spark, sf, "provider_a").select("orgpermid", "year", same.alias("cusip6_match"))


@query
def flags_labels(spark, sf):
    rows = segments.with_flags(derive(spark, sf, "names"))
    return rows.select("src_id", "shrcd", "is_common", "exchcd", "exch")


@query
def primary_flag(spark, sf):
    return inputs.master(spark, sf).select(*schemas.SEGMENT_KEY, "primary_permno", "is_primary_permno")


def _loaded_scores(spark, sf):
    return inputs.loaded_master(spark, sf)


@query
def match_score(spark, sf):
    m = _loaded_scores(spark, sf)
    args = [_c(c) for c in ("is_common", "is_primary_permno", "exchcd", "overlap_days", "linkprim_score", "linktype_rank")]
    base = scores.segment_score(*args)
    points = schemas.PASS_POINTS
    return m.select(
        *schemas.SEGMENT_KEY,
        *[(base + points[label]).alias(f"score_{label.lower()}") for label in points],
    )


@query
def rank_score_permno(spark, sf):
    args = [_c(c) for c in ("is_primary_permno", "is_common", "cusip6_match", "linkprim_score", "linktype_rank", "overlap_days")]
    return _loaded_scores(spark, sf).select(*schemas.SEGMENT_KEY, F.round(scores.permno_rank_score(*args), 6).alias("rank_score"))


@query
def rank_score_gvkey(spark, sf):
    args = [_c(c) for c in ("linkprim_score", "linktype_rank", "overlap_days")]
    return _loaded_scores(spark, sf).select(*schemas.SEGMENT_KEY, F.round(scores.gvkey_rank_score(*args), 6).alias("rank_score"))


# ---- clean inputs and filters ----------------------------------------------------------


@query
def names_clean(spark, sf):
    return conform.clean_names(derive(spark, sf, "names_raw"), keep=["src_id", "copy_no"])


@query
def links_clean(spark, sf):
    return conform.clean_links(derive(spark, sf, "links"), keep=["src_id"])


@query
def provider_a_clean(spark, sf):
    return inputs.provider(spark, sf, "a")


@query
def provider_b_clean(spark, sf):
    return inputs.provider(spark, sf, "b")


@query
def provider_c_clean(spark, sf):
    return inputs.provider(spark, sf, "c")


@query
def drop_null_keys(spark, sf):
    return conform.drop_missing(inputs.constituents(spark, sf), ["cusip", "ticker"])


@query
def semi_filter(spark, sf):
    rows = cascade.filter_by_identifiers(inputs.loaded_master(spark, sf), inputs.provider(spark, sf, "c"))
    return rows.select(*schemas.SEGMENT_KEY, "ncusip6", "ticker")


@query
def semi_filter_ticker(spark, sf):
    rows = cascade.filter_by_identifiers(inputs.loaded_master(spark, sf), inputs.provider(spark, sf, "a"))
    return rows.select(*schemas.SEGMENT_KEY, "ncusip6", "ticker")


@query
def date_filter(spark, sf):
    rows = cascade.filter_by_years(inputs.loaded_master(spark, sf), inputs.provider(spark, sf, "a"))
    return rows.select(*schemas.SEGMENT_KEY)


@query
def dedup_entity_year(spark, sf):
    return inputs.provider(spark, sf, "c").select("symbol", "year", "isin", "environmental", "social")


# ---- security master -------------------------------------------------------------------


_LINKED = [
    *schemas.SEGMENT_KEY, "ncusip6", "gvkey", "linkdt", "linkenddt", "linkprim", "linktype", "linkprim_score",
    "linktype_rank", "overlap_days", "cusip6_match",
]


@query
def segment_links(spark, sf):
    return segments.segment_links(inputs.names(spark, sf), inputs.links(spark, sf)).select(*_LINKED)


@query
def interval_pairs(spark, sf):
    ranges = (("namedt", "nameendt"), ("linkdt", "linkenddt"))
    links = inputs.links(spark, sf).select("permno", *segments.LINK_COLUMNS)
    pairs = dyadic.touching_pairs(inputs.names(spark, sf), links, ["permno"], *ranges)
    return pairs.select(*schemas.SEGMENT_KEY, "ncusip", "gvkey", "linkdt", "linkenddt", "cusip", "linkprim", "linktype")


@query
def best_link(spark, sf):
    names = conform.clean_names(derive(spark, sf, "names_raw"), keep=["src_id", "copy_no"])
    best = segments.best_links(names, inputs.links(spark, sf), order_by=("copy_no", "src_id"))
    return best.where("linkdt IS NOT NULL").select(*_LINKED, "src_id", "copy_no")


@query
def unmatched_segments(spark, sf):
    rows = segments.best_links(inputs.names(spark, sf), inputs.links(spark, sf)).where("linkdt IS NULL")
    return rows.select(*schemas.SEGMENT_KEY, "gvkey", "overlap_days", "cusip6_match", "linkprim_score", "linktype_rank")


@query
def dedup_segments(spark, sf):
    names = conform.clean_names(derive(spark, sf, "names_raw"), keep=["src_id", "copy_no"])
    return segments.dedup_segments(names, ["copy_no", "src_id"])


@query
def security_master(spark, sf):
    return inputs.new_master(spark, sf)


def _linked(spark, sf):
    return linked_segments(inputs.names(spark, sf), inputs.links(spark, sf))


@query
def one_to_one(spark, sf):
    return primary.one_to_one_pairs(_linked(spark, sf).where("gvkey IS NOT NULL").select("gvkey", "permno"))


@query
def pair_stats(spark, sf):
    return primary.pair_statistics_with_degree(_linked(spark, sf))


@query
def primary_permno(spark, sf):
    return primary.primary_map(_linked(spark, sf))


@query
def primary_table(spark, sf):
    return primary.primary_table(inputs.master(spark, sf))


@query
def check_types(spark, sf):
    return quality.check_types(derive(spark, sf, "names_raw"), schemas.NAMES)


@query
def check_spans(spark, sf):
    return quality.check_spans(inputs.master(spark, sf))


@query
def check_primary(spark, sf):
    return quality.check_primary(inputs.master(spark, sf))


# ---- provider matching -----------------------------------------------------------------


@query
def match_cusip6(spark, sf):
    return inputs.match(spark, sf, "a", passes=PROVIDER_A.passes[:1])


@query
def match_ticker(spark, sf):
    spec = cascade.ProviderSpec("provider_c", "symbol", (Pass("TICKER", "clean_symbol", TICKER),), PROVIDER_C.columns, "ticker")
    return inputs.match(spark, sf, "c", spec)


@query
def anti_matched(spark, sf):
    rows = inputs.provider(spark, sf, "a")
    found = inputs.match(spark, sf, "a", passes=PROVIDER_A.passes[:1])
    left = cascade.unmatched_after(rows, found, "orgpermid")
    return left.select("orgpermid", "year", "cusip6_from_isin")


@query
def best_match(spark, sf):
    keyed = cascade.master_keys(inputs.loaded_master(spark, sf), [CUSIP6, TICKER])
    best = cascade.best_by_key_year(keyed, *cascade.year_bounds(inputs.provider_years(spark, sf, "a")))
    return best.select("key_kind", "key", "year", "permno", "namedt", "nameendt", "gvkey", "overlap_days", "segment_score")


@query
def match_provider_a(spark, sf):
    return inputs.new_matches(spark, sf, "a")


@query
def match_provider_b(spark, sf):
    return inputs.new_matches(spark, sf, "b")


@query
def match_provider_c(spark, sf):
    return inputs.new_matches(spark, sf, "c")


@query
def match_provider_c_unfiltered(spark, sf):
    spec = cascade.ProviderSpec("provider_c", "symbol", PROVIDER_C.passes, PROVIDER_C.columns, "ticker")
    return inputs.match(spark, sf, "c", spec)


@query
def crosswalk_agg(spark, sf):
    return crosswalk.firm_candidates(inputs.matches(spark, sf, "a"), "orgpermid").drop("primary_permno")


@query
def modal_permno(spark, sf):
    rows = crosswalk.firm_candidates(inputs.matches(spark, sf, "c"), "symbol")
    return rows.select("symbol", "gvkey", _c("primary_permno").alias("modal_permno"))


@query
def crosswalk_a(spark, sf):
    return crosswalk.crosswalk(inputs.matches(spark, sf, "a"), "orgpermid")


@query
def crosswalk_b(spark, sf):
    return crosswalk.crosswalk(inputs.matches(spark, sf, "b"), "issuer_id")


@query
def crosswalk_c(spark, sf):
    return crosswalk.crosswalk(inputs.matches(spark, sf, "c"), "symbol")


@query
def consolidated_crosswalk(spark, sf):
    return crosswalk.consolidate(inputs.crosswalks(spark, sf))


@query
def pipeline_crosswalk(spark, sf):
    """All providers through the mapping job, every stage stored."""
    sources = [mapping.Source(spec, partial(inputs.provider, spark, sf, letter)) for letter, spec in inputs.SPECS.items()]
    done, failed = mapping.map_all(sources, inputs.loaded_master(spark, sf), stage=sinks.stored(spark, "provider"))
    for error in failed.values():
        raise error
    return mapping.consolidated(done)


@query
def pipeline_concurrent(spark, sf):
    """The same with all providers at once."""
    sources = [mapping.Source(spec, partial(inputs.provider, spark, sf, letter)) for letter, spec in inputs.SPECS.items()]
    done, failed = mapping.map_all(sources, inputs.loaded_master(spark, sf), sinks.stored(spark, "provider"), at_once=len(sources))
    for error in failed.values():
        raise error
    return mapping.consolidated(done)


@query
def pipeline_one_fails(spark, sf):
    """One provider fails while its rows are read; the others come out, and its name is reported."""

    def load(letter):
        rows = inputs.provider(spark, sf, letter)
        if letter == "a":
            rows = rows.where(F.when(_c("orgpermid").isNotNull(), F.raise_error(F.lit("unreadable")).cast("boolean")).otherwise(True))
        return rows

    sources = [mapping.Source(spec, partial(load, letter)) for letter, spec in inputs.SPECS.items()]
    done, failed = mapping.map_all(sources, inputs.loaded_master(spark, sf), sinks.stored(spark, "provider"), at_once=2)
    rows = mapping.consolidated(done).groupBy("provider").agg(F.count(F.lit(1)).alias("n_entities"), F.countDistinct("gvkey").alias("n_firms"))
    names = spark.createDataFrame([(name,) for name in failed], "provider string")
    nothing = F.lit(0).cast("long")
    return rows.withColumn("failed", F.lit(False)).unionByName(
        names.select("provider", nothing.alias("n_entities"), nothing.alias("n_firms"), F.lit(True).alias("failed"))
    )


# ---- panel -----------------------------------------------------------------------------


@query
def month_snapshots(spark, sf):
    return inputs.snapshots(spark, sf)


@query
def dedup_date_ric(spark, sf):
    return snapshots.dedup_date_ric(inputs.constituents(spark, sf), ["row_id"])


_FOUND = ["row_id", "date", "match_type", "n_candidates", "gvkey", "permno", "permno_type", "rank_score"]


@query
def asof_cusip6(spark, sf):
    rows = panel.panel_best(inputs.snapshots(spark, sf), inputs.loaded_master(spark, sf), kinds=(CUSIP6,))
    return inputs.rounded(rows.where("match_type = 'CUSIP6'").select(*_FOUND), "rank_score")


@query
def asof_ticker(spark, sf):
    rows = panel.panel_best(inputs.snapshots(spark, sf), inputs.loaded_master(spark, sf))
    return inputs.rounded(rows.where("match_type = 'TICKER'").select(*_FOUND), "rank_score")


@query
def panel_best(spark, sf):
    rows = panel.panel_best(inputs.snapshots(spark, sf), inputs.loaded_master(spark, sf))
    return inputs.rounded(rows.select(*_FOUND), "rank_score")


_WINNER = ["key_kind", "key", "snapshot_date", "n_candidates", "n_firms", "gvkey", "permno", "rank_score"]


@query
def winner_envelope(spark, sf):
    best = panel.best_by_key_date(inputs.loaded_master(spark, sf), inputs.snapshots(spark, sf), paired=0)
    return inputs.rounded(best.select(*_WINNER), "rank_score")


@query
def firm_timeline(spark, sf):
    pieces = panel.firm_pieces(panel.panel_keys(inputs.loaded_master(spark, sf)))
    return pieces.select(
        "key_kind",
        "key",
        "gvkey",
        dyadic.day_of(F.col("day")).alias("from_date"),
        dyadic.day_of(F.col("until")).alias("until_date"),
        "n",
        F.col("by_firm.permno").alias("firm_permno"),
        F.col("by_security.permno").alias("security_permno"),
    )


@query
def panel_dedup(spark, sf):
    rows = panel.panel_best(inputs.snapshots(spark, sf), inputs.loaded_master(spark, sf))
    return inputs.rounded(panel.panel_dedup(rows).select(*_FOUND), "rank_score")


@query
def monthly_panel(spark, sf):
    return inputs.rounded(inputs.new_panel(spark, sf), "rank_score")


@query
def monthly_panel_collapsed(spark, sf):
    return inputs.rounded(inputs.new_panel(spark, sf, collapse_unmatched=True), "rank_score")


@query
def ml_grid(spark, sf):
    return panel.ml_grid(inputs.panel(spark, sf))


@query
def panel_unmatched(spark, sf):
    return reports.unmatched_constituents(inputs.panel(spark, sf))


@query
def panel_audit(spark, sf):
    return reports.audit_sample(inputs.panel(spark, sf))


@query
def check_panel_dups(spark, sf):
    return quality.check_panel_duplicates(inputs.panel(spark, sf))


@query
def panel_coverage(spark, sf):
    return reports.panel_coverage(inputs.panel(spark, sf))


@query
def panel_match_rate(spark, sf):
    return inputs.rounded(reports.panel_match_rate(inputs.panel(spark, sf)), "gvkey_rate", "permno_rate")


# ---- reports ---------------------------------------------------------------------------


@query
def match_summary(spark, sf):
    rows = cascade.provider_candidates(
        inputs.provider(spark, sf, "a"), inputs.loaded_master(spark, sf), PROVIDER_A, years=inputs.provider_years(spark, sf, "a")
    )
    return inputs.rounded(reports.match_summary(rows, "orgpermid"), "match_rate")


@query
def value_counts(spark, sf):
    parts = [
        reports.value_counts(inputs.matches(spark, sf, "a"), "match_src").withColumn("category", F.lit("match_src_a")),
        reports.value_counts(inputs.matches(spark, sf, "c"), "match_src").withColumn("category", F.lit("match_src_c")),
        reports.value_counts(inputs.panel(spark, sf), "match_type").withColumn("category", F.lit("match_type")),
        reports.value_counts(inputs.panel(spark, sf), "permno_type").withColumn("category", F.lit("permno_type")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def availability(spark, sf):
    return inputs.rounded(reports.availability(inputs.provider(spark, sf, "a"), PROVIDER_A.availability), "share")


@query
def score_availability(spark, sf):
    columns = ["environmental", "social", "governance", "esg"]
    return inputs.rounded(reports.availability(inputs.matches(spark, sf, "c"), columns), "share")


@query
def matches_by_year(spark, sf):
    return reports.matches_by_year(inputs.matches(spark, sf, "c"))


@query
def monthly_counts(spark, sf):
    return snapshots.monthly_counts(inputs.constituents(spark, sf))


@query
def monthly_count_summary(spark, sf):
    return inputs.rounded(snapshots.monthly_count_summary(inputs.constituents(spark, sf)), "avg_members")


@query
def id_coverage(spark, sf):
    return inputs.rounded(reports.id_coverage(inputs.constituents(spark, sf)), "isin_rate", "cusip_rate")


@query
def universe_coverage(spark, sf):
    rows = reports.universe_coverage(inputs.panel(spark, sf), inputs.all_matches(spark, sf))
    return inputs.rounded(rows, "coverage")


@query
def top_gvkeys(spark, sf):
    return reports.top_gvkeys(crosswalk.consolidate(inputs.crosswalks(spark, sf)))


@query
def gvkey_common(spark, sf):
    return reports.gvkey_common(inputs.all_matches(spark, sf))


@query
def gvkey_pairwise(spark, sf):
    return reports.gvkey_pairwise(inputs.all_matches(spark, sf))


@query
def firm_overlap_by_source(spark, sf):
    """Shared firms of any two years of provider A, each year taken for a provider: plans do not grow with providers."""
    rows = inputs.matches(spark, sf, "a").select(_c("year").cast("string").alias("provider"), "gvkey")
    return reports.gvkey_pairwise(rows)


@query
def gvkey_exclusive(spark, sf):
    return reports.gvkey_exclusive(inputs.all_matches(spark, sf))


@query
def master_summary(spark, sf):
    return reports.master_summary(inputs.master(spark, sf))


@query
def provider_summary(spark, sf):
    return reports.provider_summary({s.name: (inputs.matches(spark, sf, x), s.entity) for x, s in inputs.SPECS.items()})


@query
def consolidated_summary(spark, sf):
    return reports.consolidated_summary(crosswalk.consolidate(inputs.crosswalks(spark, sf)))


@query
def constituent_summary(spark, sf):
    return reports.constituent_summary(inputs.constituents(spark, sf))


@query
def ml_grid_summary(spark, sf):
    return reports.grid_summary(panel.ml_grid(inputs.panel(spark, sf)))


# ---- accumulation of snapshots ---------------------------------------------------------


def _feeds(spark, sf):
    rows = inputs.constituents(spark, sf).select("date", "ric", "isin", "cusip", "row_id")
    primary_feed = rows.where(F.month("date") != 12)
    bare = F.lit(None).cast("string")
    fallback_feed = rows.withColumns({"isin": bare, "cusip": bare})
    return primary_feed, fallback_feed


@query
def month_fallback(spark, sf):
    return snapshots.month_fallback(*_feeds(spark, sf))


@query
def month_spine(spark, sf):
    return snapshots.month_spine(inputs.constituents(spark, sf), F.min("date"), F.max("date"))


def _members_of_orders(orders: DataFrame) -> DataFrame:
    rows = orders.sparkSession.sql(TABLES["constituents"], orders=orders)
    return conform.clean_constituents(rows, keep=["row_id"])


def _streamed(spark, sf, **options):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    work = scratch_path(spark, "stream")
    table = accumulate(
        spark, sf, orders.schema, f"{work}/table", f"{work}/checkpoint", transform=_members_of_orders, pattern="orders.parquet", **options
    )
    return table.select("date", "ric", "isin", "cusip", "ticker", "row_id")


@query
def stream_snapshots(spark, sf):
    return _streamed(spark, sf)


@query
def stream_compacted(spark, sf):
    """Four batches, of which all years are compacted; superseded files are deleted, and a run without new files follows."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    work = scratch_path(spark, "stream")
    orders.repartition(4, "o_orderdate").write.option("maxRecordsPerFile", 0).parquet(f"{work}/in")
    options = {"transform": _members_of_orders, "files_per_batch": 1}
    accumulate(spark, f"{work}/in", orders.schema, f"{work}/table", f"{work}/checkpoint", **options)
    compaction.compact(spark, f"{work}/table")
    compaction.vacuum(spark, f"{work}/table")
    table = accumulate(spark, f"{work}/in", orders.schema, f"{work}/table", f"{work}/checkpoint", **options)
    return table.select("date", "ric", "isin", "cusip", "ticker", "row_id")


@query
def stream_snapshots_state(spark, sf):
    """The same, with the delivered keys as stream state."""
    return _streamed(spark, sf, delay="400 days")
