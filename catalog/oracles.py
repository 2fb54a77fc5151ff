"""The same results as plain SQL over the given tables, for DuckDB.

Each statement restates the definition of its operator: joins on raw conditions and
`row_number()`, without the rewrites the Spark side uses.
"""

from __future__ import annotations

from idlink.schemas import NULL_TOKENS
from idlink.sources.derived import TABLES

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_FAR = "DATE '2262-04-11'"
_EDGE = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_EDGE}, '', 'g')"


def _norm(c: str) -> str:
    return f"NULLIF(UPPER({_strip(c)}), '')"


def _token(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END"


def _norm_token(c: str) -> str:
    return f"NULLIF(UPPER({_strip(_token(c))}), '')"


def _gvkey(c: str) -> str:
    digits = f"NULLIF(regexp_replace(regexp_replace({_strip(_token(c))}, '\\.0$', ''), '[^0-9]', '', 'g'), '')"
    return f"CASE WHEN length({digits}) < 6 THEN lpad({digits}, 6, '0') ELSE {digits} END"


def _isin6(c: str) -> str:
    return f"CASE WHEN substr({c}, 1, 2) IN ('US', 'CA') AND length({c}) >= 12 THEN substr({c}, 3, 6) END"


def _int(c: str, kind: str = "BIGINT") -> str:
    number = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"CASE WHEN {number} = floor({number}) THEN CAST({number} AS {kind}) END"


def _overlap(s1: str, e1: str, s2: str, e2: str) -> str:
    return f"greatest(0, least({e1}, {e2}) - greatest({s1}, {s2}))"


_BOOL = "CAST(COALESCE({0}, FALSE) AS INTEGER)"
_NULL_TEXT = "CAST(NULL AS VARCHAR)"

# ---- shared subqueries -----------------------------------------------------------------

_NAME_ORDER = "shrcd NULLS LAST, exchcd NULLS LAST, ncusip NULLS LAST, ticker NULLS LAST, comnam NULLS LAST, permco NULLS LAST"
_LINK_RANK = (
    "linkprim_score DESC NULLS LAST, linktype_rank DESC NULLS LAST, cusip6_match DESC, overlap_days DESC, linkdt NULLS LAST, "
    "gvkey NULLS LAST, linkenddt NULLS LAST, cusip NULLS LAST, linkprim NULLS LAST, linktype NULLS LAST"
)

_NAMES_TYPED = f"""
SELECT permno, permco, namedt, COALESCE(nameendt, {_FAR}) AS nameendt, UPPER(comnam) AS comnam, UPPER(ticker) AS ticker,
  {_NULL_TEXT} AS tsymbol, {_NULL_TEXT} AS shrcls, UPPER(ncusip) AS ncusip, shrcd, exchcd, {_NULL_TEXT} AS primexch,
  CAST(NULL AS INTEGER) AS siccd, CAST(NULL AS INTEGER) AS naics, substr(UPPER(ncusip), 1, 6) AS ncusip6
FROM names
"""

_NAMES_RAW_TYPED = f"""
SELECT {_int('permno')} AS permno, {_int('permco')} AS permco, TRY_CAST(namedt AS DATE) AS namedt,
  COALESCE(TRY_CAST(nameendt AS DATE), {_FAR}) AS nameendt, UPPER({_token('comnam')}) AS comnam,
  UPPER({_token('ticker')}) AS ticker, {_NULL_TEXT} AS tsymbol, {_NULL_TEXT} AS shrcls, UPPER({_token('ncusip')}) AS ncusip,
  {_int('shrcd', 'INTEGER')} AS shrcd, {_int('exchcd', 'INTEGER')} AS exchcd, {_NULL_TEXT} AS primexch,
  CAST(NULL AS INTEGER) AS siccd, CAST(NULL AS INTEGER) AS naics, src_id, copy_no,
  substr(UPPER({_token('ncusip')}), 1, 6) AS ncusip6
FROM names_raw WHERE TRY_CAST(namedt AS DATE) IS NOT NULL
"""

_LINKS_TYPED = f"""
SELECT lpermno AS permno, CAST(NULL AS BIGINT) AS permco, {_gvkey('gvkey')} AS gvkey,
  COALESCE(linkdt, DATE '1900-01-01') AS linkdt, COALESCE(linkenddt, {_FAR}) AS linkenddt, UPPER(cusip) AS cusip,
  UPPER(linkprim) AS linkprim, UPPER(linktype) AS linktype, substr(UPPER(cusip), 1, 6) AS cusip6,
  CASE WHEN UPPER(linkprim) IN ('P', 'C') THEN 1 ELSE 0 END AS linkprim_score,
  CASE UPPER(linktype) WHEN 'LU' THEN 2 WHEN 'LC' THEN 1 ELSE 0 END AS linktype_rank, src_id
FROM links
"""


def _pairs(names: str) -> str:
    return f"""
SELECT n.*, l.gvkey, l.linkdt, l.linkenddt, l.cusip, l.cusip6, l.linkprim, l.linktype, l.linkprim_score, l.linktype_rank,
  CASE WHEN l.linkdt IS NULL THEN 0
    ELSE CAST({_overlap('n.namedt', 'n.nameendt', 'l.linkdt', 'l.linkenddt')} AS INTEGER) END AS overlap_days,
  CASE WHEN n.ncusip6 = l.cusip6 THEN 1 ELSE 0 END AS cusip6_match
FROM {names} n LEFT JOIN links_typed l
  ON n.permno = l.permno AND n.namedt <= l.linkenddt AND n.nameendt >= l.linkdt
"""


_SEGMENTS = f"""
SELECT * EXCLUDE (linkprim_score, linktype_rank), COALESCE(linkprim_score, 0) AS linkprim_score,
  COALESCE(linktype_rank, 0) AS linktype_rank, COALESCE(shrcd IN (10, 11), FALSE) AS is_common,
  CASE exchcd WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' END AS exch
FROM (SELECT * FROM pairs
  QUALIFY row_number() OVER (PARTITION BY permno, namedt, nameendt ORDER BY {_LINK_RANK}, {_NAME_ORDER}) = 1)
"""

_PAIR_STATS = """
SELECT gvkey, permno, max(linkprim_score) AS linkprim_score, max(linktype_rank) AS linktype_rank,
  CAST(sum(greatest(0, nameendt - namedt)) AS BIGINT) AS seg_days, bool_or(is_common) AS has_common
FROM segments WHERE gvkey IS NOT NULL GROUP BY gvkey, permno
"""

_DEGREES = """
SELECT p.*, pd.n = 1 AND gd.n = 1 AS one2one FROM pair_stats p
JOIN (SELECT permno, count(DISTINCT gvkey) AS n FROM segments WHERE gvkey IS NOT NULL GROUP BY permno) pd USING (permno)
JOIN (SELECT gvkey, count(DISTINCT permno) AS n FROM segments WHERE gvkey IS NOT NULL GROUP BY gvkey) gd USING (gvkey)
"""

_PRIMARY = """
SELECT gvkey, permno AS primary_permno FROM pairs_with_degree
QUALIFY row_number() OVER (PARTITION BY gvkey
  ORDER BY has_common DESC, one2one DESC, linkprim_score DESC, linktype_rank DESC, seg_days DESC, permno) = 1
"""

_MASTER = """
SELECT s.permno, s.permco, s.gvkey, s.namedt, s.nameendt, s.linkdt, s.linkenddt, s.comnam, s.ticker, s.tsymbol, s.shrcls,
  s.shrcd, s.is_common, s.exchcd, s.exch, s.primexch, s.siccd, s.naics, s.ncusip, s.ncusip6, s.cusip, s.cusip6,
  s.linkprim, s.linktype, s.linkprim_score, s.linktype_rank, s.overlap_days, s.cusip6_match, p.primary_permno,
  s.permno = p.primary_permno AS is_primary_permno
FROM segments s LEFT JOIN primary_by_firm p ON s.gvkey = p.gvkey
"""

_LOADED = f"""
SELECT * REPLACE ({_norm('ncusip6')} AS ncusip6, {_norm('ncusip')} AS ncusip, {_norm('cusip')} AS cusip,
  {_norm('ticker')} AS ticker, COALESCE(linkenddt, {_FAR}) AS linkenddt, COALESCE(is_primary_permno, FALSE) AS is_primary_permno),
  substr({_norm('cusip')}, 1, 6) AS cusip6_link
FROM master
"""

_WINDOW = "make_date(CAST(p.year AS INTEGER), 1, 1) AS valid_from, make_date(CAST(p.year AS INTEGER) + 1, 1, 1) AS valid_to"

_PROVIDER_A = f"""
SELECT p.orgpermid, p.year, p.cusip, p.isin, {_NULL_TEXT} AS sedol, p.ticker, p.comname, {_isin6('p.isin')} AS cusip6_from_isin,
  substr(p.cusip, 1, 6) AS cusip6_from_cusip, {_WINDOW}
FROM (SELECT {_norm_token('orgpermid')} AS orgpermid, year, {_norm_token('cusip')} AS cusip, {_norm_token('isin')} AS isin,
  {_norm_token('ticker')} AS ticker, {_norm_token('comname')} AS comname FROM provider_a) p
"""

_PROVIDER_B_YEAR = """
WITH tries AS (
  SELECT *, year(TRY_CAST(TRY_STRPTIME(as_of_date, '%Y%m%d') AS DATE)) AS y1,
    year(TRY_CAST(TRY_STRPTIME(as_of_date, '%Y-%m-%d') AS DATE)) AS y2,
    year(TRY_CAST(TRY_STRPTIME(as_of_date, '%m/%d/%Y') AS DATE)) AS y3 FROM provider_b),
per_file AS (SELECT file_name, count(y1) AS n1, count(y2) AS n2, count(y3) AS n3 FROM tries GROUP BY file_name)
SELECT t.* EXCLUDE (y1, y2, y3), CAST(CASE WHEN n1 > 0 THEN y1 WHEN n2 > 0 THEN y2 WHEN n3 > 0 THEN y3
  ELSE CAST(regexp_extract(file_name, '(19|20)[0-9][0-9]') AS INTEGER) END AS INTEGER) AS year
FROM tries t JOIN per_file USING (file_name)
"""


def _provider_b(source: str, order: str) -> str:
    return f"""
SELECT p.issuer_id, p.year, p.company_name, {_NULL_TEXT} AS ticker, p.cusip, p.isin, {_NULL_TEXT} AS sedol,
  {_isin6('p.isin')} AS cusip6_from_isin, substr(p.cusip, 1, 6) AS cusip6_from_cusip, {_WINDOW}
FROM (SELECT {_norm_token('issuerid')} AS issuer_id, year, {_norm_token('issuer_name')} AS company_name,
    {_norm_token('issuer_cusip')} AS cusip, {_norm_token('issuer_isin')} AS isin
  FROM {source} b WHERE b.year IS NOT NULL AND issuerid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY issuerid, b.year ORDER BY {order}) = 1) p
"""


_PROVIDER_C = f"""
SELECT p.*, NULLIF(regexp_replace(symbol, '\\.[A-Z]+$', ''), '') AS clean_symbol,
  {_isin6('p.isin')} AS cusip6_from_isin, {_WINDOW}
FROM (SELECT {_norm('symbol')} AS symbol, year, {_norm('isin')} AS isin, environmental, social,
    CAST(NULL AS DOUBLE) AS governance, CAST(NULL AS DOUBLE) AS esg, CAST(NULL AS DATE) AS period_end
  FROM provider_c c
  QUALIFY row_number() OVER (PARTITION BY {_norm('symbol')}, c.year ORDER BY src_id) = 1) p
"""


def _segment_score(overlap: str = "overlap_days") -> str:
    return (
        f"{_BOOL.format('is_common')} * 3 + {_BOOL.format('is_primary_permno')} * 2 "
        f"+ CASE WHEN exchcd IN (1, 3) THEN 1 ELSE 0 END + least(3, {overlap} // 365) "
        "+ COALESCE(linkprim_score, 0) + COALESCE(linktype_rank, 0)"
    )


_MATCH_ORDER = (
    "match_score DESC, overlap_days DESC, is_primary_permno DESC, is_common DESC, exchcd NULLS LAST, namedt, permno, "
    "nameendt, ncusip6 NULLS LAST, ticker_master NULLS LAST"
)


def _match(provider: str, entity: str, passes, columns: str, master: str = "loaded", ticker: str = "ticker_master") -> str:
    tries = " UNION ALL ".join(
        f"SELECT p.*, {i} AS pass_no, '{label}' AS match_src, {points} AS points, '{kind}' AS kind, p.{key} AS k FROM {provider} p"
        for i, (label, points, kind, key) in enumerate(passes)
    )
    joined = " UNION ALL ".join(
        f"""SELECT t.*, m.permno, m.gvkey, m.primary_permno, m.is_primary_permno, m.is_common, m.exchcd, m.namedt,
  m.nameendt, m.ncusip6, m.ticker AS ticker_master, m.linkprim_score, m.linktype_rank,
  CAST({_overlap('t.valid_from', 't.valid_to', 'm.namedt', 'm.nameendt')} AS INTEGER) AS overlap_days
FROM tries t JOIN {master} m ON t.kind = '{kind}' AND t.k = m.{column}"""
        for kind, column in (("C", "ncusip6"), ("T", "ticker"))
    )
    return f"""
WITH tries AS ({tries}), joined AS ({joined}),
scored AS (SELECT *, CAST(points + {_segment_score()} AS INTEGER) AS match_score FROM joined WHERE overlap_days > 0)
SELECT {entity}, "year", match_src, match_score, overlap_days, permno, gvkey, primary_permno, is_primary_permno, is_common,
  exchcd, {columns}, namedt, nameendt, ncusip6, ticker_master AS {ticker}
FROM scored QUALIFY row_number() OVER (PARTITION BY {entity}, "year" ORDER BY pass_no, {_MATCH_ORDER}) = 1
"""


_CUSIP_PASS = ("CUSIP6", 5, "C", "cusip6_from_cusip")
_AB_PASSES = (_CUSIP_PASS, ("ISIN_CUSIP6", 4, "C", "cusip6_from_isin"))
_C_TICKER = ("TICKER", 3, "T", "clean_symbol")
_C_PASSES = (("ISIN", 6, "C", "cusip6_from_isin"), _C_TICKER)
_A_COLUMNS = "comname, ticker, cusip, isin, sedol"
_B_COLUMNS = "company_name, ticker, cusip, isin, sedol"
_C_COLUMNS = "clean_symbol, isin, environmental, social, governance, esg"
_FILTERED = "SELECT * FROM loaded WHERE ncusip6 IN (SELECT cusip6_from_isin FROM clean_c WHERE cusip6_from_isin IS NOT NULL)"


def _firms(matches: str, entity: str) -> str:
    return f"""
WITH per_firm AS (SELECT {entity}, gvkey, CAST(sum(match_score) AS BIGINT) AS total_score, count(DISTINCT "year") AS years_covered,
    max(overlap_days) AS max_overlap_days, min(namedt) AS first_seen, max(nameendt) AS last_seen
  FROM {matches} WHERE gvkey IS NOT NULL GROUP BY {entity}, gvkey),
modal AS (SELECT {entity}, gvkey, permno FROM
    (SELECT {entity}, gvkey, permno, count(*) AS n, min("year") AS y FROM {matches} WHERE gvkey IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {entity}, gvkey ORDER BY n DESC, y, permno) = 1)
SELECT {entity}, gvkey, total_score, years_covered, max_overlap_days, permno AS primary_permno, first_seen, last_seen
FROM per_firm JOIN modal USING ({entity}, gvkey)
"""


def _crosswalk(firms: str, entity: str) -> str:
    return f"""
SELECT * FROM {firms} QUALIFY row_number() OVER (PARTITION BY {entity}
  ORDER BY total_score DESC, years_covered DESC, max_overlap_days DESC, gvkey) = 1
"""


_CONSOLIDATED = " UNION ALL ".join(
    f"SELECT 'provider_{x}' AS provider, {entity} AS entity_id, gvkey, primary_permno, years_covered, first_seen, last_seen "
    f"FROM crosswalk_{x}"
    for x, entity in (("a", "orgpermid"), ("b", "issuer_id"), ("c", "symbol"))
)

_CONSTITUENTS = f"""
SELECT date, {_token('ric')} AS ric, {_token('isin')} AS isin, {_token('cusip')} AS cusip, {_token('ticker')} AS ticker, row_id,
  substr({_norm_token('cusip')}, 1, 6) AS cusip6, {_norm_token('ticker')} AS ticker_key
FROM constituents WHERE date IS NOT NULL
"""

_SNAPSHOTS = """
SELECT *, last_day(date) AS snapshot_date FROM members
QUALIFY date = max(date) OVER (PARTITION BY last_day(date))
"""

_PERMNO_SCORE = (
    f"({_BOOL.format('is_primary_permno')} * 10000 + {_BOOL.format('is_common')} * 1000 + cusip6_match * 100 "
    "+ linkprim_score * 10 + linktype_rank * 5) + overlap_days / 365.0::DOUBLE"
)
_GVKEY_SCORE = "(linkprim_score * 100 + linktype_rank * 10) + overlap_days / 365.0::DOUBLE"

_VALID = (
    "m.namedt <= s.snapshot_date AND m.nameendt > s.snapshot_date AND m.linkdt <= s.snapshot_date AND m.linkenddt > s.snapshot_date"
)
_CANDIDATE = """SELECT s.row_id, {0} AS pass_no, m.gvkey, m.permno, m.ticker, m.comnam, m.is_primary_permno, m.is_common, m.exch,
  m.linkprim, m.linktype, m.namedt, m.nameendt, m.cusip6_match, m.linkprim_score, m.linktype_rank, m.overlap_days
FROM snaps s JOIN loaded m ON """
_PANEL_BEST = f"""
WITH candidates AS (
  {_CANDIDATE.format(1)} s.cusip6 = m.ncusip6 AND {_VALID}
  UNION ALL
  {_CANDIDATE.format(1)} s.cusip6 = m.cusip6_link AND m.ncusip6 IS DISTINCT FROM m.cusip6_link AND {_VALID}
  UNION ALL
  {_CANDIDATE.format(2)} s.ticker_key = m.ticker AND {_VALID}),
counted AS (SELECT *, count(*) OVER w AS n_candidates, count(DISTINCT COALESCE(gvkey, '')) OVER w > 1 AS several,
    min((permno, namedt)) OVER (PARTITION BY row_id, pass_no, gvkey) AS firm_seen FROM candidates
  WINDOW w AS (PARTITION BY row_id, pass_no)),
ranked AS (SELECT *, CASE WHEN several THEN {_GVKEY_SCORE} ELSE {_PERMNO_SCORE} END AS score FROM counted),
best AS (SELECT *, CASE WHEN n_candidates = 1 THEN 0.0::DOUBLE ELSE score END AS rank_score FROM ranked
  QUALIFY row_number() OVER (PARTITION BY row_id
    ORDER BY pass_no, gvkey IS NULL, score DESC, firm_seen, permno, namedt, nameendt) = 1)
SELECT s.row_id, s.snapshot_date AS date, s.ticker AS ticker_sp500, s.cusip AS cusip_sp500, b.gvkey, b.permno,
  CASE WHEN b.row_id IS NULL THEN '' ELSE b.ticker END AS ticker_crsp,
  CASE WHEN b.row_id IS NULL THEN '' ELSE b.comnam END AS company_name,
  CASE WHEN b.row_id IS NULL THEN 'UNMATCHED' WHEN b.pass_no = 1 THEN 'CUSIP6' ELSE 'TICKER' END AS match_type,
  CASE WHEN b.row_id IS NULL THEN 'NO_MATCH' WHEN b.is_primary_permno THEN 'PRIMARY' ELSE 'SECONDARY' END AS permno_type,
  COALESCE(b.is_primary_permno, FALSE) AS is_primary, COALESCE(b.is_common, FALSE) AS is_common,
  CASE WHEN b.row_id IS NULL THEN '' ELSE b.exch END AS exchange,
  CASE WHEN b.row_id IS NULL THEN '' ELSE b.linkprim END AS linkprim,
  CASE WHEN b.row_id IS NULL THEN '' ELSE b.linktype END AS linktype,
  round(COALESCE(b.rank_score, 0.0::DOUBLE), 6) AS rank_score, COALESCE(b.n_candidates, 0) AS n_candidates
FROM snaps s LEFT JOIN best b USING (row_id)
"""

_DEDUP_KEYS = "date, gvkey, CASE WHEN gvkey IS NULL THEN row_id END"


def _panel(keys: str) -> str:
    return f"""
SELECT * EXCLUDE (row_id, n_candidates), CAST(year(date) AS INTEGER) AS "year", CAST(month(date) AS INTEGER) AS "month",
  strftime(date, '%Y-%m') AS year_month, CAST(year(date) - 1 AS INTEGER) AS esg_knowledge_year
FROM panel_best QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY rank_score DESC, row_id) = 1
"""


_ALL_MATCHES = " UNION ALL ".join(
    f"""SELECT 'provider_{x}' AS provider, {e} AS entity_id, "year", match_src, gvkey FROM matches_{x}"""
    for x, e in (("a", "orgpermid"), ("b", "issuer_id"), ("c", "symbol"))
)

_KEYED = """
SELECT 'C' AS key_kind, ncusip6 AS key, * FROM loaded UNION ALL
SELECT 'C', cusip6_link, * FROM loaded WHERE ncusip6 IS DISTINCT FROM cusip6_link UNION ALL
SELECT 'T', ticker, * FROM loaded
"""
_KEY_SEGMENTS = f"""
SELECT *, greatest(namedt, linkdt) AS valid_from, least(nameendt, linkenddt) AS valid_to, {_GVKEY_SCORE} AS gvkey_score,
  {_PERMNO_SCORE} AS permno_score
FROM keyed WHERE linkdt IS NOT NULL AND key <> '' AND greatest(namedt, linkdt) < least(nameendt, linkenddt)
"""
_FIRM_TIMELINE = """
WITH days AS (SELECT DISTINCT key_kind, key, gvkey, unnest([valid_from, valid_to]) AS from_date FROM key_segments),
spans AS (SELECT *, lead(from_date) OVER (PARTITION BY key_kind, key, gvkey ORDER BY from_date) AS until_date FROM days)
SELECT s.key_kind, s.key, s.gvkey, s.from_date, s.until_date, count(*) AS n,
  arg_min(m.permno, (-m.gvkey_score, m.permno, m.namedt, m.nameendt)) AS firm_permno,
  arg_min(m.permno, (-m.permno_score, m.permno, m.namedt, m.nameendt)) AS security_permno
FROM spans s JOIN key_segments m ON s.key_kind = m.key_kind AND s.key = m.key AND s.gvkey IS NOT DISTINCT FROM m.gvkey
  AND m.valid_from <= s.from_date AND s.from_date < m.valid_to
GROUP BY ALL
"""
_WINNERS = """
WITH needs AS (SELECT DISTINCT 'C' AS key_kind, cusip6 AS key, snapshot_date FROM snaps WHERE cusip6 IS NOT NULL
  UNION SELECT DISTINCT 'T', ticker_key, snapshot_date FROM snaps WHERE ticker_key IS NOT NULL),
found AS (SELECT n.snapshot_date, m.*, count(*) OVER w AS n_candidates, count(DISTINCT COALESCE(gvkey, '')) OVER w AS n_firms,
    min((permno, namedt)) OVER (PARTITION BY n.key_kind, n.key, n.snapshot_date, gvkey) AS firm_seen
  FROM needs n JOIN key_segments m ON n.key_kind = m.key_kind AND n.key = m.key
    AND m.valid_from <= n.snapshot_date AND n.snapshot_date < m.valid_to
  WINDOW w AS (PARTITION BY n.key_kind, n.key, n.snapshot_date)),
scored AS (SELECT *, CASE WHEN n_firms > 1 THEN gvkey_score ELSE permno_score END AS score FROM found)
SELECT key_kind, key, snapshot_date, n_candidates, n_firms, gvkey, permno,
  CASE WHEN n_candidates = 1 THEN 0.0::DOUBLE ELSE round(score, 6) END AS rank_score
FROM scored QUALIFY row_number() OVER (PARTITION BY key_kind, key, snapshot_date
  ORDER BY gvkey IS NULL, score DESC, firm_seen, permno, namedt, nameendt) = 1
"""

CTES: dict[str, str] = {
    **{name: sql.format(orders="orders") for name, sql in TABLES.items()},
    "names_typed": _NAMES_TYPED,
    "names_raw_typed": _NAMES_RAW_TYPED,
    "links_typed": _LINKS_TYPED,
    "pairs": _pairs("names_typed"),
    "pairs_raw": _pairs("names_raw_typed"),
    "segments": _SEGMENTS,
    "pair_stats": _PAIR_STATS,
    "pairs_with_degree": _DEGREES,
    "primary_by_firm": _PRIMARY,
    "master": _MASTER,
    "loaded": _LOADED,
    "clean_a": _PROVIDER_A,
    "provider_b_year": _PROVIDER_B_YEAR,
    "clean_b": _provider_b("provider_b_year", "file_name, src_id"),
    "clean_c": _PROVIDER_C,
    "filtered": _FILTERED,
    "matches_a": _match("clean_a", "orgpermid", _AB_PASSES, _A_COLUMNS),
    "matches_b": _match("clean_b", "issuer_id", _AB_PASSES, _B_COLUMNS),
    "matches_c": _match("clean_c", "symbol", _C_PASSES, _C_COLUMNS, "filtered", "ticker"),
    "firms_a": _firms("matches_a", "orgpermid"),
    "firms_b": _firms("matches_b", "issuer_id"),
    "firms_c": _firms("matches_c", "symbol"),
    "crosswalk_a": _crosswalk("firms_a", "orgpermid"),
    "crosswalk_b": _crosswalk("firms_b", "issuer_id"),
    "crosswalk_c": _crosswalk("firms_c", "symbol"),
    "consolidated": _CONSOLIDATED,
    "members": _CONSTITUENTS,
    "snaps": _SNAPSHOTS,
    "keyed": _KEYED,
    "key_segments": _KEY_SEGMENTS,
    "panel_best": _PANEL_BEST,
    "panel": _panel(_DEDUP_KEYS),
    "all_matches": _ALL_MATCHES,
}


def with_ctes(final: str) -> str:
    """Prefix `final` with the shared subqueries it uses, directly or not, in order."""
    import re

    def uses(sql: str) -> set[str]:
        return {n for n in CTES if re.search(rf"(FROM|JOIN)\s+{n}\b", sql)}

    needed: set[str] = set()
    todo = uses(final)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= uses(CTES[name]) - needed - {name}
    if final.lstrip().startswith("WITH"):
        final = f"SELECT * FROM ({final.strip()})"
    parts = [f"{n} AS ({CTES[n].strip()})" for n in CTES if n in needed]
    return f"WITH {', '.join(parts)}\n{final.strip()}" if parts else final.strip()


# ---- one statement per query -----------------------------------------------------------

_SEG = "permno, namedt, nameendt"
_LINKED = (
    f"{_SEG}, ncusip6, gvkey, linkdt, linkenddt, linkprim, linktype, linkprim_score, linktype_rank, overlap_days, cusip6_match"
)
_FOUND = "row_id, date, match_type, n_candidates, gvkey, permno, permno_type, rank_score"
_ISO = r"'^\d{4}-\d{2}-\d{2}$'"
_DATE = """CASE WHEN d <= DATE '2262-04-11' THEN d END"""
_SHARE = "round(count({0}) / count(*)::DOUBLE, 6)"


def _present(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present, {_SHARE.format(c)} AS share FROM {table}"
        for c in columns
    )


def _counts(table: str, column: str, category: str) -> str:
    return f"SELECT {column} AS value, count(*) AS n, '{category}' AS category FROM {table} GROUP BY {column}"


def _type_check(column: str, kind: str, bad: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS expected_type, count({_token(column)}) AS n_present, "
        f"count(*) FILTER ({_token(column)} IS NOT NULL AND {bad}) AS n_bad FROM names_raw"
    )


def _bad_int(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS BIGINT) IS NULL"


_PAIRWISE = " UNION ALL ".join(
    f"""SELECT 'provider_{a}' AS provider_1, 'provider_{b}' AS provider_2, count(*) AS n_shared
FROM (SELECT gvkey FROM matches_{a} WHERE gvkey IS NOT NULL INTERSECT SELECT gvkey FROM matches_{b})"""
    for a, b in (("a", "b"), ("a", "c"), ("b", "c"))
)

_FINAL: dict[str, str] = {
    "pipeline_one_fails": """SELECT provider, count(*) AS n_entities, count(DISTINCT gvkey) AS n_firms, FALSE AS failed
FROM consolidated WHERE provider <> 'provider_a' GROUP BY provider
UNION ALL SELECT 'provider_a', 0, 0, TRUE""",
    "scan_ragged": """SELECT orgpermid, year, CASE WHEN CAST(orgpermid AS BIGINT) % 11 <> 0 THEN comname END AS comname
FROM provider_a WHERE CAST(orgpermid AS BIGINT) % 7 <> 0""",
    "scan_quarantine": """SELECT 'surplus' AS reason, 4 AS fields, orgpermid || ',' || year || ',"' || comname || '",extra' AS line
FROM provider_a WHERE CAST(orgpermid AS BIGINT) % 7 = 0""",
    "scan_csv_lower": "SELECT * FROM names_raw_typed",
    "scan_pruned": "SELECT CAST(permno AS VARCHAR) AS permno, ncusip, ticker FROM names",
    "scan_encoding": "SELECT orgpermid, year, 'Société ' || comname AS comname FROM provider_a",
    "scan_quoted": """SELECT orgpermid, year, '"A", ' || comname || chr(10) || '""b' AS comname FROM provider_a""",
    "scan_cp1252": "SELECT orgpermid, year, 'Société €“ ' || comname AS comname FROM provider_a",
    "scan_multifile": "SELECT * FROM clean_b",
    "scan_parquet": "SELECT symbol, year, environmental, src_id FROM provider_c",
    "scan_constituents": "SELECT * FROM members",
    "load_master": f"SELECT {_SEG}, gvkey, primary_permno, is_primary_permno, is_common, shrcd, exchcd, ncusip, ncusip6, ticker, "
    "linkprim_score, linktype_rank FROM loaded",
    "load_master_panel": f"SELECT {_SEG}, gvkey, linkdt, linkenddt, is_primary_permno, is_common, linkprim_score, linktype_rank, "
    "overlap_days, cusip6_match, ticker, ncusip6, cusip6_link FROM loaded",
    "is_common_fallback": f"SELECT {_SEG}, shrcd, COALESCE(shrcd IN (10, 11, 12), FALSE) AS is_common, is_primary_permno, ncusip6 "
    "FROM loaded",
    "sink_master": "SELECT * FROM master",
    "sink_matches": "SELECT * FROM all_matches",
    "sink_format": """SELECT date, ric, ticker, fmt FROM (SELECT date, ric, upper(regexp_extract(ric, '^([^.]+)', 1)) AS ticker
  FROM members QUALIFY row_number() OVER (PARTITION BY date, ric ORDER BY row_id) = 1), (VALUES ('parquet'), ('csv')) f(fmt)""",
    "sink_panel": "SELECT * FROM panel",
    "master_cached": "SELECT * FROM master",
    "norm_string": f"SELECT row_id, {_norm('ticker_text')} AS ticker FROM odd_values",
    "norm_upper": "SELECT row_id, UPPER(ticker_text) AS ticker FROM odd_values",
    "null_tokens": f"SELECT row_id, {_token('ticker_text')} AS ticker FROM odd_values",
    "norm_gvkey": f"SELECT row_id, {_gvkey('gvkey_text')} AS gvkey FROM odd_values",
    "cusip6": "SELECT src_id, substr(ncusip, 1, 6) AS ncusip6 FROM names",
    "isin_cusip6": f"SELECT row_id, {_isin6('isin_text')} AS cusip6 FROM odd_values",
    "clean_symbol": "SELECT row_id, regexp_replace(symbol_text, '\\.[A-Z]+$', '') AS symbol FROM odd_values",
    "ric_ticker": "SELECT row_id, upper(NULLIF(regexp_extract(symbol_text, '^([^.]+)', 1), '')) AS ticker FROM odd_values",
    "coerce_bool": f"""SELECT row_id, COALESCE(lower({_strip('flag_text')}) IN ('1', 'true', 't', 'y', 'yes'), FALSE) AS flag,
  COALESCE(CASE WHEN custkey > 100 THEN custkey % 2 END <> 0, FALSE) AS odd_customer FROM odd_values""",
    "coerce_num": f"SELECT row_id, {_int('number_text')} AS number FROM odd_values",
    "coerce_dates": f"""SELECT row_id, {_DATE} AS start_date, COALESCE({_DATE}, {_FAR}) AS end_date FROM (
  SELECT row_id, CASE WHEN regexp_matches(date_text, {_ISO}) THEN TRY_CAST(date_text AS DATE)
    ELSE CAST(COALESCE(TRY_STRPTIME(date_text, '%Y%m%d'), TRY_STRPTIME(date_text, '%m/%d/%Y')) AS DATE) END AS d FROM odd_values)""",
    "epoch_year": "SELECT event_id, CAST(ts AS DATE) AS period_end, CAST(year(ts) AS INTEGER) AS year FROM events",
    "year_window": f"SELECT p.row_id, p.year, {_WINDOW} FROM odd_values p",
    "extract_year": "SELECT src_id, file_name, b.year FROM provider_b_year b",
    "extract_year_from_name": "SELECT src_id, file_name, CAST(regexp_extract(file_name, '(19|20)[0-9][0-9]') AS INTEGER) AS year "
    "FROM provider_b",
    "month_end": "SELECT row_id, last_day(day) AS month_end FROM odd_values",
    "overlap_days": f"""SELECT src_id, CASE WHEN nameendt IS NOT NULL THEN CAST({_overlap('make_date(year(namedt), 1, 1)',
  'make_date(year(namedt) + 1, 1, 1)', 'namedt', 'nameendt')} AS INTEGER) END AS overlap_days FROM names""",
    "overlap_builder": f"""SELECT src_id, CASE WHEN nameendt >= make_date(year(namedt), 1, 1)
  THEN CAST({_overlap('namedt', 'nameendt', 'make_date(year(namedt), 1, 1)', 'make_date(year(namedt) + 1, 1, 1)')} AS INTEGER)
  ELSE 0 END AS overlap_days FROM names""",
    "cusip6_match": f"""SELECT orgpermid, p.year, CASE WHEN substr(cusip, 1, 6) = {_isin6('isin')} THEN 1 ELSE 0 END AS cusip6_match
FROM provider_a p""",
    "flags_labels": """SELECT src_id, shrcd, COALESCE(shrcd IN (10, 11), FALSE) AS is_common, exchcd,
  CASE exchcd WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' END AS exch FROM names""",
    "primary_flag": f"SELECT {_SEG}, primary_permno, is_primary_permno FROM master",
    "match_score": f"""SELECT {_SEG}, s + 5 AS score_cusip6, s + 4 AS score_isin_cusip6, s + 6 AS score_isin, s + 3 AS score_ticker
FROM (SELECT {_SEG}, CAST({_segment_score()} AS INTEGER) AS s FROM loaded)""",
    "rank_score_permno": f"SELECT {_SEG}, round({_PERMNO_SCORE}, 6) AS rank_score FROM loaded",
    "rank_score_gvkey": f"SELECT {_SEG}, round({_GVKEY_SCORE}, 6) AS rank_score FROM loaded",
    "names_clean": "SELECT * FROM names_raw_typed",
    "links_clean": "SELECT * FROM links_typed",
    "provider_a_clean": "SELECT * FROM clean_a",
    "provider_b_clean": "SELECT * FROM clean_b",
    "provider_c_clean": "SELECT * FROM clean_c",
    "drop_null_keys": "SELECT * FROM members WHERE cusip IS NOT NULL AND ticker IS NOT NULL",
    "semi_filter": f"SELECT {_SEG}, ncusip6, ticker FROM filtered",
    "semi_filter_ticker": f"""SELECT {_SEG}, ncusip6, ticker FROM loaded WHERE ticker IN (SELECT ticker FROM clean_a)
  OR ncusip6 IN (SELECT cusip6_from_cusip FROM clean_a UNION SELECT cusip6_from_isin FROM clean_a)""",
    "date_filter": f"""SELECT {_SEG} FROM loaded WHERE namedt < (SELECT make_date(max(a.year) + 1, 1, 1) FROM clean_a a)
  AND nameendt >= (SELECT make_date(min(a.year), 1, 1) FROM clean_a a)""",
    "dedup_entity_year": "SELECT symbol, c.year, isin, environmental, social FROM clean_c c",
    "segment_links": f"""SELECT {_LINKED} FROM pairs WHERE linkdt IS NOT NULL QUALIFY row_number() OVER
  (PARTITION BY {_SEG}, linkprim_score, linktype_rank ORDER BY {_LINK_RANK}, {_NAME_ORDER}) = 1""",
    "best_link": f"""SELECT {_LINKED}, src_id, copy_no FROM pairs_raw WHERE linkdt IS NOT NULL QUALIFY row_number() OVER
  (PARTITION BY {_SEG} ORDER BY {_LINK_RANK}, copy_no, src_id) = 1""",
    "unmatched_segments": f"""SELECT {_SEG}, gvkey, overlap_days, cusip6_match, linkprim_score, linktype_rank FROM segments
WHERE linkdt IS NULL""",
    "dedup_segments": f"""SELECT * FROM names_raw_typed
QUALIFY row_number() OVER (PARTITION BY {_SEG} ORDER BY copy_no, src_id) = 1""",
    "security_master": "SELECT * FROM master",
    "one_to_one": "SELECT gvkey, permno FROM pairs_with_degree WHERE one2one",
    "pair_stats": "SELECT * FROM pairs_with_degree",
    "primary_permno": "SELECT * FROM primary_by_firm",
    "primary_table": "SELECT DISTINCT gvkey, primary_permno FROM master WHERE gvkey IS NOT NULL",
    "check_types": " UNION ALL ".join(
        [
            _type_check("permno", "bigint", _bad_int("permno")),
            _type_check("permco", "bigint", _bad_int("permco")),
            _type_check("namedt", "date", "TRY_CAST(namedt AS DATE) IS NULL"),
            _type_check("nameendt", "date", "TRY_CAST(nameendt AS DATE) IS NULL"),
            _type_check("comnam", "string", "FALSE"),
            _type_check("ticker", "string", "FALSE"),
            _type_check("ncusip", "string", "FALSE"),
            _type_check("shrcd", "int", _bad_int("shrcd")),
            _type_check("exchcd", "int", _bad_int("exchcd")),
        ]
    ),
    "check_spans": """SELECT count(*) FILTER (nameendt < namedt) AS n_bad_segments,
  count(*) FILTER (gvkey IS NOT NULL AND linkenddt < linkdt) AS n_bad_links FROM master""",
    "check_primary": """SELECT count(*) FILTER (n = 1) AS n_one, count(*) FILTER (n = 0) AS n_zero, count(*) FILTER (n > 1) AS n_many
FROM (SELECT gvkey, count(DISTINCT CASE WHEN is_primary_permno THEN permno END) AS n FROM master WHERE gvkey IS NOT NULL GROUP BY gvkey)""",
    "match_cusip6": _match("clean_a", "orgpermid", (_CUSIP_PASS,), _A_COLUMNS),
    "match_ticker": _match("clean_c", "symbol", (_C_TICKER,), _C_COLUMNS, ticker="ticker"),
    "anti_matched": f"""SELECT orgpermid, a.year, cusip6_from_isin FROM clean_a a WHERE true
  AND NOT EXISTS (SELECT 1 FROM loaded m WHERE m.ncusip6 = a.cusip6_from_cusip
    AND {_overlap('a.valid_from', 'a.valid_to', 'm.namedt', 'm.nameendt')} > 0)""",
    "best_match": f"""
WITH years AS (SELECT unnest(generate_series(min(a.year), max(a.year))) AS y FROM clean_a a),
keyed AS (SELECT 'C' AS key_kind, ncusip6 AS key, * FROM loaded UNION ALL SELECT 'T', ticker, * FROM loaded),
yearly AS (SELECT k.*  REPLACE (CAST({_overlap('make_date(CAST(y AS INTEGER), 1, 1)', 'make_date(CAST(y AS INTEGER) + 1, 1, 1)', 'namedt', 'nameendt')} AS INTEGER)
    AS overlap_days), ticker AS ticker_master, CAST(y AS INTEGER) AS "year" FROM keyed k, years
  WHERE key IS NOT NULL AND namedt < make_date(CAST(y AS INTEGER) + 1, 1, 1) AND nameendt > make_date(CAST(y AS INTEGER), 1, 1)),
scored AS (SELECT *, CAST({_segment_score()} AS INTEGER) AS match_score FROM yearly WHERE overlap_days > 0)
SELECT key_kind, key, "year", permno, namedt, nameendt, gvkey, overlap_days, match_score AS segment_score FROM scored
QUALIFY row_number() OVER (PARTITION BY key_kind, key, "year" ORDER BY {_MATCH_ORDER}) = 1""",
    "match_provider_a": "SELECT * FROM matches_a",
    "match_provider_b": "SELECT * FROM matches_b",
    "match_provider_c": "SELECT * FROM matches_c",
    "match_provider_c_unfiltered": _match("clean_c", "symbol", _C_PASSES, _C_COLUMNS, ticker="ticker"),
    "crosswalk_agg": "SELECT * EXCLUDE (primary_permno) FROM firms_a",
    "modal_permno": "SELECT symbol, gvkey, primary_permno AS modal_permno FROM firms_c",
    "crosswalk_a": "SELECT * FROM crosswalk_a",
    "crosswalk_b": "SELECT * FROM crosswalk_b",
    "crosswalk_c": "SELECT * FROM crosswalk_c",
    "consolidated_crosswalk": "SELECT * FROM consolidated",
    "month_snapshots": "SELECT * FROM snaps",
    "dedup_date_ric": """SELECT * REPLACE (upper(regexp_extract(ric, '^([^.]+)', 1)) AS ticker) FROM members
QUALIFY row_number() OVER (PARTITION BY date, ric ORDER BY row_id) = 1""",
    "interval_pairs": f"""SELECT {_SEG}, ncusip, gvkey, linkdt, linkenddt, cusip, linkprim, linktype
FROM pairs WHERE linkdt IS NOT NULL""",
    "winner_envelope": _WINNERS,
    "firm_timeline": _FIRM_TIMELINE,
    "asof_cusip6": f"SELECT {_FOUND} FROM panel_best WHERE match_type = 'CUSIP6'",
    "asof_ticker": f"SELECT {_FOUND} FROM panel_best WHERE match_type = 'TICKER'",
    "panel_best": f"SELECT {_FOUND} FROM panel_best",
    "panel_dedup": f"""SELECT {_FOUND} FROM panel_best
QUALIFY row_number() OVER (PARTITION BY {_DEDUP_KEYS} ORDER BY rank_score DESC, row_id) = 1""",
    "monthly_panel": "SELECT * FROM panel",
    "monthly_panel_collapsed": _panel("date, gvkey"),
    "ml_grid": """SELECT gvkey, permno, ticker_crsp, company_name, p.year AS constituency_year, p.year AS formation_year,
  p.year + 1 AS prediction_year, date AS formation_date, p.year - 1 AS esg_baseline_year, p.year AS esg_outcome_year,
  esg_knowledge_year, match_type, permno_type, is_primary, is_common, exchange, linkprim, linktype FROM panel p WHERE p.month = 12""",
    "panel_unmatched": "SELECT DISTINCT date, ticker_sp500, cusip_sp500 FROM panel WHERE match_type = 'UNMATCHED'",
    "panel_audit": """SELECT date, gvkey, permno, match_type, permno_type, is_primary, linkprim, linktype FROM panel
ORDER BY date, gvkey NULLS LAST, cusip_sp500 NULLS LAST, ticker_sp500 NULLS LAST, match_type LIMIT 100""",
    "check_panel_dups": """SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS n_duplicate_rows
FROM (SELECT count(*) AS n FROM panel GROUP BY date, gvkey HAVING count(*) > 1)""",
    "panel_coverage": """SELECT p.year, count(DISTINCT gvkey) AS n_gvkeys, count(DISTINCT permno) AS n_permnos, count(*) AS n_rows
FROM panel p GROUP BY p.year ORDER BY p.year DESC LIMIT 10""",
    "panel_match_rate": f"""SELECT count(*) AS n_rows, count(DISTINCT gvkey) AS n_gvkeys, count(DISTINCT permno) AS n_permnos,
  min(date) AS first_date, max(date) AS last_date, {_SHARE.format('gvkey')} AS gvkey_rate, {_SHARE.format('permno')} AS permno_rate FROM panel""",
    "match_summary": """SELECT (SELECT count(*) FROM clean_a) AS n_input, count(*) AS n_matched,
  round(count(*) / (SELECT count(*) FROM clean_a)::DOUBLE, 6) AS match_rate, count(DISTINCT orgpermid) AS n_entities,
  count(DISTINCT gvkey) AS n_gvkeys, min(m.year) AS min_year, max(m.year) AS max_year FROM matches_a m""",
    "value_counts": " UNION ALL ".join(
        [
            _counts("matches_a", "match_src", "match_src_a"),
            _counts("matches_c", "match_src", "match_src_c"),
            _counts("panel", "match_type", "match_type"),
            _counts("panel", "permno_type", "permno_type"),
        ]
    ),
    "availability": _present("clean_a", ["cusip", "isin", "sedol", "ticker"]),
    "score_availability": _present("matches_c", ["environmental", "social", "governance", "esg"]),
    "matches_by_year": "SELECT m.year, count(*) AS n_matches FROM matches_c m GROUP BY m.year",
    "monthly_counts": "SELECT last_day(date) AS month_end, count(DISTINCT ric) AS n_members FROM members GROUP BY 1",
    "monthly_count_summary": """SELECT min(n) AS min_members, max(n) AS max_members, round(avg(n), 6) AS avg_members, count(*) AS n_months
FROM (SELECT count(DISTINCT ric) AS n FROM members GROUP BY last_day(date))""",
    "id_coverage": f"SELECT count(*) AS n_rows, {_SHARE.format('isin')} AS isin_rate, {_SHARE.format('cusip')} AS cusip_rate FROM members",
    "universe_coverage": """SELECT f.provider, p.year, count(*) AS n_members, count(a.gvkey) AS n_covered,
  round(count(a.gvkey) / count(*)::DOUBLE, 6) AS coverage
FROM panel p CROSS JOIN (VALUES ('provider_a'), ('provider_b'), ('provider_c')) f(provider)
LEFT JOIN (SELECT DISTINCT m.provider, m.gvkey, m.year FROM all_matches m WHERE gvkey IS NOT NULL) a
  ON a.provider = f.provider AND a.gvkey = p.gvkey AND a.year = p.year GROUP BY f.provider, p.year""",
    "top_gvkeys": """SELECT gvkey, count(*) AS n_mappings FROM consolidated WHERE gvkey IS NOT NULL GROUP BY gvkey
ORDER BY n_mappings DESC, gvkey LIMIT 10""",
    "gvkey_common": """SELECT gvkey FROM matches_a WHERE gvkey IS NOT NULL INTERSECT SELECT gvkey FROM matches_b
INTERSECT SELECT gvkey FROM matches_c""",
    "gvkey_pairwise": _PAIRWISE,
    "firm_overlap_by_source": """WITH firms AS (SELECT DISTINCT CAST("year" AS VARCHAR) AS y, gvkey FROM matches_a WHERE gvkey IS NOT NULL),
years AS (SELECT DISTINCT CAST("year" AS VARCHAR) AS y FROM matches_a)
SELECT a.y AS provider_1, b.y AS provider_2, (SELECT count(*) FROM firms f JOIN firms g USING (gvkey) WHERE f.y = a.y AND g.y = b.y) AS n_shared
FROM years a JOIN years b ON a.y < b.y""",
    "gvkey_exclusive": """SELECT gvkey, min(provider) AS provider FROM all_matches WHERE gvkey IS NOT NULL
GROUP BY gvkey HAVING count(DISTINCT provider) = 1""",
    "master_summary": "SELECT count(*) AS n_segments, count(gvkey) AS n_linked, count(DISTINCT gvkey) AS n_gvkeys FROM master",
    "provider_summary": """SELECT m.provider, count(*) AS n_matches, count(DISTINCT entity_id) AS n_entities,
  count(DISTINCT gvkey) AS n_gvkeys, min(m.year) AS min_year, max(m.year) AS max_year FROM all_matches m GROUP BY m.provider""",
    "consolidated_summary": """SELECT provider, count(*) AS n_mappings, count(DISTINCT gvkey) AS n_gvkeys
FROM consolidated GROUP BY provider""",
    "constituent_summary": """SELECT count(*) AS n_rows, count(DISTINCT ric) AS n_rics, min(date) AS first_date, max(date) AS last_date
FROM members""",
    "ml_grid_summary": """SELECT count(*) AS n_rows, min(p.year) AS min_year, max(p.year) AS max_year, count(DISTINCT gvkey) AS n_gvkeys
FROM panel p WHERE p.month = 12""",
    "month_fallback": """SELECT date, ric, CASE WHEN month(date) <> 12 THEN isin END AS isin,
  CASE WHEN month(date) <> 12 THEN cusip END AS cusip, row_id FROM members""",
    "month_spine": """SELECT last_day(CAST(m AS DATE)) AS month_end FROM (SELECT unnest(generate_series(date_trunc('month', min(date)),
  date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS m, max(date) AS last FROM members) WHERE last_day(CAST(m AS DATE)) <= last""",
    "stream_snapshots": """SELECT date, ric, isin, cusip, upper(regexp_extract(ric, '^([^.]+)', 1)) AS ticker, row_id FROM members
QUALIFY row_number() OVER (PARTITION BY date, ric ORDER BY row_id) = 1""",
}

#: Queries that reach another one's rows in another way: through a sink, the whole mapping job, or other columns.
_SAME_ROWS = {
    "scan_alike_headers": "scan_constituents",
    "stream_snapshots_state": "stream_snapshots",
    "stream_compacted": "stream_snapshots",
    "epoch_year_timestamp": "epoch_year",
    "sink_primary": "primary_table",
    "sink_crosswalk": "consolidated_crosswalk",
    "sink_grid": "ml_grid",
    "sink_audit": "panel_audit",
    "sink_unmatched": "panel_unmatched",
    "pipeline_crosswalk": "consolidated_crosswalk",
    "pipeline_concurrent": "consolidated_crosswalk",
}
_FINAL |= {name: _FINAL[plain] for name, plain in _SAME_ROWS.items()}

ORACLES: dict[str, str] = {name: with_ctes(sql) for name, sql in _FINAL.items()}
