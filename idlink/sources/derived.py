"""Securities inputs derived from the `orders` table.

The available tables hold no securities data, so the registered queries and the tests
shape their inputs from `orders`. The SQL runs unchanged on Spark and DuckDB; `{orders}`
names the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_ISS = "(o_custkey - CASE WHEN o_custkey % 10 = 1 THEN 1 ELSE 0 END)"
_C6 = f"lpad(CAST(100000 + {_ISS} AS STRING), 6, '0')"
_C6B = f"lpad(CAST(CASE WHEN o_orderkey % 11 = 0 THEN 200000 ELSE 100000 END + {_ISS} AS STRING), 6, '0')"
_OD = "CAST(o_orderdate AS DATE)"

# A segment ends the day before the security's next order. Only the last order of a day
# looks ahead, from one row per (customer, day), so no customer's orders meet in one window.
NAMES = f"""
SELECT 10000 + o_custkey AS permno, 20000 + {_ISS} AS permco, {_OD} AS namedt,
  CASE WHEN o_orderkey < last_key THEN {_OD} - 1 ELSE next_day - 1 END AS nameendt,
  'Company ' || CAST({_ISS} AS STRING) AS comnam, 't' || CAST(o_custkey % 400 AS STRING) AS ticker,
  {_C6B} || '10' AS ncusip, 9 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS shrcd,
  CAST(1 + o_orderkey % 4 AS INT) AS exchcd, o_orderkey AS src_id
FROM {{orders}} JOIN (
  SELECT cust, day, last_key, lead(day) OVER (PARTITION BY cust ORDER BY day) AS next_day FROM (
    SELECT o_custkey AS cust, {_OD} AS day, max(o_orderkey) AS last_key FROM {{orders}} GROUP BY o_custkey, {_OD}) AS d
  ) AS e ON o_custkey = e.cust AND {_OD} = e.day
"""

NAMES_RAW = f"""
SELECT CAST(permno AS STRING) AS permno, CAST(permco AS STRING) AS permco,
  CASE WHEN src_id % 97 = 0 THEN 'bad' ELSE CAST(namedt AS STRING) END AS namedt,
  CASE WHEN nameendt IS NULL THEN 'E' ELSE CAST(nameendt AS STRING) END AS nameendt,
  comnam, CASE WHEN src_id % 89 = 0 THEN 'NA' ELSE '  ' || ticker || ' ' END AS ticker, ncusip,
  CAST(shrcd AS STRING) AS shrcd, CAST(exchcd AS STRING) AS exchcd, src_id, 0 AS copy_no
FROM ({NAMES}) AS n1
UNION ALL
SELECT CAST(permno AS STRING), CAST(permco AS STRING), CAST(namedt AS STRING),
  CASE WHEN nameendt IS NULL THEN 'E' ELSE CAST(nameendt AS STRING) END, comnam, ticker, ncusip,
  '14', CAST(exchcd AS STRING), src_id, 1
FROM ({NAMES}) AS n2 WHERE shrcd = 13
"""

# Every order is a link, more or less preferred. Those of some customers are of securities without names, whose own
# segments stay unlinked.
LINKS = f"""
SELECT 10000 + o_custkey + CASE WHEN o_custkey % 13 = 0 THEN 1000000 ELSE 0 END AS lpermno,
  CAST(1000 + {_ISS} + CASE WHEN o_orderkey % 17 = 0 THEN 5 ELSE 0 END AS STRING)
    || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END AS gvkey,
  {_OD} - 400 AS linkdt, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_OD} + 1100 END AS linkenddt,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '3-MEDIUM') THEN 'N' WHEN o_orderstatus = 'F' THEN 'P'
    WHEN o_orderstatus = 'O' THEN 'C' ELSE 'J' END AS linkprim,
  CASE o_orderkey % 4 WHEN 0 THEN 'LU' WHEN 1 THEN 'LC' ELSE 'NR' END AS linktype,
  {_C6} || '101' AS cusip, o_orderkey AS src_id FROM {{orders}}
"""

PROVIDER_A = f"""
SELECT DISTINCT CAST(4295900000 + o_custkey AS STRING) AS orgpermid, CAST(year(o_orderdate) AS INT) AS year,
  CASE WHEN o_custkey % 3 <> 0 THEN {_C6} || '103' END AS cusip,
  CASE o_custkey % 4 WHEN 0 THEN 'US' || {_C6} || '1035' WHEN 1 THEN 'GB' || {_C6} || '1035'
    WHEN 2 THEN 'CA' || {_C6} || '1035' END AS isin,
  'T' || CAST(o_custkey % 400 AS STRING) AS ticker, 'COMPANY ' || CAST({_ISS} AS STRING) AS comname FROM {{orders}}
"""

PROVIDER_B = f"""
SELECT 'IID' || lpad(CAST({_ISS} AS STRING), 9, '0') AS issuerid,
  'ESG Ratings Timeseries ' || CAST(year(o_orderdate) AS STRING) || '.csv' AS file_name,
  CASE o_orderkey % 3 WHEN 0 THEN CAST({_OD} AS STRING) END AS as_of_date,
  'Company ' || CAST({_ISS} AS STRING) AS issuer_name,
  CASE WHEN o_custkey % 4 <> 0 THEN {_C6} || '103' END AS issuer_cusip,
  CASE WHEN o_custkey % 2 = 0 THEN 'US' || {_C6} || '1035' END AS issuer_isin, o_orderkey AS src_id FROM {{orders}}
"""

PROVIDER_C = f"""
SELECT 't' || CAST(o_custkey % 400 AS STRING) || CASE WHEN o_custkey % 5 = 0 THEN '.L' ELSE '' END AS symbol,
  CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_custkey % 3 = 0 THEN 'US' || {_C6} || '1035' END AS isin,
  CAST(o_orderkey % 1000 AS DOUBLE) / 10 AS environmental,
  CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_custkey % 1000 AS DOUBLE) / 10 END AS social,
  o_orderkey AS src_id FROM {{orders}}
"""

CONSTITUENTS = f"""
SELECT {_OD} AS date, 'T' || CAST(o_custkey % 400 AS STRING) || '.N' AS ric,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Z99999103' WHEN o_orderkey % 19 = 0 THEN NULL ELSE {_C6} || '103' END AS cusip,
  CASE WHEN o_custkey % 3 <> 0 THEN 'US' || {_C6} || '1035' END AS isin,
  CASE WHEN o_orderkey % 10 <> 0 THEN 'T' || CAST(o_custkey % 400 AS STRING) END AS ticker,
  o_orderkey AS row_id FROM {{orders}}
"""

# Texts that need coercion or clean-up, several spellings of each kind.
ODD_VALUES = f"""
SELECT o_orderkey AS row_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' True ' WHEN '2-HIGH' THEN 'Y' WHEN '3-MEDIUM' THEN '1.0'
    WHEN '4-NOT SPECIFIED' THEN '1' END AS flag_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_custkey AS STRING) WHEN '2-HIGH' THEN CAST(o_custkey AS STRING) || '.0'
    WHEN '3-MEDIUM' THEN 'x' || CAST(o_custkey AS STRING) WHEN '4-NOT SPECIFIED' THEN 'N/A' ELSE ' 7 ' END AS number_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN CAST({_OD} AS STRING)
    WHEN '2-HIGH' THEN replace(CAST({_OD} AS STRING), '-', '')
    WHEN '3-MEDIUM' THEN substr(CAST({_OD} AS STRING), 6, 2) || '/' || substr(CAST({_OD} AS STRING), 9, 2) || '/'
      || substr(CAST({_OD} AS STRING), 1, 4)
    WHEN '4-NOT SPECIFIED' THEN 'E' ELSE '9999-12-31' END AS date_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || CAST(o_custkey AS STRING) || '.0' WHEN '2-HIGH' THEN 'G-' || CAST(o_custkey AS STRING)
    WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN '99' || lpad(CAST(o_custkey AS STRING), 6, '0')
    ELSE CAST(o_custkey AS STRING) END AS gvkey_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'NA' WHEN '2-HIGH' THEN ' n' || CAST(o_custkey AS STRING) || chr(9)
    WHEN '3-MEDIUM' THEN '   ' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'null' END AS ticker_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'BRK.B' WHEN '2-HIGH' THEN 'VOD' || CAST(o_custkey AS STRING) || '.L'
    WHEN '3-MEDIUM' THEN 'A.1' WHEN '4-NOT SPECIFIED' THEN '.N' ELSE 'T' || CAST(o_custkey AS STRING) END AS symbol_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'US' || {_C6} || '1035' WHEN '2-HIGH' THEN 'CA' || {_C6} || '1035'
    WHEN '3-MEDIUM' THEN 'GB' || {_C6} || '1035' WHEN '4-NOT SPECIFIED' THEN 'US' || {_C6} END AS isin_text,
  CAST(year(o_orderdate) AS INT) AS year, {_OD} AS day, o_custkey AS custkey
FROM {{orders}}
"""

TABLES = {
    "names": NAMES,
    "names_raw": NAMES_RAW,
    "links": LINKS,
    "provider_a": PROVIDER_A,
    "provider_b": PROVIDER_B,
    "provider_c": PROVIDER_C,
    "constituents": CONSTITUENTS,
    "odd_values": ODD_VALUES,
}


_schemas: dict[str, StructType] = {}  # path -> schema, so that footers are read once per table


def derive(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One derived input over the whole `orders` table."""
    path = f"{sf_dir}/orders.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.sql(TABLES[table], orders=spark.read.schema(_schemas[path]).parquet(path))
