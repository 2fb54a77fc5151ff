"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [query ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value) or value is pd.NA:
        return ""
    if isinstance(value, float):
        return repr(round(value, 6))
    return str(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in rows)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE",
}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got_columns = df.columns
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    off = {c: (types[c], kinds[c]) for c in types if types[c] != kinds[c]}
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if a != b:
        set_a, set_b = set(a), set(b)
        only_a = [r for r in a if r not in set_b][:3]
        only_b = [r for r in b if r not in set_a][:3]
        return f"rows {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}"
    if off:
        return f"types {off}"
    return None if a else "no rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from idlink.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    wanted = sys.argv[2:] or list(queries())
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
