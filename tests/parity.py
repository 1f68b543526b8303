"""Compare registered queries with their SQL: ``python tests/parity.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    return repr(value)


def _lines(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and all values agree exactly, else what differs first."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    want = _lines(columns, result.fetchall())
    got = _lines(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0][0][:400]} != {wrong[0][1][:400]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from riskflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "parity", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        start = time.time()
        df = entry.queries()[name](spark, sf_dir)
        if name in sql:
            found = differences(df, con, sql[name])
            verdict = "ok" if found is None else f"DIFFERS: {found}"
            bad += found is not None
        else:
            verdict = f"{df.count()} rows, no SQL"
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{bad} of {len(wanted)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
