"""Run every query against its SQL on the given tables.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    return repr(value)


def _type(name: str) -> str:
    """A DuckDB type as Spark names it."""
    names = {
        "BIGINT": "bigint",
        "INTEGER": "int",
        "VARCHAR": "string",
        "DATE": "date",
        "TIMESTAMP": "timestamp_ntz",
    }
    return names.get(name, name.lower())


def _bag(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows, else a reason."""
    ours = [tuple(r) for r in df.collect()]
    con.execute(sql)
    names = [d[0] for d in con.description]
    kinds = {d[0]: _type(str(d[1])) for d in con.description}
    theirs = con.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} against {names}"
    if dict(df.dtypes) != kinds:
        return f"types {dict(df.dtypes)} against {kinds}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    a, b = _bag(df.columns, ours), _bag(names, theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} against {y}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from reviewmart.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(
        "oracle-check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if only and name not in only or name not in sqls:
            continue
        start = time.perf_counter()
        try:
            reason = compare(query(spark, sf_dir), con, sqls[name])
        except Exception as e:  # noqa: BLE001
            reason = f"{type(e).__name__}: {str(e)[:600]}"
        bad += reason is not None
        print(f"{name:28s} {time.perf_counter() - start:6.1f}s {reason or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
