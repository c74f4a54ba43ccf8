"""Run registered queries beside their SQL and compare the rows exactly.

    python tests/check_queries.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from polfin.catalog.standins import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} are not {sorted(names)}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only here {list(extra)[:3]}, only there {list(missing)[:3]}"
        )
    if not got:
        return "no rows on either side"
    return None


def main() -> None:
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in sorted(n for n in entry.queries() if n.startswith(prefixes)):
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{name:35s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(entry.queries())} differ")


if __name__ == "__main__":
    main()
