"""Compare a query with its SQL counterpart as multisets of rows.

Run as a script to check every query, or the ones named: ``python tests/oracle_check.py``.
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    return x


def rows_of(arrow) -> tuple[list[str], dict[str, str], Counter]:
    names = sorted(arrow.schema.names)
    columns = [arrow.column(n).to_pylist() for n in names]
    rows = Counter(tuple(_value(x) for x in row) for row in zip(*columns))
    return names, {n: str(arrow.schema.field(n).type) for n in names}, rows


def compare(df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    names, types, rows = rows_of(df.toArrow())
    found = con.sql(sql).to_arrow_table()
    other_names, other_types, other = rows_of(found)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if rows != other:
        here, there = rows - other, other - rows
        return (
            f"{sum(rows.values())} vs {sum(other.values())} rows; only here {list(here)[:3]}, "
            f"only there {list(there)[:3]}; {names}"
        )
    odd = {n: (types[n], other_types[n]) for n in names if _kind(types[n]) != _kind(other_types[n])}
    return f"types {odd}" if odd else ""


def _kind(name: str) -> str:
    return name.replace("large_string", "string").split("[")[0]


def main(wanted: list[str], sf_dir: str) -> int:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry
    from tests.conftest import build_session

    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else ""
            note = "" if name in oracles else f" rows only: {df.count()}"
        except Exception:
            problem, note = traceback.format_exc(limit=4)[-900:], ""
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok ':4}{name:28}{time.time() - start:7.2f}s{note} {problem}", flush=True)
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("/")]
    dirs = [a for a in sys.argv[1:] if a.startswith("/")]
    sys.exit(main(args, dirs[0] if dirs else "/root/testdata/sf0.01") > 0)
