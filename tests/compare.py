"""Run the catalog against the SQL counterparts: python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


def difference(df, con, sql) -> str | None:
    """None if both sides agree, else what is different."""
    cursor = con.execute(sql)
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    got = table(df.columns, df.collect())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        for x, y in zip(a, b):
            if isinstance(x, str) and isinstance(y, str) and x != y:
                at = next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
                return f"{len(wrong)} rows differ, at {at}: {x[max(0, at-30):at+30]!r} != {y[max(0, at-30):at+30]!r}"
        return f"{len(wrong)} rows differ: {str(a)[:300]} != {str(b)[:300]}"
    return None


def main() -> None:
    from conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = make_session(), duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                problem = difference(df, con, oracle[name])
            else:
                problem = None if df.count() else "no rows"
            n = ""
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        kind = "S" if name in oracle else "R"
        print(f"{name:28s} {kind} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
