"""Row-for-row comparison of the registered queries with their SQL in DuckDB.

Run directly for a report: ``python tests/check.py FOLDER [NAME ...]``.
"""

from __future__ import annotations

import datetime as dt
import glob
import os
import signal
import sys
import time
from collections import Counter

import duckdb

LIMIT = 90  # seconds per query

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(types: dict[str, str]) -> dict[str, str]:
    same = {"long": "bigint", "varchar": "string", "timestamp_ntz": "timestamp", "integer": "int"}
    return {k: same.get(v.lower(), v.lower()) for k, v in types.items()}


def compare(spark, con, folder: str, name: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    want_names, want = rows_of(columns, result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    a, b = kinds(dict(df.dtypes)), kinds(want_types)
    odd = {k: (a[k], b[k]) for k in a if a[k] != b[k]}
    if odd:
        return f"types {odd}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{sum(got.values())} rows vs {sum(want.values())}; {got_names}; "
            f"extra {list(extra.items())[:2]}; lacking {list(lacking.items())[:2]}"
        )
    return None


def out_of_time(*_) -> None:
    raise TimeoutError


def main() -> None:
    import __spark_entry__ as contract
    from stayglass.session import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = local_session()
    signal.signal(signal.SIGALRM, out_of_time)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        signal.alarm(LIMIT)
        try:
            if name in sql:
                problem = compare(spark, con, folder, name, query, sql[name])
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as e:
            spark.sparkContext.cancelAllJobs()
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        signal.alarm(0)
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}"[:1500], flush=True)


if __name__ == "__main__":
    main()
