"""Compare the named queries with their SQL in DuckDB.

Run as ``python tests/oracle.py [name-part ...]``; ``SF_DIR`` chooses the data.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(value):
    return "bool" if isinstance(value, bool) else type(value).__name__


def sortable(rows):
    return sorted(rows, key=lambda r: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in r))


def spark_rows(df):
    names = sorted(df.columns)
    return names, sortable([tuple(normal(r[n]) for n in names) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(normal(r[i]) for i in order) for r in cursor.fetchall()]
    return [columns[i] for i in order], sortable(rows)


def difference(left, right) -> str | None:
    """None when names, row counts, value kinds and values agree."""
    (ln, lr), (rn, rr) = left, right
    if ln != rn:
        return f"columns {ln} vs {rn}"
    if len(lr) != len(rr):
        return f"{len(lr)} rows vs {len(rr)}"
    for a, b in zip(lr, rr):
        for n, x, y in zip(ln, a, b):
            if x is not None and y is not None and kind(x) != kind(y):
                return f"{n}: {x!r} is not of the type of {y!r}"
            if x != y:
                return f"{n}: {x!r} vs {y!r} in {a} vs {b}"
    return None


def main() -> int:
    from plumbline.session import local_session
    from plumbline.workload import ORACLES, QUERIES

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, function in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            left = spark_rows(function(spark, folder))
            took = time.time() - start
            if name in ORACLES:
                start = time.time()
                problem = difference(left, sql_rows(con, ORACLES[name]))
                verdict = problem or f"ok ({len(left[1])} rows, sql {time.time() - start:.2f}s)"
            else:
                problem, verdict = None, f"rows only ({len(left[1])} rows)"
        except Exception as error:  # report and go on with the next query
            took, problem = time.time() - start, True
            verdict = "ERROR " + str(error)[:1500]
        bad += problem is not None
        print(f"{'FAIL' if problem else '    '} {name:28s} {took:6.2f}s {verdict}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
