"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Used by the test-suite and as a script:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)), [columns[i] for i in order]


def compare(spark_df, con, sql):
    sp_cols = spark_df.columns
    sp_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    dk_cols = [d[0] for d in res.description]
    dk_rows = res.fetchall()
    a, ca = _rows(sp_cols, sp_rows)
    b, cb = _rows(dk_cols, dk_rows)
    problems = []
    if ca != cb:
        problems.append(f"columns differ: spark={ca} duckdb={cb}")
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} duckdb={len(b)}")
    if not problems:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} duckdb={bad[0][1]}")
    return problems, len(a)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from basketry.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    queries, oracle = E.queries(), E.oracle_sql()
    failed = 0
    for name in names or list(queries):
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problems, n = compare(df, con, oracle[name])
            else:
                n, problems = df.count(), ["(rows only)"]
        except Exception as exc:  # report and continue
            problems, n = [f"ERROR {type(exc).__name__}: {str(exc)[:400]}"], -1
        status = "OK " if not problems else ("ROWS" if problems == ["(rows only)"] else "BAD")
        if status == "BAD":
            failed += 1
        print(f"{status} {name:32s} rows={n:<7} {time.time() - t0:6.1f}s {'; '.join(problems)}",
              flush=True)
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
