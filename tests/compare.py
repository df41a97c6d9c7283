"""Side-by-side check of a Spark query against its DuckDB twin.

Usage: ``python tests/compare.py [sf_dir] [key ...]``.  Prints one line per key.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_diffs(df, con, sql):
    dtypes = dict(con.execute(f"DESCRIBE {sql}").fetchall() and
                  [(r[0], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()])
    out = []
    for name, t in df.dtypes:
        if SPARK_TO_DUCK.get(t, t) != dtypes.get(name):
            out.append((name, t, dtypes.get(name)))
    return out


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, key: str, sf_dir: str, spark_fn, sql: str):
    t = time.time()
    df = spark_fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    ts = time.time() - t
    t = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t
    scols = df.columns
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    ok_cols = sorted(scols) == sorted(dcols)
    tdiff = type_diffs(df, con, sql)
    ok_cols = ok_cols and not tdiff
    diff = sum(1 for x, y in zip(a, b) if x != y) + abs(len(a) - len(b))
    status = "OK" if ok_cols and diff == 0 else "MISMATCH"
    detail = ""
    if status != "OK":
        bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
        detail = f" cols_ok={ok_cols} types={tdiff} scols={scols} dcols={dcols} first_diffs={bad}"
    print(f"{status:8s} {key:24s} rows spark={len(a)} duck={len(b)} diffs={diff} "
          f"t_spark={ts:.2f}s t_duck={td:.2f}s{detail}", flush=True)
    return status == "OK"


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from cohortcast.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    n_ok = 0
    for k in (keys or list(qs)):
        if k not in oracle:
            df = qs[k](spark, sf_dir)
            print(f"NO-SQL   {k:24s} rows spark={df.count()}")
            continue
        try:
            n_ok += compare(spark, con, k, sf_dir, qs[k], oracle[k])
        except Exception as e:  # report and keep going
            print(f"ERROR    {k:24s} {type(e).__name__}: {str(e)[:400]}")
    print(f"{n_ok} ok")


if __name__ == "__main__":
    main(sys.argv)
