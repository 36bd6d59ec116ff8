"""Spark-vs-DuckDB comparison in the shape of the driver's check:
row count, column names, order-insensitive values (floats to 6 places)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
          "array<string>": "VARCHAR[]", "timestamp_ntz": "TIMESTAMP", "array<double>": "DOUBLE[]"}


def type_mismatches(spark_df, rel):
    dtypes = dict(spark_df.dtypes)
    out = []
    for d in rel.description:
        name, dtype = d[0], str(d[1])
        want = _TYPES.get(dtypes.get(name, "?"), dtypes.get(name, "?"))
        if want != dtype:
            out.append(f"{name}: spark={dtypes.get(name)} duck={dtype}")
    return out


def compare(spark_df, con, sql):
    cols = sorted(spark_df.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    if sorted(dcols) != cols:
        return False, f"columns differ: spark={cols} duck={sorted(dcols)}"
    bad_types = type_mismatches(spark_df, rel)
    if bad_types:
        return False, f"types differ: {bad_types}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    s, d = sorted(srows, key=_key), sorted(drows, key=_key)
    for a, b in zip(s, d):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(srows)} rows"


def run(spark, sf_dir, names=None):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                ok, msg = compare(df, con, sqls[name])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as exc:  # report and continue
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:400]}"
        results[name] = (ok, msg, round(time.time() - t0, 2))
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {results[name][2]:6.2f}s {msg}", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from tessera.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = run(spark, sf, names)
    bad = [k for k, v in res.items() if not v[0]]
    print("FAILED:", bad)
