"""Run registered queries in Spark and their SQL in DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name (floats rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = bool(int(__import__("os").environ.get("ORACLE_STRICT", "0")))  # exact float equality

SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP",
                 "DateType": "DATE", "FloatType": "FLOAT", "ShortType": "SMALLINT"}


def type_diff(sdf, con, sql):
    st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat") and not isinstance(v, str):
        try:
            return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        except TypeError:
            return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SPARK-ERROR {results[name][1]}", flush=True)
            continue
        st = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:32s} rows-only {len(srows)} rows ({st:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SQL-ERROR {results[name][1]}", flush=True)
            continue
        types = type_diff(sdf, con, sqls[name]) if sorted(scols) == sorted(dcols) else {}
        if sorted(scols) != sorted(dcols):
            results[name] = ("COLS", f"spark={sorted(scols)} sql={sorted(dcols)}")
        elif types:
            results[name] = ("TYPES", str(types))
        elif len(srows) != len(drows):
            results[name] = ("COUNT", f"spark={len(srows)} sql={len(drows)}")
        else:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a == b:
                results[name] = ("OK", len(srows))
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                results[name] = ("VALUES", f"{sorted(scols)} first diffs: {diff}")
        if verbose:
            print(f"{name:32s} {results[name][0]} {results[name][1]} ({st:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from vigil.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8, 8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} fine; bad: {sorted(bad)}")
