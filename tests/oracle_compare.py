"""Compare a Spark query with its SQL text run by DuckDB on the same parquet
files: row count, column names, and the multiset of rows (floats rounded)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "spark_sec": round(t1 - t0, 2)}
    res["cols_ok"] = sorted(scols) == sorted(dcols)
    if not res["cols_ok"]:
        res["cols"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        res["ok"] = False
        return res
    a, b = rows_key(scols, srows), rows_key(dcols, drows)
    res["ok"] = a == b
    if not res["ok"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["sample"] = {"spark_only": diff_a, "duck_only": diff_b,
                         "cols": sorted(scols)}
    return res


def main(argv):
    sys.path.insert(0, ".")
    from assay.session import build_session
    import __spark_entry__ as E
    sf_dir = "/root/testdata/sf0.01"
    names = argv or sorted(E.oracle_sql())
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(n, "rows-only", df.count(), flush=True)
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
