"""Run queries() in Spark and oracle_sql() in DuckDB and compare results.

Mirrors the driver's gate: row count, column names and an order-insensitive
comparison of values.  Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, decimal.Decimal)):
        return (2, repr(float(v)) if isinstance(v, decimal.Decimal) else str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        return (3, repr(v))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (5, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (6, str([norm(x) for x in v]))
    if isinstance(v, dict):
        return (7, str(sorted((k, norm(x)) for k, x in v.items())))
    return (8, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def spark_family(dtype: str) -> str:
    d = dtype.lower()
    if d in ("tinyint", "smallint", "int", "bigint"):
        return "integer"
    if d in ("float", "double"):
        return "floating"
    for prefix, fam in (("decimal", "decimal"), ("string", "string"), ("varchar", "string"), ("char", "string"),
                        ("boolean", "boolean"), ("date", "date"), ("timestamp", "timestamp"), ("array", "list"),
                        ("map", "map"), ("struct", "struct"), ("binary", "binary")):
        if d.startswith(prefix):
            return fam
    return d


def duck_family(dtype: str) -> str:
    d = str(dtype).upper()
    if d in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "integer"
    if d in ("FLOAT", "DOUBLE"):
        return "floating"
    for prefix, fam in (("DECIMAL", "decimal"), ("VARCHAR", "string"), ("BOOLEAN", "boolean"), ("DATE", "date"),
                        ("TIMESTAMP", "timestamp"), ("MAP", "map"), ("STRUCT", "struct"), ("BLOB", "binary")):
        if d.startswith(prefix):
            return fam
    return "list" if d.endswith("[]") else d.lower()


def compare(spark, con, sf_dir, name, qfn, sql):
    sdf = qfn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    problems = []
    if sc != dc:
        problems.append(f"columns spark={sc} duck={dc}")
    else:
        stypes = {c: spark_family(t) for c, t in sdf.dtypes}
        dtypes = {d[0]: duck_family(d[1]) for d in res.description}
        bad = {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes[c]}
        if bad:
            problems.append(f"types differ {bad}")
    if len(sr) != len(dr):
        problems.append(f"rows spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return len(srows), problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as e
    from dqflow.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con = duck(sf_dir)
    qs, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        if name not in oracle:
            n = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            n, problems = compare(spark, con, sf_dir, name, fn, oracle[name])
        except Exception as exc:  # noqa: BLE001
            n, problems = -1, [f"error: {str(exc)[:400]}"]
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name}: {n} rows ({time.time() - t0:.1f}s) {'; '.join(problems)}", flush=True)
    missing = sorted(set(oracle) - set(qs))
    if missing:
        print("oracle without query:", missing)
    print(f"{bad} mismatches")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
