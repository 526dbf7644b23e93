"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: same column names, same row count, and the same multiset of
rows after sorting columns by name (floats compared to 1e-9 relative).
Usable as a script: ``python tests/oracle_compare.py SF_DIR [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOL",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "decimal": "DECIMAL",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "array<float>": "FLOAT[]"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9) + 0.0
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems, t1 - t0, t2 - t1
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]).upper() for d in res.description}
    for c in s_cols:
        want = SPARK_TO_DUCK.get(s_types[c].split("(")[0], s_types[c].upper())
        if not d_types[c].startswith(want):
            problems.append(f"TYPE {c}: spark={s_types[c]} duck={d_types[c]}")
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    dorder = [d_cols.index(s_cols[i]) for i in order]
    srows = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    drows = sorted((tuple(_norm(r[i]) for i in dorder) for r in d_rows), key=_key)
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} duck={len(drows)}")
    bad = 0
    for a, b in zip(srows, drows):
        if a != b:
            ok = len(a) == len(b) and all(
                (x == y) or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-9 * max(1, abs(x)))
                for x, y in zip(a, b))
            if not ok:
                bad += 1
                if bad <= 3:
                    problems.append(f"row differs:\n  spark={a}\n  duck ={b}")
    if bad:
        problems.append(f"{bad} differing rows; columns={sorted(s_cols)}")
    return problems, t1 - t0, t2 - t1


def main(argv):
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"[rows-only] {n}: {df.count()} rows")
            continue
        try:
            problems, ts, td = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, ts, td = [f"ERROR {type(e).__name__}: {str(e)[:600]}"], 0, 0
        status = "OK  " if not problems else "FAIL"
        failed += bool(problems)
        print(f"[{status}] {n}  spark={ts:.2f}s duck={td:.2f}s")
        for p in problems:
            print("     ", p)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
