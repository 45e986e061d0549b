"""Runs registered queries on Spark and their SQL on DuckDB and compares the results row by row."""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.plans import REGISTRY, run  # noqa: E402
from tidemark.plans.registry import TABLES  # noqa: E402

ROOT = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return ("dec", float(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr([plain(r[i]) for i in order]) for r in rows))


def spark_rows(name, spark, folder):
    df = run(name, spark, folder)
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(name, con):
    res = con.execute(REGISTRY[name].sql)
    return rows_of([d[0] for d in res.description], res.fetchall())


def compare(name, spark, con, folder):
    t0 = time.time()
    cols, got = spark_rows(name, spark, folder)
    t1 = time.time()
    if REGISTRY[name].sql is None:
        return f"rows-only {len(got)}", t1 - t0, True
    try:
        ocols, want = sql_rows(name, con)
    except Exception as e:  # noqa: BLE001
        return f"ORACLE ERROR {str(e)[:600]}", t1 - t0, False
    if cols != ocols:
        return f"COLUMNS {cols} vs {ocols}", t1 - t0, False
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        msg = f"DIFF spark={len(got)} sql={len(want)} cols={cols}\n   only spark({len(a)}): {sorted(a)[:2]}\n   only sql({len(b)}): {sorted(b)[:2]}"
        return msg, t1 - t0, False
    if not got:
        return "EMPTY", t1 - t0, False
    return f"ok {len(got)}", t1 - t0, True


def main(argv):
    from tidemark.session import get_spark

    sf = "0.01"
    names = []
    for a in argv:
        if a.startswith("sf="):
            sf = a[3:]
        elif a.startswith("from="):
            names += [n for n, q in REGISTRY.items() if q.build.__module__.endswith(a[5:])]
        else:
            names += [n for n in REGISTRY if n == a or (a.endswith("*") and n.startswith(a[:-1]))]
    names = names or list(REGISTRY)
    folder = f"{ROOT}/sf{sf}"
    spark = get_spark("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for n in names:
        try:
            msg, sec, ok = compare(n, spark, con, folder)
        except Exception as e:  # noqa: BLE001
            msg, sec, ok = f"SPARK ERROR {str(e)[:900]}", 0.0, False
        bad += not ok
        print(f"{'   ' if ok else '!! '}{n:38s} {sec:6.2f}s {msg}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
