"""Run registered queries against their SQL twins: python check.py [--sf DIR] [name ...]"""

import argparse
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from catalog import load

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cpus="8"):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", os.environ.get("ROWLOOM_CHECKPOINTS", "/tmp/rowloom-checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if v is None or isinstance(v, (str, bool, int)):
        return v
    return float(v) if hasattr(v, "as_tuple") else str(v)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda t: tuple((v is None, str(type(v)) if isinstance(v, str) else "", v if v is not None else 0) for v in t))


def close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    queries, oracles = load()
    spark = session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad = 0
    for name, fn in queries.items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = fn(spark, args.sf)
            cols, got = table_of(df.columns, df.collect())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: spark {type(e).__name__}: {str(e)[:600]}")
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"rows {name}: {len(got)} rows {took:.1f}s {got[:2] if len(str(got[:2])) < 200 else ''}")
            continue
        try:
            cur = con.execute(oracles[name])
            want_cols, want = table_of([d[0] for d in cur.description], cur.fetchall())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: sql {str(e)[:600]}")
            continue
        if cols != want_cols:
            state = f"FAIL columns {cols} {want_cols}"
        elif got == want:
            state = "ok  "
        elif len(got) == len(want) and all(close(a, b) for x, y in zip(got, want) for a, b in zip(x, y)):
            state = "ok~ "
        else:
            diff = [(x, y) for x, y in zip(got, want) if not all(close(a, b) for a, b in zip(x, y))]
            state = f"FAIL {len(got)}/{len(want)} rows, {len(diff)} differ {str(diff[:2])[:500]}"
        bad += state.startswith("FAIL")
        print(f"{state} {name}: {len(got)} rows {took:.1f}s", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main()
