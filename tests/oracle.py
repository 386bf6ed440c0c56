"""Run queries against their DuckDB oracle: python tests/oracle.py [sf_dir] [name part ...]"""

import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def normalize(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def difference(spark, con, sf_dir, name, fn, sql):
    """None when equal, else a short description."""
    df = fn(spark, sf_dir)
    got_cols, got = normalize(df.columns, [tuple(r) for r in df.collect()])
    if not got:
        return "no rows"
    if sql is None:
        return None
    cur = con.execute(sql)
    want_cols, want = normalize([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {set(map(repr, got)) ^ set(map(repr, want))}"[:800]
    bad = [(g, w) for g, w in zip(got, want, strict=True) if repr(g) != repr(w)]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {str(bad[0])[:700]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="foliant-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            diff = difference(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "oracle" if name in oracles else "rows"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s {diff or ''}", flush=True)
        if diff:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
