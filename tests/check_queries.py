"""Run registered queries against their checking SQL: ``python check_queries.py SF_DIR [name ...]``."""

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def engine(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, run, sql, sf_dir):
    """None where both sides agree, else a text that says how they differ."""
    df = run(spark, sf_dir)
    got, got_columns = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    want, want_columns = rows_of(rel.columns, rel.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} <> {want_columns}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for f in df.schema:
        if names.get(f.dataType.simpleString()) != kinds[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} <> {kinds[f.name]}"
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} <> {len(want)} rows; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    directory, wanted = sys.argv[1], sys.argv[2:]
    con, bad = engine(directory), 0
    for name, run in e.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            problem = compare(spark, con, name, run, e.oracle_sql().get(name), directory)
        except Exception:
            problem = traceback.format_exc(limit=4)[-1500:]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
