"""Run named queries next to their SQL twins: ``python tests/oracle.py [names]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    keys = df.apply(lambda row: tuple(repr(v) for v in row), axis=1) if len(df) else None
    return df if keys is None else df.loc[keys.sort_values(kind="stable").index].reset_index(drop=True)


def compare(spark, con, name, sf_dir):
    """(problem or None, rows, seconds of the Spark side)."""
    start = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    got = frame.toPandas()
    seconds = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return (None if len(got) else "no rows"), len(got), seconds
    want = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}", len(got), seconds
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", len(got), seconds
    a, b = normal(got), normal(want)
    if not a.equals(b):
        differing = (a != b) & ~(a.isna() & b.isna())
        rows = differing.any(axis=1)
        if rows.any():
            at = rows.idxmax()
            return f"{rows.sum()} rows differ, e.g. {a.loc[at].to_dict()} / {b.loc[at].to_dict()}", len(got), seconds
    if odd:
        return f"types {odd}", len(got), seconds
    return None, len(got), seconds


def main(names):
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or entry.queries():
        try:
            problem, rows, seconds = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem, rows, seconds = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {seconds:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
