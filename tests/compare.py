"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    plain = [tuple(None if pd.isna(v) else v for v in row) for row in df.itertuples(index=False)]
    return sorted(plain, key=repr)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: str(df[c].dtype) for c in sorted(df.columns)}


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if kinds(got) != kinds(want):
        return f"types {kinds(got)} != {kinds(want)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            got = run(spark, sf_dir).toPandas()
            spent = time.time() - start
            start = time.time()
            want = con.execute(sql[name]).df() if name in sql else None
            lag = time.time() - start
            verdict = "no sql" if want is None else difference(got, want) or "ok"
            print(f"{name:26} {len(got):8} rows {spent:7.2f}s sql {lag:6.2f}s {verdict}", flush=True)
        except Exception as error:
            print(f"{name:26} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
