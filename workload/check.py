"""Run queries and their SQL twins side by side: ``python -m workload.check [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelspark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelspark-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query and its twin; empty when they agree exactly."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"]
    ours = rows_of(df.columns, df.collect())
    theirs = rows_of(rel.columns, rel.fetchall())
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} vs {len(theirs)}"]
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return [f"{len(bad)} of {len(ours)} rows, e.g. {bad[0][0]} vs {bad[0][1]}"] if bad else []


def type_notes(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
        "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    }
    rel = con.sql(sql)
    theirs = {c: names.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    return [f"{c}: {t} vs {theirs.get(c)}" for c, t in df.dtypes if theirs.get(c) != t]


def main(names: list[str]) -> int:
    from workload.catalog import QUERIES, SQL

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                found = differences(df, con, SQL[name])
                notes = type_notes(df, con, SQL[name])
            else:
                found, notes = [], [f"rows only: {df.count()}"]
        except Exception as exc:  # noqa: BLE001
            found, notes = [f"{type(exc).__name__}: {str(exc)[:600]}"], []
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:5.1f}s {name} {found or ''} {notes or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
