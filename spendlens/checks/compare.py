"""Run queries in Spark and in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import pandas as pd
from pyspark.sql import SparkSession

from spendlens.checks.oracles import ORACLES
from spendlens.checks.queries import QUERIES


def duckdb_tables(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    columns = [
        pd.to_datetime(df[c]).astype("datetime64[us]").astype(str)
        if "datetime" in str(df[c].dtype)
        else df[c]
        for c in df.columns
    ]
    return sorted(zip(*[c.tolist() for c in columns]), key=repr)


def difference(expected: pd.DataFrame, found: pd.DataFrame) -> str | None:
    if sorted(expected.columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)}, expected {sorted(expected.columns)}"
    kinds = {c: (found[c].dtype, expected[c].dtype) for c in found.columns if found[c].dtype.kind != expected[c].dtype.kind}
    if kinds:
        return f"types {kinds}"
    a, b = canonical(expected), canonical(found)
    if len(a) != len(b):
        return f"{len(b)} rows, expected {len(a)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {y}, expected {x}"
    return None


def check(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    return difference(con.sql(ORACLES[name]).df(), QUERIES[name](spark, sf_dir).toPandas())


def main(sf_dir: str, names: list[str]) -> int:
    from spendlens.session import build_session

    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_tables(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = check(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = str(e)[:1500]
        failed += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - started:.1f}s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
