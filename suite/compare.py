"""Run queries and their SQL side by side: ``python -m suite.compare [sf_dir] [name ...]``."""

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from suite.checks import QUERIES, SQL
from suite.parties import TABLES


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None).map(lambda v: v if v is None or isinstance(v, (str, bool)) else float(v))
    return frame.sort_values(list(frame.columns), key=lambda c: c.map(repr), ignore_index=True)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str:
    """Empty if the query's rows equal its SQL's."""
    got = _sorted(QUERIES[name](spark, sf_dir).toPandas())
    if name not in SQL:
        return "" if len(got) else "no rows"
    want = _sorted(connection.sql(SQL[name]).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got.equals(want):
        where = (got.map(repr) != want.map(repr)).any(axis=1)
        return f"{where.sum()} of {len(got)} rows differ\n{got[where].head(3)}\n{want[where].head(3)}"
    return "" if len(got) else "no rows"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, connection, bad = session(), duck_tables(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            result = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result)
        print(f"{time.time() - start:6.1f}s {name}: {result or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
