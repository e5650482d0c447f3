"""Table sources and sinks: JDBC, stage cache, snapshots, match and statistics tables, DDL."""

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinlink.sources.digest import fingerprint as fingerprint


def jdbc_options(config: dict[str, dict[str, str]], section: str) -> dict[str, str]:
    """Connection options of one configuration section: ``url`` and whatever else Spark's JDBC source takes."""
    if section not in config:
        raise ValueError(f"no configuration section {section!r}")
    options = dict(config[section])
    if "url" not in options:
        raise ValueError(f"section {section!r} lacks the key 'url'")
    return options


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"the {what} is empty")
    return df


def read_jdbc(
    spark: SparkSession, options: dict[str, str], query: str, partition: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """Rows of a SELECT; an empty result raises.

    ``partition`` is (column, lower, upper, number): without it one task reads everything, so give it for any
    table of size. The bounds only spread the rows; rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partition is None:
        reader = reader.option("query", query)
    else:
        column, lower, upper, number = partition
        reader = reader.option("dbtable", f"({query}) source").options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=number
        )
    return require_rows(reader.load(), "query result")


def append_jdbc(df: DataFrame, options: dict[str, str], table: str) -> None:
    if not table:
        raise ValueError("the table name must be a non-empty string")
    require_rows(df).write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def append_table(df: DataFrame, table: str) -> None:
    if not table:
        raise ValueError("the table name must be a non-empty string")
    require_rows(df).write.mode("append").saveAsTable(table)


def save_snapshot(df: DataFrame, path: str) -> None:
    if not isinstance(df, DataFrame):
        raise TypeError("not a DataFrame")
    if not isinstance(path, str) or not path:
        raise ValueError("the path must be a non-empty string")
    df.write.mode("overwrite").parquet(path)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    if not isinstance(path, str) or not path:
        raise ValueError("the path must be a non-empty string")
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def cached_stage(spark: SparkSession, path: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table if it was completed for the same key, else built and written. Parquet keeps the types."""
    place = f"{path}/{key}"
    if not path_exists(spark, f"{place}/_SUCCESS"):
        build().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names_in(spark: SparkSession, path: str) -> list[str]:
    files, where = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def _manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest of a published table: its number and schema, and the run folder of each phase."""
    numbers = [int(m[1]) for n in _names_in(spark, path) if (m := re.fullmatch(r"manifest-(\d+)", n))]
    if not numbers:
        return {"number": 0, "runs": {}}
    text = spark.read.text(f"{path}/manifest-{max(numbers)}", wholetext=True).first()[0]
    return json.loads(text)


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Writes a manifest under a name of its own, then gives it its number: readers see all of it or none."""
    files, hidden = _folder(spark, f"{path}/_writing-{uuid.uuid4().hex}")
    out = files.create(hidden, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not files.rename(hidden, _folder(spark, f"{path}/manifest-{manifest['number']}")[1]):
        raise FileExistsError(f"another run published to {path}")


def write_matches(df: DataFrame, path: str, form: str = "parquet", phases: Sequence[int] = ()) -> None:
    """Publish matches phase by phase; a repeated phase replaces its own rows only. ``read_matches`` reads them.

    ``phases`` are the phases that were run: one without rows is published without rows, so that no older run's stay. Rows
    go to a folder of the run, then a manifest names the folder of each phase. A run that stops before that changes nothing
    that readers see. Folders that neither this manifest nor the one before it names are removed. One writer at a time.
    """
    spark, run = df.sparkSession, f"run-{form}-{uuid.uuid4().hex}"
    writer = df.write.format(form)
    if form == "csv":
        writer = writer.option("header", True)
    writer.partitionBy("phase").save(f"{path}/{run}")
    held = [n.removeprefix("phase=") for n in _names_in(spark, f"{path}/{run}") if n.startswith("phase=")]
    before = _manifest(spark, path)
    runs = {p: r for p, r in before["runs"].items() if p not in map(str, phases)} | dict.fromkeys(held, run)
    _publish(spark, path, {"number": before["number"] + 1, "schema": df.schema.json(), "runs": runs})
    for name in _names_in(spark, path):
        if name.startswith("run-") and name not in {*runs.values(), *before["runs"].values()}:
            files, where = _folder(spark, f"{path}/{name}")
            files.delete(where, True)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_matches`` published last."""
    manifest = _manifest(spark, path)
    if not manifest["number"]:
        raise FileNotFoundError(f"nothing is published in {path}")
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    found = spark.createDataFrame([], schema)
    for run in dict.fromkeys(manifest["runs"].values()):
        base = f"{path}/{run}"
        phases = [f"{base}/phase={p}" for p, r in manifest["runs"].items() if r == run]
        reader = spark.read.schema(schema).option("basePath", base).option("header", True).format(run.split("-")[1])
        found = found.unionByName(reader.load(phases).select(schema.names))
    return found


def write_stats(df: DataFrame, path: str, phases: Sequence[int] = ()) -> None:
    write_matches(df, path, phases=phases)


_SQL_TYPES = {
    **dict.fromkeys((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "INTEGER"),
    **dict.fromkeys((T.FloatType, T.DoubleType), "FLOAT"),
    **dict.fromkeys((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    T.StringType: "STRING",
}


def _quoted(name: str) -> str:
    return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else '"' + name.replace('"', '""') + '"'


def create_table_sql(table: str, schema: T.StructType) -> str:
    columns = ", ".join(f"{_quoted(f.name)} {_SQL_TYPES.get(type(f.dataType), 'STRING')}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns});"
