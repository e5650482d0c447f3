"""Durable intermediate tables in the folder that all executors share."""

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: So that a task can take a file at once.
_ROWS_A_FILE = 4_000_000

_local_dirs: dict[str, str] = {}
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only for a local session without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="kinlink-")
    return _local_dirs[context.applicationId]


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/kinlink-{spark.sparkContext.applicationId}"


def discard_intermediates(spark: SparkSession) -> None:
    """Delete what this application materialized, once its results are stored elsewhere."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    local = _local_dirs.get(spark.sparkContext.applicationId)
    if local and not any(Path(local).iterdir()):  # the scratch folder goes too, unless something else lies in it
        Path(local).rmdir()
        del _local_dirs[spark.sparkContext.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A name in the shared folder for tables that are written one after the other."""
    return f"{_run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: short lineage, no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("maxRecordsPerFile", _ROWS_A_FILE).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


def stored_files(df: DataFrame, label: str) -> DataFrame:
    """``content``: the Parquet files of ``df``, which is written unless ``materialize`` wrote it. A task that reads them as
    they are is spared the passing of each row from Spark to Python."""
    path = _folders[df if df in _folders else (df := materialize(df, label))]
    return df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("content")


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more."""
    spark = table.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if "/kinlink-" in name:
            where = spark._jvm.org.apache.hadoop.fs.Path(name)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize_all(*tables: tuple[DataFrame, str]) -> list[DataFrame]:
    """Independent tables written at the same time, so that one job's last tasks leave no executor idle."""
    spark = tables[0][0].sparkSession
    shared_dir(spark)
    write = inheritable_thread_target(spark)(materialize)
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(write, *zip(*tables)))
