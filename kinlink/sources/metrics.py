"""Run metrics: one appended row per operation, a folder per run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.operators.stats import match_rate
from kinlink.sources.tables import path_exists

_STORED = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("percentage", T.DoubleType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)
# Column names of the metrics report.
REPORT = {
    "description": "Description of Operation",
    "rows_before": "Rows Before",
    "rows_after": "Rows After",
    "percentage": "Percentage Change",
    "logged_at": "Timestamp",
}


def metric_rows(counts: DataFrame) -> DataFrame:
    """``counts`` (description, rows_before, rows_after) with the rate and the time."""
    rate = match_rate(F.col("rows_before"), F.col("rows_after"))
    return counts.withColumns({"percentage": rate.cast("double"), "logged_at": F.current_timestamp()})


def log_metrics(counts: DataFrame, path: str, run_id: str) -> None:
    rows = metric_rows(counts).withColumn("run_id", F.lit(run_id))
    rows.write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Metrics of one run (its folder alone is read); no rows if it logged none."""
    if path_exists(spark, path):
        stored = spark.read.schema(_STORED).parquet(path).where(F.col("run_id") == run_id)
    else:
        stored = spark.createDataFrame([], _STORED)
    return stored.select([F.col(c).alias(name) for c, name in REPORT.items()])
