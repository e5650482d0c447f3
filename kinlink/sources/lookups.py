"""Lookup sources: street abbreviation sheet and word lists."""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.cast import strip

SHEET_COLUMNS = [
    "Primary Name",
    "Commonly Used Suffix or Abbreviation",
    "Postal Service Standard Abbreviation",
]
#: Sizes checked before a lookup is read on the driver; both are parameters.
MAX_LOOKUP_ROWS = 100_000
MAX_LOOKUP_BYTES = 64_000_000


def _require_path(path) -> str:
    if not isinstance(path, str) or not path:
        raise ValueError("the path must be a non-empty string")
    return path


def _require_file(spark: SparkSession, path, most_bytes: int) -> str:
    """The path, if a file is there that the driver may read whole."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_require_path(path))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        raise FileNotFoundError(path)
    if files.getContentSummary(where).getLength() > most_bytes:
        raise ValueError(f"{path} has more than {most_bytes} bytes")
    return path


def load_abbreviation_sheet(
    spark: SparkSession, path: str, skip_rows: int = 3, most_bytes: int = MAX_LOOKUP_BYTES
) -> DataFrame:
    """The exported sheet (CSV): ``skip_rows`` lines, a header line, then at least three columns; ``line`` keeps order.

    A sheet is small by nature. It is parsed on the driver, quotes and line ends inside them included, once its size
    is known to be below ``most_bytes``; its rows go back into a table.
    """
    text = spark.read.text(_require_file(spark, path, most_bytes), wholetext=True).first()
    lines = (text["value"] if text else "").splitlines(keepends=True)[skip_rows:]
    rows = list(csv.reader(lines))
    if not rows or len(rows[0]) < len(SHEET_COLUMNS):
        raise ValueError("the sheet does not have the three expected columns")
    width = len(SHEET_COLUMNS)
    body = [
        (at, *((field or None) for field in (row + [""] * width)[:width]))
        for at, row in enumerate(rows[1:], skip_rows + 1)
        if any(field.strip() for field in row)
    ]
    schema = "line int, " + ", ".join(f"`{c}` string" for c in SHEET_COLUMNS)
    return spark.createDataFrame(body, schema)


def abbreviation_entries(sheet: DataFrame, line: str = "line") -> DataFrame:
    """``(word, abbreviation, position)``: each row maps its primary and its common form to the standard one.

    A word keeps the position of its first row and the value of its last.
    """
    primary, common, standard = (F.col(f"`{c}`") for c in SHEET_COLUMNS)
    forms = F.array(
        F.struct((F.col(line) * 2).alias("at"), primary.alias("word")),
        F.struct((F.col(line) * 2 + 1).alias("at"), common.alias("word")),
    )
    entries = sheet.select(F.explode(forms).alias("e"), standard.alias("value")).select("e.at", "e.word", "value")
    known = entries.where(F.col("word").isNotNull() & F.col("value").isNotNull())
    return known.groupBy("word").agg(
        F.max_by("value", "at").alias("abbreviation"), F.min("at").cast("bigint").alias("position")
    )


def abbreviation_mapping(sheet: DataFrame, most: int = MAX_LOOKUP_ROWS) -> dict[str, str]:
    """The entries as a dict in order. A lookup is small by nature; its size is checked all the same."""
    rows = abbreviation_entries(sheet).orderBy("position").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} abbreviations")
    return {r["word"]: r["abbreviation"] for r in rows}


def word_list(lines: DataFrame) -> DataFrame:
    """Distinct upper-case words of a table with one column ``value``, without white space around them."""
    return lines.select(F.upper(strip(F.col("value"))).alias("word")).distinct()


def load_words(spark: SparkSession, path: str, most: int = MAX_LOOKUP_ROWS) -> list[str]:
    """Sorted words of a file, one on each line; more than ``most`` raise."""
    rows = word_list(spark.read.text(_require_file(spark, path, MAX_LOOKUP_BYTES))).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words")
    return sorted(r["word"] for r in rows)
