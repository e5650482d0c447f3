"""City names corrected against a reference list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.cast import MISSING_TEXT, match_key
from kinlink.functions.similarity import soundex, sorted_tokens
from kinlink.operators.best import best_in_block
from kinlink.operators.similar import similar_values
from kinlink.storage import materialize, materialize_all

CITY_THRESHOLD = 85.0


def city_corrections(cities: DataFrame, reference: DataFrame, threshold: float = CITY_THRESHOLD) -> DataFrame:
    """``(city, corrected)`` for distinct upper-case cities; those without any counterpart are absent.

    Exact name first, then the best word-order-free ratio from ``threshold`` up, then the best one among the
    reference cities that sound alike. Ties go to the alphabetically first city.
    """
    cities, reference = materialize_all((cities, "cities"), (reference, "reference-cities"))
    exact = cities.join(reference.withColumnRenamed("city", "corrected"), F.col("city") == F.col("corrected"))
    open_cities = cities.join(reference, "city", "left_anti").withColumn("value", sorted_tokens(F.col("city")))
    known = reference.withColumn("value", sorted_tokens(F.col("city")))
    pairs = similar_values(open_cities, known, threshold)
    near = (
        open_cities.join(pairs, F.col("value") == F.col("left_value"))
        .select("city", "right_value", "score")
        .join(known.select(F.col("city").alias("corrected"), "value"), F.col("right_value") == F.col("value"))
        .groupBy("city")
        .agg(F.min(F.struct((-F.col("score")).alias("loss"), "corrected")).alias("best"))
        .select("city", F.col("best.corrected").alias("corrected"))
    )
    near = materialize(near, "near-cities")
    rest = open_cities.join(near, "city", "left_anti")
    alike = best_in_block(
        rest.select(soundex(F.col("city")).alias("code"), F.col("city").alias("value")),
        reference.select(soundex(F.col("city")).alias("code"), F.col("city").alias("value")),
        "code",
        "token_sort",
    ).select(F.col("left_value").alias("city"), F.col("right_value").alias("corrected"))
    return exact.unionByName(near).unionByName(alike)


def standardize_city(df: DataFrame, column: str, reference: DataFrame, name: str) -> DataFrame:
    """Adds the corrected city; null where nothing fits and for the filler value.

    Distinct cities are stored once and worked on as a small table; the large one is read for them and for the join. ``reference`` has one column of raw city names.
    """
    raw = reference.columns[0]
    known = reference.select(F.col(raw).alias("city")).where(F.col("city").isNotNull()).distinct()
    key = F.nullif(match_key(F.col(column)), F.lit(MISSING_TEXT))
    cities = df.select(key.alias("city")).where(F.col("city").isNotNull()).distinct()
    fixed = city_corrections(cities, known).select(F.col("city").alias("_city"), F.col("corrected").alias(name))
    return df.withColumn("_key", key).join(fixed, F.col("_key") == F.col("_city"), "left").drop("_key", "_city")
