"""Inputs of the checks: two parties derived from the given tables by SQL that Spark and DuckDB both run."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions import text
from kinlink.operators.ordering import by_shuffle
from kinlink.storage import materialize

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Street words in order; STR goes through STREET on purpose, PO BOX and B/O are no single words.
ABBREVIATIONS = {
    "STR": "STREET",
    "AVENUE": "AVE",
    "AV": "AVE",
    "STREET": "ST",
    "BOULEVARD": "BLVD",
    "PO BOX": "POB",
    "STANDARD": "STD",
    "B/O": "BO",
    "ROAD": "RD",
}

# Names and streets come from the whole of part; customers and suppliers of one part key share zip and city. One zip in
# five rows is hot, one street in nine is a filler.
LEFT_PARTY = """
SELECT c.c_custkey + 1 AS record_id,
 CASE WHEN c.c_custkey % 37 = 0 THEN NULL WHEN c.k % 5 = 3 THEN '15099' ELSE lpad(CAST(15000 + c.k % 25 AS STRING), 5, '0') END AS zip,
 CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE upper(n.n_name) END AS city,
 CAST(floor(c.c_custkey / 4) AS BIGINT) AS fein,
 CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_custkey % 5 + 1 END AS address_type,
 CASE WHEN c.k % 9 = 4 THEN 'no such street' ELSE concat(CAST(c.k % 97 + 1 AS STRING), ' ', lower(p.p_type), CASE c.c_custkey % 3 WHEN 0 THEN ' street' WHEN 1 THEN ' st.' ELSE ' st' END) END AS street,
 concat(CASE WHEN c.c_custkey % 5 = 0 THEN replace(p.p_name, 'e', 'a') ELSE p.p_name END, CASE c.c_custkey % 4 WHEN 0 THEN ' Inc' WHEN 1 THEN 'LLC' WHEN 2 THEN ' of the East' ELSE '' END) AS name
FROM (SELECT c_custkey, c_custkey % n AS k FROM customer CROSS JOIN (SELECT count(*) AS n FROM part) total) c
JOIN nation n ON n.n_nationkey = c.k % 25 JOIN part p ON p.p_partkey = c.k
"""

RIGHT_PARTY = """
SELECT s.s_suppkey + 1 AS record_id,
 CASE WHEN s.k % 5 = 3 THEN '15099' ELSE lpad(CAST(15000 + s.k % 25 AS STRING), 5, '0') END AS zip, upper(n.n_name) AS city,
 CASE WHEN s.k % 9 = 4 THEN 'no such street' ELSE concat(CAST(s.k % 97 + 1 AS STRING), ' ', p.p_type, CASE WHEN s.s_suppkey % 6 = 5 THEN ' St. West' WHEN s.s_suppkey % 2 = 0 THEN ' Street' ELSE ' St' END) END AS street,
 concat(p.p_name, CASE s.s_suppkey % 3 WHEN 0 THEN ' Corp' WHEN 1 THEN ' East' ELSE ' and sons' END) AS name,
 CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE p.p_name END AS parent
FROM (SELECT s_suppkey, s_suppkey % n AS k FROM supplier CROSS JOIN (SELECT count(*) AS n FROM part) total) s
JOIN nation n ON n.n_nationkey = s.k % 25 JOIN part p ON p.p_partkey = s.k
"""

ADDRESSES = f"""
SELECT 'L' AS side, record_id, CASE record_id % 9
 WHEN 0 THEN concat('(C/O someone) ', street) WHEN 1 THEN concat(street, ', Ste. 4B')
 WHEN 2 THEN concat(street, '  # 12') WHEN 3 THEN concat('10-', street, ' unit 3b')
 WHEN 4 THEN replace(street, ' ', '..') WHEN 5 THEN concat(street, ' North East floor 2')
 WHEN 6 THEN concat('po box ', street, ' northwest') WHEN 7 THEN NULL ELSE concat('  ', street, ' Str, b/o') END AS address
FROM ({LEFT_PARTY}) l
UNION ALL
SELECT 'R' AS side, record_id, street AS address FROM ({RIGHT_PARTY}) r
"""

NAMES = """
SELECT p_partkey AS id, CASE p_partkey % 10
 WHEN 0 THEN concat(p_name, 'Inc') WHEN 1 THEN concat('The house of ', p_name, ' LLC')
 WHEN 2 THEN concat('1st & 3rd ', p_name) WHEN 3 THEN concat('76 ', p_name, ' limited')
 WHEN 4 THEN concat(p_name, ' north-east corp.') WHEN 5 THEN concat('ZINC ', p_name, 'ltdinc')
 WHEN 6 THEN concat(p_name, ' 10 for 11TH standard street') WHEN 7 THEN NULL
 WHEN 8 THEN concat(p_name, ', ', p_type, ' #', CAST(p_size AS STRING)) ELSE concat(p_name, ' b/o INCORPORATED') END AS name
FROM part
"""


def register(spark: SparkSession, sf_dir: str, tables=TABLES) -> None:
    for table in tables:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        # the parties join part, which grows like customer
        (by_shuffle(rows) if table == "part" else rows).createOrReplaceTempView(table)


def sql(spark: SparkSession, sf_dir: str, *queries: str):
    """The queries' results over the given tables."""
    register(spark, sf_dir, [t for t in TABLES if re.search(rf"\b{t}\b", " ".join(queries))])
    results = [spark.sql(q) for q in queries]
    return results[0] if len(results) == 1 else results


def keyed_parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both parties with match keys, kept as tables like the cleaning job's result."""
    left, right = sql(spark, sf_dir, LEFT_PARTY, RIGHT_PARTY)

    def keys(df: DataFrame, *more):
        return df.select(
            "record_id",
            F.col("zip").alias("Zip_UPDATED"),
            F.col("city").alias("City_UPDATED"),
            text.standardize_street(F.col("street"), ABBREVIATIONS).alias("Street_UPDATED"),
            text.standardize_business_name(F.col("name"), ABBREVIATIONS).alias("BusinessName_UPDATED"),
            *more,
        )

    parent = text.standardize_business_name(F.col("parent"), ABBREVIATIONS).alias("GlobalName_UPDATED")
    return materialize(keys(left), "left"), materialize(keys(right, parent), "right")


# The parties as raw tables with the column names of the cleaning job.
LEFT_RAW = f"""
SELECT lpad(CAST(record_id AS STRING), 9, '0') AS FileNumber, zip AS Zipcode,
 CASE WHEN fein % 50 = 0 THEN NULL ELSE concat('10-', lpad(CAST(fein AS STRING), 7, '0')) END AS PrimaryFEIN,
 name AS PrimaryInsuredName, CASE WHEN record_id % 53 = 0 THEN 'PA' ELSE street END AS StreetAddress,
 CASE WHEN record_id % 6 = 1 THEN replace(city, 'NATION', 'NATON') ELSE city END AS City, 'PA' AS State,
 CAST(NULL AS STRING) AS InsuredPhoneNumber, CAST(address_type AS STRING) AS AddressTypeCode,
 CAST(record_id % 90 AS STRING) AS NumberOfEmployees FROM ({LEFT_PARTY}) party
"""
RIGHT_RAW = f"""
SELECT record_id AS source_key, name AS business_name, parent AS global_ultimate_name, street AS physical_street_address,
 CAST(NULL AS STRING) AS second_address_line, city AS physical_city, 'PA' AS physical_state_abbreviation,
 concat(zip, '-0001') AS physical_zip, CAST(NULL AS STRING) AS tradestyle, CAST(NULL AS STRING) AS second_tradestyle,
 parent AS domestic_ultimate_business_name, '12' AS employees_total, '' AS employees_here FROM ({RIGHT_PARTY}) party
"""
