"""Input contracts of the two linked tables."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(strings: list[str], longs: list[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in strings]
    return T.StructType(fields + [T.StructField(c, T.LongType()) for c in longs])


# Column names of the two source tables.
LEFT_TEXT = [
    "Zipcode",
    "FileNumber",
    "PrimaryFEIN",
    "PrimaryInsuredName",
    "StreetAddress",
    "StreetAddress_Rev",
    "City",
    "State",
    "InsuredPhoneNumber",
]
LEFT_INTEGER = ["AddressTypeCode", "NumberOfEmployees"]
RIGHT_TEXT = [
    "physical_street_address",
    "second_address_line",
    "physical_city",
    "physical_state_abbreviation",
    "physical_zip",
    "tradestyle",
    "second_tradestyle",
    "global_ultimate_name",
    "domestic_ultimate_business_name",
]
RIGHT_INTEGER = ["employees_total", "employees_here"]

LEFT_SCHEMA = _struct(LEFT_TEXT, LEFT_INTEGER)
RIGHT_SCHEMA = _struct(["business_name", *RIGHT_TEXT], RIGHT_INTEGER)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
