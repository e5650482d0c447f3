"""Cleaning steps on whole tables: casts, default values, standardised address and name columns."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions import cast, text
from kinlink.operators.city import standardize_city
from kinlink.schema import require_columns


def cast_integers(df: DataFrame, columns: list[str], blank_as_null: bool, strict: bool = True) -> DataFrame:
    require_columns(df, columns)
    source = {c: F.col(c).cast("string") for c in columns}
    if blank_as_null:
        source = {c: cast.blank_to_null(v) for c, v in source.items()}
    return df.withColumns({c: cast.as_integer(v, strict) for c, v in source.items()})


def cast_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    require_columns(df, columns)
    return df.withColumns({c: cast.as_text(F.col(c)) for c in columns})


def cast_left(df: DataFrame, integers: list[str], strings: list[str], strict: bool = True) -> DataFrame:
    return cast_strings(cast_integers(df, integers, True, strict), strings)


def cast_right(df: DataFrame, integers: list[str], strings: list[str], strict: bool = True) -> DataFrame:
    """As for the left table, and the fifth text column is cut to its first five-digit run."""
    df = cast_integers(df, integers, False, strict)
    if len(strings) > 4:
        require_columns(df, [strings[4]])
        df = df.withColumn(strings[4], cast.zip5(F.col(strings[4])))
    return cast_strings(df, strings)


def fill_left_values(df: DataFrame, strict: bool = True) -> DataFrame:
    require_columns(df, ["PrimaryFEIN", "City", "Zipcode", "StreetAddress"])
    streets = [c for c in ("StreetAddress", "StreetAddress_Rev") if c in df.columns]
    return df.withColumns(
        {
            "PrimaryFEIN": cast.tax_id(F.col("PrimaryFEIN"), strict),
            "City": cast.fill_default(F.col("City"), cast.MISSING_TEXT),
            "Zipcode": cast.fill_default(F.col("Zipcode"), cast.MISSING_ZIP),
            **{c: cast.replace_placeholder(F.col(c)) for c in streets},
        }
    )


def add_composite_key(df: DataFrame, name: str, tax_id: str, street: str) -> DataFrame:
    require_columns(df, [street])
    return df.withColumn(name, cast.composite_key(F.col(tax_id), F.col(street)))


def add_address_columns(
    df: DataFrame,
    columns: list[str],
    abbreviations: Mapping[str, str],
    directions: Mapping[str, str] = text.DIRECTIONS,
    reference_cities: DataFrame | None = None,
) -> DataFrame:
    """Standardised full address, street, street without numbers and, given reference cities, city."""
    street, city, state, zipcode = (F.col(c) for c in require_columns(df, columns).select(columns).columns)
    whole = text.full_address(street, city, state, zipcode)
    df = df.withColumns(
        {
            "standardized_address": text.standardize_full_address(whole, abbreviations, directions),
            "standardized_street_only": text.standardize_street(street, abbreviations, directions),
            "standardized_street_no_numbers": text.standardize_street_no_numbers(street, abbreviations, directions),
        }
    )
    if reference_cities is None:
        return df
    return standardize_city(df, columns[1], reference_cities, "standardized_city")


def add_name_columns(df: DataFrame, names: Mapping[str, tuple[str, bool]], abbreviations, lists) -> DataFrame:
    """``names``: new column -> (source column, remove spaces); ``lists``: directions, numbers, words, suffixes."""
    require_columns(df, [source for source, _ in names.values()])
    return df.withColumns(
        {
            new: text.standardize_business_name(F.col(source), abbreviations, *lists, remove_spaces=bare)
            for new, (source, bare) in names.items()
        }
    )
