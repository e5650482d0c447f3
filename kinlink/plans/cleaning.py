"""The cleaning job of both tables. Lazy throughout, but for the reference cities' look-up."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators import standardize as s
from kinlink.operators.survivorship import keep_best_codes, keep_first
from kinlink.plans.settings import Settings
from kinlink.schema import LEFT_INTEGER, LEFT_TEXT, RIGHT_INTEGER, RIGHT_TEXT

LEFT_ADDRESS = ["StreetAddress", "City", "State", "Zipcode"]
RIGHT_ADDRESS = ["physical_street_address", "physical_city", "physical_state_abbreviation", "physical_zip"]
NAME, BARE_NAME = "standardized_business_name_with_spaces", "standardized_business_name_no_spaces"
PARENT = "standardized_global_ultimate_name_with_spaces"


def standardize_left(left: DataFrame, reference_cities: DataFrame, settings: Settings) -> DataFrame:
    """Everything but survivorship: one row out per row in."""
    strings = [c for c in LEFT_TEXT if c in left.columns or c != "StreetAddress_Rev"]
    df = s.fill_left_values(s.cast_left(left, LEFT_INTEGER, strings, settings.strict), settings.strict)
    df = s.add_address_columns(df, LEFT_ADDRESS, settings.abbreviations, settings.directions, reference_cities)
    df = s.add_composite_key(df, "FEIN_Address", "PrimaryFEIN", "standardized_street_only")
    names = {NAME: ("PrimaryInsuredName", False), BARE_NAME: ("PrimaryInsuredName", True)}
    return s.add_name_columns(df, names, settings.abbreviations, settings.name_lists)


def survivors(standardized: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows kept by the address code rule, and of these the first per tax id and street."""
    coded = keep_best_codes(
        standardized, missing_ids=settings.missing_ids, keep_uncoded=settings.keep_uncoded
    )
    return coded, keep_first(coded, ["FEIN_Address"])


def standardize_right(right: DataFrame, settings: Settings) -> DataFrame:
    df = s.cast_right(right, RIGHT_INTEGER, RIGHT_TEXT, settings.strict)
    df = s.add_address_columns(df, RIGHT_ADDRESS, settings.abbreviations, settings.directions)
    names = {
        NAME: ("business_name", False),
        BARE_NAME: ("business_name", True),
        PARENT: ("global_ultimate_name", False),
    }
    return s.add_name_columns(df, names, settings.abbreviations, settings.name_lists)


def reference_cities(right: DataFrame) -> DataFrame:
    return right.select(F.col("physical_city").cast("string")).distinct()
