"""Column functions for casts, default values and keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = r"^[+-]?\d+$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Street texts that stand for "no address".
PLACEHOLDER_STREETS = ["STATE OF PA", "STATE OF DE", "PA", "DE", "NO SPECIFIC LOCATION"]
MISSING_TEXT = "MISSING"
MISSING_ZIP = "99999"
MISSING_TAX_ID = "000000000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def as_integer(c: Column, strict: bool = True) -> Column:
    """Nullable BIGINT; text that is no number becomes null, a fraction raises (or is null if not strict)."""
    text = strip(c.cast("string"))
    number = F.when(text.rlike(DECIMAL), text.try_cast("double"))
    if strict:
        message = F.concat(F.lit("not a whole number: "), text)
        fraction = F.raise_error(message).cast("bigint")
    else:
        fraction = F.lit(None).cast("bigint")
    return (
        F.when(text.rlike(WHOLE), text.try_cast("bigint"))
        .when(number == F.floor(number), number.try_cast("bigint"))
        .when(number.isNotNull(), fraction)
    )


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(r"^(?U)\s*$"), c)


def as_text(c: Column) -> Column:
    return c.cast("string")


def zip5(c: Column) -> Column:
    """First run of five digits, null if there is none."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"(\d{5})", 1), F.lit(""))


def tax_id(c: Column, strict: bool = True) -> Column:
    """Digits of a tax id as BIGINT; blank or null gives 0, other characters raise (or null if not strict)."""
    compact = F.regexp_replace(c, r"(?U)[\s-]+", "")
    digits = F.coalesce(F.nullif(compact, F.lit("")), F.lit(MISSING_TAX_ID))
    number = digits.try_cast("bigint")
    if not strict:
        return number
    message = F.concat(F.lit("not a tax id: "), digits)
    return F.when(number.isNull(), F.raise_error(message).cast("bigint")).otherwise(number)


def fill_default(c: Column, value: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(value))


def replace_placeholder(c: Column, value: str = MISSING_TEXT) -> Column:
    return F.when(c.isin(PLACEHOLDER_STREETS), F.lit(value)).otherwise(c)


def composite_key(tax: Column, street: Column) -> Column:
    return F.concat(tax.cast("string"), F.lit("_"), F.coalesce(street, F.lit("")))


def match_key(c: Column) -> Column:
    return strip(F.upper(c))
