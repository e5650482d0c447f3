"""Standardisers for addresses and business names, all as Catalyst expressions."""

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinlink.functions.cast import strip

# Word lists.
DIRECTIONS = {
    "NORTH": "N",
    "SOUTH": "S",
    "EAST": "E",
    "WEST": "W",
    "NORTHEAST": "NE",
    "NORTHWEST": "NW",
    "SOUTHEAST": "SE",
    "SOUTHWEST": "SW",
}
NUMBER_WORDS = {
    "1ST": "FIRST",
    "2ND": "SECOND",
    "3RD": "THIRD",
    "4TH": "FOURTH",
    "5TH": "FIFTH",
    "6TH": "SIXTH",
    "7TH": "SEVENTH",
    "8TH": "EIGHTH",
    "9TH": "NINTH",
    "10TH": "TENTH",
    "1": "ONE",
    "2": "TWO",
    "3": "THREE",
    "4": "FOUR",
    "5": "FIVE",
    "6": "SIX",
    "7": "SEVEN",
    "8": "EIGHT",
    "9": "NINE",
    "10": "TEN",
}
COMMON_WORDS = ["THE", "OF", "AND", "IN", "FOR"]
LEGAL_SUFFIXES = ["INC", "LLC", "LTD", "CORP", "INCORPORATED", "LIMITED"]

# What a street loses in its number-free form, in this order.
STREET_NUMBER_PATTERNS = [
    r"\b(STE|FL|OFC)\.?\s+\d+\w*",
    r"\b(SUITE|FLOOR|OFFICE)\s+\d+\w*",
    r"^\d+(-\d+)?\s+",
    r"\bUNIT\s+\d+\w*",
    r"#\s*\d+\w*",
]

_WORD = re.compile(r"\w+")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _literal_map(pairs: Mapping[str, str]) -> Column:
    """A constant map; one string literal, as hundreds of single literals are slow to build."""
    text = "\x1e".join(f"{word}\x1f{value}" for word, value in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def _through_map(c: Column, pairs: Mapping[str, str]) -> Column:
    """Replace every whole word that is a key, in one pass over the words."""
    if not pairs:
        return c
    table = _literal_map(pairs)
    words = F.split(c, r"(?U)\b", -1)
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w)), "")


def _follow(steps: list[tuple[str, str, bool]]) -> dict[str, str]:
    """Result of applying one-word replacements in order, per starting word."""
    result = {}
    for start in dict.fromkeys(word for word, _, _ in steps):
        current, padded = start, False
        for word, value, pad in steps:
            if word == current:
                current, padded = value, padded or pad
        result[start] = f" {current} " if padded else current
    return result


def replace_words(c: Column, steps: Iterable[tuple[str, str, bool]]) -> Column:
    """Whole-word replacements ``(word, value, pad)`` applied in order.

    A run of one-word entries costs one map look-up per word however long it is; an entry with spaces or
    punctuation keeps its place in the order as a regular expression.
    """
    run: list[tuple[str, str, bool]] = []
    for word, value, pad in steps:
        if not word:
            continue
        if _WORD.fullmatch(word) and _WORD.fullmatch(value):
            run.append((word, value, pad))
            continue
        c, run = _through_map(c, _follow(run)), []
        plain = value.replace("\\", "\\\\").replace("$", "\\$")
        c = F.regexp_replace(c, rf"(?U)\b{re.escape(word)}\b", f" {plain} " if pad else plain)
    return _through_map(c, _follow(run))


def _any_word(words: Iterable[str]) -> str:
    listed = "|".join(re.escape(w) for w in sorted(w for w in words if w))
    return rf"(?U)\b(?:{listed})\b"


def remove_words(c: Column, words: Iterable[str]) -> Column:
    words = [w for w in words if w]
    return F.regexp_replace(c, _any_word(words), "") if words else c


def standardize_text(c: Column, abbreviations: Mapping[str, str], directions: Mapping[str, str] = DIRECTIONS) -> Column:
    """Common address form: upper case, no leading bracket note, no dots, short directions and street words."""
    c = F.regexp_replace(F.upper(c), r"^(?U)\s*\([^)]*\)\s*", "")
    c = F.regexp_replace(c, r"\.+", " ")
    steps = [(w, v, False) for w, v in directions.items()] + [(w, v, True) for w, v in abbreviations.items()]
    return squeeze(F.replace(replace_words(c, steps), F.lit("."), F.lit("")))


def standardize_full_address(
    c: Column,
    abbreviations: Mapping[str, str],
    directions: Mapping[str, str] = DIRECTIONS,
    preserve_commas: bool = False,
) -> Column:
    c = standardize_text(c, abbreviations, directions)
    return c if preserve_commas else F.replace(c, F.lit(","), F.lit(""))


def standardize_street(
    c: Column, abbreviations: Mapping[str, str], directions: Mapping[str, str] = DIRECTIONS
) -> Column:
    return standardize_text(c, abbreviations, directions)


def standardize_street_no_numbers(
    c: Column, abbreviations: Mapping[str, str], directions: Mapping[str, str] = DIRECTIONS
) -> Column:
    c = standardize_street(c, abbreviations, directions)
    for pattern in STREET_NUMBER_PATTERNS:
        c = F.regexp_replace(c, f"(?U){pattern}", "")
    return squeeze(c)


def full_address(street: Column, city: Column, state: Column, zipcode: Column) -> Column:
    """``street, city, state zip`` without the parts that are null."""
    tail = F.nullif(F.concat_ws(" ", state, zipcode), F.lit(""))
    return F.concat_ws(", ", street, city, tail)


def replace_number_words(c: Column, numbers: Mapping[str, str] = NUMBER_WORDS) -> Column:
    return _through_map(c, numbers)


def separate_suffix(c: Column, suffixes: Iterable[str] = LEGAL_SUFFIXES) -> Column:
    """``ACMEINC`` to ``ACME INC``, longest suffix first."""
    for suffix in sorted((s for s in suffixes if s), key=lambda s: (-len(s), s)):
        c = F.regexp_replace(c, rf"(?U)(\w+)({re.escape(suffix)})(?!\w)", "$1 $2")
    return c


def remove_common_words(c: Column, words: Iterable[str] = COMMON_WORDS) -> Column:
    return squeeze(remove_words(c, words))


def standardize_business_name(
    c: Column,
    abbreviations: Mapping[str, str],
    directions: Mapping[str, str] = DIRECTIONS,
    numbers: Mapping[str, str] = NUMBER_WORDS,
    common_words: Iterable[str] = COMMON_WORDS,
    suffixes: Iterable[str] = LEGAL_SUFFIXES,
    remove_spaces: bool = False,
) -> Column:
    suffixes = list(suffixes)
    c = separate_suffix(replace_number_words(F.upper(c), numbers), suffixes)
    c = remove_words(c, suffixes)
    c = replace_words(c, [(w, v, False) for w, v in [*directions.items(), *abbreviations.items()]])
    c = remove_common_words(c, common_words)
    c = squeeze(F.regexp_replace(c, r"(?U)[^0-9A-Z\s]", ""))
    return F.replace(c, F.lit(" "), F.lit("")) if remove_spaces else c


def preprocess(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))
