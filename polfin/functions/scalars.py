"""Scalar expressions shared by the marts, dimensions and checks.

Every function takes and returns a ``Column`` made of built-in expressions, so
plans stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
YEAR_SUFFIX_LENGTH = 4
FEC_PREFIXES = ("H", "S")
FEDERAL_SEAT_PREFIXES = ("federal:", "president", "senate", "house")
PARTY_NAMES = {100: "Democrat", 200: "Republican", 328: "Independent"}
CAST_NAMES = {
    1: "Yea",
    2: "Paired Yea",
    3: "Announced Yea",
    4: "Announced Nay",
    5: "Paired Nay",
    6: "Nay",
    7: "Present (not voting)",
    8: "Present (Abstain)",
    9: "Not in legislature",
}
CONTRIBUTOR_TYPE_NAMES = {
    "C": "Committee",
    "L": "Corporation",
    "O": "Organization",
    "U": "Union",
    "P": "PAC",
}
EXPORT_BLANK_WORDS = ("nan",)
PLAIN_BLANK_WORDS = ("nan", "n/a", "na", "null")
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

VALUE_TOLERANCE = 1e-6
SUM_TOLERANCE = 0.01


def filled(col: Column) -> Column:
    """True when the text is neither NULL nor empty."""
    return col.isNotNull() & (col != "")


def has_year_suffix(col: Column) -> Column:
    """True when the id is long enough to carry a year behind it."""
    return F.length(col) > YEAR_SUFFIX_LENGTH


def strip_year(col: Column) -> Column:
    """Id without its four-digit year; ids of four characters or fewer give ''."""
    text = col.cast("string")
    return F.substring(text, F.lit(1), F.length(text) - YEAR_SUFFIX_LENGTH)


def starts_with_any(col: Column, prefixes: Iterable[str]) -> Column:
    tests = [col.startswith(p) for p in prefixes]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def is_fec_style(col: Column) -> Column:
    """True for ids issued to House and Senate candidates."""
    return starts_with_any(col, FEC_PREFIXES)


def whole_iso_date(col: Column) -> Column:
    """Date from text that is an ISO date and nothing else, NULL otherwise.

    A cast alone would also take '2020' or '2020-1-3', and parsing by a format
    raises and catches an exception for every bad value.
    """
    return F.when(col.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), col.try_cast("date"))


def iso_date(col: Column) -> Column:
    """Date from the first ten characters of ISO text, NULL when invalid."""
    return whole_iso_date(F.substring(col, 1, 10))


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in candidates])


def split_ids(col: Column) -> Column:
    """Comma-separated text as an array; NULL and '' give an empty array."""
    empty = F.array().cast("array<string>")
    return F.when(filled(col), F.split(col, ",", -1)).otherwise(empty)


def non_empty_array(col: Column) -> Column:
    return col.isNotNull() & (F.size(col) > 0)


def to_bigint(col: Column) -> Column:
    """Whole number from text, a fraction being rounded; NULL where the text is no number or out of range."""
    return F.coalesce(col.try_cast("bigint"), F.round(col.try_cast("decimal(38,10)")).try_cast("bigint"))


def blank_to_null(col: Column, markers: Iterable[str]) -> Column:
    """NULL where the raw text is one of a source's null markers."""
    return F.when(col.isin(*markers), F.lit(None)).otherwise(col)


def strip(col: Column) -> Column:
    """Text without blanks at its ends.

    Trimming a set of characters is slow, so it is left to the few texts that
    start or end with one of them.
    """

    last = F.substring(col, -1, 1)
    ragged = (col < "!") | (last < "!")  # up to a space; bytes are compared
    for blank in ("\x85", "\xa0"):
        ragged = ragged | col.startswith(blank) | (last == blank)
    return F.when(ragged, F.btrim(col, F.lit(WHITESPACE))).otherwise(col)


def normal_text(col: Column, markers: Iterable[str] = ("",), words: Iterable[str] = PLAIN_BLANK_WORDS) -> Column:
    """Text ready for comparison: markers and null words become NULL, blanks are trimmed."""
    return normal_stripped(col, strip(col), markers, words)


def normal_stripped(col: Column, trimmed: Column, markers: Iterable[str], words: Iterable[str]) -> Column:
    """The same from a text and what ``strip`` made of it, which a column of its own computes but once."""
    words = list(words)
    short = F.octet_length(trimmed) <= max(len(w) for w in words)
    no_value = col.isin(*markers) | (short & F.lower(trimmed).isin(*words))
    return F.when(~no_value, trimmed)


def normal_number(col: Column) -> Column:
    """Number ready for comparison: NaN becomes NULL, six decimals are kept."""
    return F.when(~F.isnan(col), F.round(col, 6) + F.lit(0.0))


def same_value(a: Column, b: Column) -> Column:
    """NULL-safe equality with a numeric tolerance when both sides are numbers.

    A NaN parsed from text (a person may be called "Nan") never counts as a
    number, so such values are compared as text.
    """
    x, y = a.try_cast("double"), b.try_cast("double")
    both_numbers = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    as_numbers = F.coalesce(F.abs(x - y) < VALUE_TOLERANCE, F.lit(False)) | (x == y)
    as_text = a.cast("string").eqNullSafe(b.cast("string"))
    return F.when(both_numbers, as_numbers).otherwise(as_text)


def within_relative(actual: Column, expected: Column) -> Column:
    """Within one cent or a millionth of the expected value, whichever is larger."""
    allowed = F.greatest(F.lit(SUM_TOLERANCE), F.abs(expected) * VALUE_TOLERANCE)
    return F.abs(actual - expected) <= allowed


def within_cent(actual: Column, expected: Column) -> Column:
    return F.abs(actual - expected) <= SUM_TOLERANCE


def without_nan(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def percent(part: Column, total: Column) -> Column:
    """part / total x 100, and 0 for an empty total."""
    return F.when(total > 0, part * 100.0 / total).otherwise(F.lit(0.0))


def decode(code: Column, names: Mapping) -> Column:
    """Readable name of a code, NULL for codes outside the table."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in names.items())
    return F.try_element_at(F.create_map(*pairs), code)


def party_name(code: Column) -> Column:
    return decode(code.cast("int"), PARTY_NAMES)


def cast_name(code: Column) -> Column:
    return decode(code.cast("int"), CAST_NAMES)


def contributor_type_name(code: Column) -> Column:
    return decode(code, CONTRIBUTOR_TYPE_NAMES)
