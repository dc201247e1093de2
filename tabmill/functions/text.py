"""Text expressions: keys, clean-up, number extraction. All are plain Columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for a missing entry in url-like columns.
BLANK_TOKENS = ("nan", "NaN", "None", "NULL", "null", " ", "  ")

# The texts a delimited-file reader takes for a missing cell.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# All characters that count as white space at the ends of a text.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def text_or_nan(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("nan"))


def strip(c: Column) -> Column:
    """Drop all kinds of white space at both ends, not only the space."""
    return F.btrim(c, F.lit(SPACES))


def clean_key(c: Column) -> Column:
    return F.btrim(F.regexp_replace(text_or_nan(c), "[ .,_]+", "_"), F.lit("_"))


def composite_key(cols: Iterable[Column]) -> Column:
    return F.concat_ws("_", *[clean_key(c) for c in cols])


def normal_text(c: Column) -> Column:
    return strip(F.lower(text_or_nan(c)))


def blank_to_empty(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull() | text.isin(*BLANK_TOKENS), F.lit("")).otherwise(text)


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TOKENS), c)


def contains_any_case(c: Column, part: str) -> Column:
    return F.coalesce(F.lower(c.cast("string")).contains(part), F.lit(False)).cast("int")


def in_any_case(c: Column, values: Iterable[str]) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin(*values), F.lit(False)).cast("int")


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number gives null."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def is_number(c: Column) -> Column:
    return c.cast("string").rlike(NUMBER)


def first_integer(c: Column) -> Column:
    digits = F.regexp_extract(c.cast("string"), "([0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def first_decimal(c: Column) -> Column:
    digits = F.regexp_extract(c.cast("string"), r"([0-9]+\.[0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def thousands(c: Column, digits: int = 0) -> Column:
    return F.format_number(c, digits)


def range_label(low: float, high: float) -> str:
    return f"{low:,} - {high:,}"
