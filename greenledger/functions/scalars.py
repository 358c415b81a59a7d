"""Scalar column expressions shared by staging and cleaning.

All helpers return Catalyst expressions, so they stay inside whole-stage
codegen. Two concatenation flavours exist on purpose: SQL ``concat`` in the
factor sources skips NULL arguments, while ``||`` propagates NULL; which one
applies decides whether a later fallback (``coalesce``) fires.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source semantics for identical results)
# ---------------------------------------------------------------------------
# Open end of a validity interval. Spark has no infinite date; the last day of
# the DATE range stands in and is translated at a sink that has `infinity`.
OPEN_END = _dt.date(9999, 12, 31)
# Separator of the natural-key parts hashed into a surrogate key.
KEY_SEPARATOR = "|"
# A unit group that states kilograms: an opening parenthesis, then kgco2e,
# kgec or kgc, then a slash (matched on the lower-cased name).
KILOGRAM_UNIT_PATTERN = r"\(k(?:gco2e|ge?c)/"
# One trailing parenthesised group with the blanks around it.
TRAILING_GROUP_PATTERN = r"\s*\([^)]*\)\s*$"
# Kilograms to grams.
KG_TO_G = 1000.0


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts joined by ``|``; NULL parts are skipped.

    Numbers are stringified first, so an int id and its text form hash alike.
    """
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[as_col(p).cast("string") for p in parts]))


def concat_skip_nulls(*parts: str | Column) -> Column:
    """SQL ``concat`` of the factor sources: NULL arguments are skipped."""
    return F.concat_ws("", *[as_col(p) for p in parts])


def concat_nulls(*parts: str | Column) -> Column:
    """``||`` chaining: any NULL part makes the result NULL."""
    return F.concat(*[as_col(p) for p in parts])


def lower_first(c: str | Column) -> Column:
    """First character lower-cased, the rest unchanged (accent-safe)."""
    c = as_col(c)
    return F.concat(F.lower(F.substr(c, F.lit(1), F.lit(1))), F.substr(c, F.lit(2)))


def strip_trailing_group(c: str | Column) -> Column:
    """Remove one trailing ``(...)`` group and the blanks around it."""
    return F.regexp_replace(as_col(c), TRAILING_GROUP_PATTERN, "")


def is_kilogram_unit(c: str | Column) -> Column:
    """True when the name carries a kilogram unit group such as ``(kgeC/``."""
    return F.lower(as_col(c)).rlike(KILOGRAM_UNIT_PATTERN)


def scale_if_kilogram(value: str | Column, name: str | Column) -> Column:
    """Value x1000 when ``name`` states kilograms, else unchanged."""
    value = as_col(value)
    return F.when(is_kilogram_unit(name), value * KG_TO_G).otherwise(value)


def round3_then_grams(c: str | Column) -> Column:
    """Round kilograms to 3 decimals, then convert to grams.

    Rounding scales first (x*1000 rounded half away from zero, then /1000);
    ``F.round(c, 3)`` rounds the decimal text instead and differs on
    half-way doubles such as 2.0035.
    """
    c = as_col(c)
    return F.round(c * 1000.0) / 1000.0 * KG_TO_G


def year_start(year: str | Column) -> Column:
    return F.make_date(as_col(year), F.lit(1), F.lit(1))


def year_end(year: str | Column) -> Column:
    return F.make_date(as_col(year), F.lit(12), F.lit(31))


def open_end() -> Column:
    return F.lit(OPEN_END)


def _chars(*codes: int) -> str:
    return "".join(map(chr, codes))


# Every character that counts as white space in a blank value.
WHITE_SPACE = _chars(*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
NON_BLANK_PATTERN = f"[^{WHITE_SPACE}]"


def blank_to_null(c: str | Column) -> Column:
    """Blank or all-whitespace text becomes NULL; other values unchanged."""
    c = as_col(c)
    return F.when(c.rlike(NON_BLANK_PATTERN), c)


def empty_to_null(c: str | Column) -> Column:
    """Empty text becomes NULL; white space is a value."""
    c = as_col(c)
    return F.when(c != "", c)


def non_blank(c: str | Column) -> Column:
    """True when the text is present and not only whitespace (NULL-safe)."""
    return F.coalesce(as_col(c).rlike(NON_BLANK_PATTERN), F.lit(False))
