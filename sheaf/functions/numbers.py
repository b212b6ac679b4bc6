"""Checks and replacements on number text (rows F5, F6, P6-P9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plain-decimal pattern (digits, a dot, digits; a lone dot passes; \z is
# the very end, where $ would let a line end through),
# the missing-value markers and their replacements.
PLAIN_DECIMAL = r"\A[0-9]*\.[0-9]*\z"
NEGATIVE_INFINITY_TEXT = "-Infinity"
ZERO_TEXT = "0.0"
NOT_AVAILABLE = "n/a"


def is_plain_decimal(text: Column) -> Column:
    """full match of the plain decimal pattern; NULL text is not a match."""
    return F.coalesce(text.rlike(PLAIN_DECIMAL), F.lit(False))


def is_blank(text: Column) -> Column:
    """An empty field; NULL (a field past the end of a short line) is not blank."""
    return F.coalesce(text == "", F.lit(False))


def blank_to(text: Column, replacement: str) -> Column:
    """Replace an empty field by a marker text."""
    return F.when(is_blank(text), F.lit(replacement)).otherwise(text)


def missing_to_zero(text: Column, blank_too: bool = False) -> Column:
    """``n/a`` (and, for the dividend, an empty field) becomes ``0.0``."""
    missing = text == NOT_AVAILABLE
    if blank_too:
        missing = missing | (text == "")
    return F.when(missing, F.lit(ZERO_TEXT)).otherwise(text)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def percent_growth(low: Column, high: Column) -> Column:
    """``(high - low) / low * 100``; NULL where low is 0 (the reference's Infinity/NaN)."""
    return F.try_divide(high - low, low) * F.lit(100.0)
