"""Money text such as ``$10.5M``, ``$1500``, ``$2B`` or ``n/a`` (rows P5, F2, F3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

# Fixed values of the listing format.
NO_INFO = "n/a"
MILLIONS = "M"
BILLIONS = "B"
DOLLAR = "$"

CAP_TYPE = DecimalType(38, 2)


def _digits(text: Column) -> tuple[Column, Column]:
    plain = F.replace(text, F.lit(DOLLAR), F.lit(""))
    in_millions = plain.contains(MILLIONS)
    return F.when(in_millions, F.replace(plain, F.lit(MILLIONS), F.lit(""))).otherwise(plain), in_millions


def money_value(text: Column) -> Column:
    """Exact value as DECIMAL(38,2): drop ``$``; a text holding ``M`` is in millions.

    The digits keep ten decimals until they have been multiplied; the value is rounded to
    cents once, at the end. Text that does not parse (``n/a``, ``$2B``, garbage) gives NULL
    instead of an error.
    """
    digits, in_millions = _digits(text)
    value = digits.try_cast(DecimalType(28, 10))
    return F.when(in_millions, value * F.lit(1000000)).otherwise(value).cast(CAP_TYPE)


def money_double(text: Column) -> Column:
    """The same parse in binary floating point, as the RDD screener computes it."""
    digits, in_millions = _digits(text)
    value = digits.try_cast(DoubleType())
    return F.when(in_millions, value * F.lit(1000000.0)).otherwise(value)


def keep_cap_by_substring(text: Column) -> Column:
    """the cap text holds neither ``B`` nor ``n/a``."""
    return ~text.contains(BILLIONS) & ~text.contains(NO_INFO)


def keep_cap_by_suffix(text: Column) -> Column:
    """the cap text is not ``n/a`` and does not end in ``B``."""
    return (text != NO_INFO) & ~text.endswith(BILLIONS)


def truncated_float_long(value: Column) -> Column:
    """The value cut to a 32-bit float, then truncated to a long."""
    return value.cast("float").cast("bigint")


# Bits of the low limb of a sum of cents. Its sums fit a long up to 2**39 rows a group, those of
# the high limb up to 2**87 cents; beyond that the sum is an error, never a wrong number.
LIMB_BITS = 24


def cents(amount: Column) -> Column:
    """A floating-point amount in whole cents, as a DECIMAL with two places rounds it. The
    product is exact enough but close to half a cent and beyond 2**50, where the DECIMAL decides."""
    scaled = amount * F.lit(100.0)
    whole = F.round(scaled)
    unsure = (F.abs(F.abs(scaled - whole) - F.lit(0.5)) < F.lit(1e-3)) | (F.abs(scaled) > F.lit(2.0**50))
    exact = (amount.cast(DecimalType(18, 2)) * F.lit(100)).cast("bigint")
    return F.when(unsure, exact).otherwise(whole.cast("bigint"))


def limbs(whole: Column) -> tuple[Column, Column]:
    """A long as (high, low): ``high * 2**LIMB_BITS + low``, low not negative."""
    return F.shiftright(whole, LIMB_BITS), whole.bitwiseAND(F.lit((1 << LIMB_BITS) - 1).cast("bigint"))


def merged_cents(high: Column, low: Column) -> Column:
    """The DECIMAL amount of summed limbs of cents; NULL if there were none."""
    total = high.cast("decimal(20,0)") * F.lit(1 << LIMB_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    return (total.cast("decimal(34,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(CAP_TYPE)
