"""Access into map, array and struct columns (rows X14-X16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_value(m: Column, key: str) -> Column:
    """Value under ``key`` (case-sensitive); a missing key gives NULL."""
    return F.try_element_at(m, F.lit(key))


def array_item(arr: Column, index: int) -> Column:
    """Zero-based element; out of range gives NULL."""
    return F.get(arr, index)


def struct_field(s: Column, name: str) -> Column:
    """One field of a struct."""
    return s.getField(name)
