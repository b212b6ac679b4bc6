"""The nested loyalty table: map, array and struct access, column rename
(rows F9, X14-X16, T2, T5; T3 is ``catalog.describe_table``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.nested import array_item, map_value, struct_field


def _rows(df: DataFrame, key: str, key_value) -> DataFrame:
    """all rows, or the rows of one key."""
    return df if key_value is None else df.filter(F.col(key) == F.lit(key_value))


def lookup_map(df: DataFrame, map_col: str, map_key: str, alias: str, key: str = "cust_id", key_value=None) -> DataFrame:
    """``key, map_col[map_key]``; missing keys (case-sensitive) give NULL."""
    return _rows(df, key, key_value).select(key, map_value(F.col(map_col), map_key).alias(alias))


def lookup_array(df: DataFrame, arr_col: str, index: int, alias: str, key: str = "cust_id", key_value=None) -> DataFrame:
    """``key, arr_col[index]``, zero-based; out of range gives NULL."""
    return _rows(df, key, key_value).select(key, array_item(F.col(arr_col), index).alias(alias))


def lookup_struct(df: DataFrame, struct_col: str, field: str, alias: str, key: str = "cust_id", key_value=None) -> DataFrame:
    """``key, struct_col.field``."""
    return _rows(df, key, key_value).select(key, struct_field(F.col(struct_col), field).alias(alias))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """The column under a new name; the data is not rewritten (a projection)."""
    return df.withColumnRenamed(old, new)
