"""Sinks (rows K1-K4): tuple text, ``key<TAB>value`` text, a fresh path per run, and
hashed or sorted output layouts."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The partition column of a dated table.
DATED = "dated"


def run_path(base: str, millis: int | None = None) -> str:
    """K3: ``base_<epoch millis>``, a new output folder for every run."""
    return f"{base}_{int(time.time() * 1000) if millis is None else millis}"


def _text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit("null"))


def tuple_text(*cols: str | Column) -> Column:
    """K1: ``(a,b,...)``; a nested tuple is rendered by passing ``tuple_text(...)``."""
    return F.concat(F.lit("("), F.concat_ws(",", *[_text(c) for c in cols]), F.lit(")"))


def tab_text(key: str | Column, value: str | Column) -> Column:
    """K2: ``key<TAB>value``."""
    return F.concat_ws("\t", _text(key), _text(value))


def hashed_sorted(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``parts`` hash parts on ``key`` (by default as many as the session has shuffle
    partitions), each sorted by ``key``."""
    dealt = df.repartition(key) if parts is None else df.repartition(parts, key)
    return dealt.sortWithinPartitions(key)


def write_key_ranges(lines: Column, df: DataFrame, key: str, path: str, parts: int | None = None) -> None:
    """K4: parts by ranges of ``key``, each sorted; their files in name order are one run.
    ``parts`` sets their number (fewer where there are fewer keys)."""
    ranged = df.repartitionByRange(key) if parts is None else df.repartitionByRange(parts, key)
    ranged.sortWithinPartitions(key).select(lines.alias("value")).write.mode("errorifexists").text(path)


def write_lines(lines: Column, df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one text line per row (``part-*`` files, one per partition)."""
    df.select(lines.alias("value")).write.mode(mode).text(path)


def write_dated(df: DataFrame, stamp: str, path: str, unit: str = "day", mode: str = "errorifexists") -> None:
    """A table partitioned by the ``unit`` ("day", "month" or "year") of the time ``stamp``.

    Rows of one partition meet in few files: the rebalance gathers small days and splits a day
    that holds much of the table over several tasks, by their measured sizes."""
    dated = df.withColumn(DATED, F.date_trunc(unit, F.col(stamp)).cast("date"))
    dated.hint("rebalance", DATED).write.partitionBy(DATED).mode(mode).parquet(path)


def read_dated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written by ``write_dated``, of columns ``schema`` and its partition column."""
    return spark.read.schema(f"{schema}, {DATED} DATE").parquet(path)


def write_sorted_lines(lines: Column, df: DataFrame, order: list[str | Column], path: str) -> None:
    """Globally sorted text output: a range-partitioned sort over all tasks, whose part
    files in name order are one sorted run."""
    df.orderBy(*order).select(lines.alias("value")).write.mode("errorifexists").text(path)
