"""Retail questions over customers, products, order items and orders (rows F7-F13,
J4, J5, A9-A15, O6, O7, X8-X13, D8, D9, D12-D14).

Each is a plain DataFrame plan. Aggregations are partial + final; a join feeding a
group-by is preceded by an aggregate of the large side, so the join sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.dates import (
    day_of_epoch,
    next_midnight,
    on_day,
    on_or_before,
    on_or_before_lexical,
    partition_of,
    partitions_until,
    stamped_on,
    stamped_until,
    until_epoch,
)
from sheaf.functions.money import cents, limbs, merged_cents
from sheaf.sources.sinks import DATED

MONEY = "decimal(38,2)"


def like_and_equals(df: DataFrame, like_col: str, pattern: str, eq_col: str, value) -> DataFrame:
    """``like_col LIKE pattern AND eq_col = value`` (both pushed to the scan)."""
    return df.filter(F.col(like_col).like(pattern) & (F.col(eq_col) == F.lit(value)))


def equals_value(df: DataFrame, column: str, value=0) -> DataFrame:
    """F8: rows where a number equals ``value``."""
    return df.filter(F.col(column) == F.lit(value))


def count_column(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``count(column)``, NULLs skipped."""
    return df.agg(F.count(F.col(column)).alias(alias))


def count_distinct_concat(df: DataFrame, columns: list[str], alias: str) -> DataFrame:
    """Distinct values of the concatenated columns; a NULL part makes the whole
    value NULL, which is not counted (D13)."""
    return df.agg(F.count_distinct(F.concat(*[F.col(c).cast("string") for c in columns])).alias(alias))


def group_count_ranked(df: DataFrame, group: str, counted: str, alias: str = "n") -> DataFrame:
    """Count per group, largest first, ties by group."""
    return df.groupBy(group).agg(F.count(F.col(counted)).alias(alias)).orderBy(F.col(alias).desc(), F.col(group))


def group_count_ranked_named(
    facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str, name: str, counted: str, alias: str = "n"
) -> DataFrame:
    """A11/O6 through a join: ``count(counted)`` per dimension name, largest first.

    Facts are counted per key before the join and the counts re-added per name after it
    (equal to join-then-group), so the join moves one row per key; joining every fact
    row on a key with few values would send all of them to as many reducers."""
    per_key = facts.groupBy(fact_key).agg(F.count(F.col(counted)).alias("_n"))
    joined = per_key.join(dims.select(F.col(dim_key).alias(fact_key), name), fact_key, "inner")
    return (
        joined.groupBy(name)
        .agg(F.sum("_n").alias(alias))
        .orderBy(F.col(alias).desc(), F.col(name))
    )


def _limb_sums(value: str) -> list[Column]:
    """Exact sums of amounts as two longs per group, in whole cents; a DECIMAL buffer
    would be rebuilt for every row. They are merged once, after the last aggregation."""
    high, low = limbs(cents(F.col(value)))
    return [F.sum(high).alias("_high"), F.sum(low).alias("_low")]


def _with_sum(df: DataFrame, alias: str) -> DataFrame:
    return df.withColumn(alias, merged_cents(F.col("_high"), F.col("_low"))).drop("_high", "_low")


def top_sum(df: DataFrame, key: str, value: str, k: int, alias: str) -> DataFrame:
    """Exact sum per key (a DECIMAL, whatever the order of the rows), the ``k``
    largest, ties by key."""
    return _with_sum(df.groupBy(key).agg(*_limb_sums(value)), alias).orderBy(F.col(alias).desc(), F.col(key)).limit(k)


def top_sum_named(
    facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str, name: str, value: str, k: int, alias: str
) -> DataFrame:
    """Sum of ``value`` per (key, name) after joining the names, top ``k``.

    The facts are summed per key before the join and the partial sums re-added per
    (key, name) after it, which equals join-then-group for any multiplicity of the
    key in ``dims`` and joins one row per key instead of every fact row."""
    per_key = facts.groupBy(fact_key).agg(*_limb_sums(value))
    joined = per_key.join(dims.select(F.col(dim_key).alias(fact_key), name), fact_key, "inner")
    added = joined.groupBy(fact_key, name).agg(F.sum("_high").alias("_high"), F.sum("_low").alias("_low"))
    return _with_sum(added, alias).orderBy(F.col(alias).desc(), F.col(fact_key), F.col(name)).limit(k)


def _count_where(df: DataFrame, predicate: Column, counted: str, alias: str) -> DataFrame:
    return df.filter(predicate).agg(F.count(F.col(counted)).alias(alias))


def count_until_lexical(orders: DataFrame, status: str, day: str, alias: str = "n_orders") -> DataFrame:
    """The date text compared as text (the reference's "wrong query", D8)."""
    pred = on_or_before_lexical(F.col("order_datestr"), day) & (F.col("order_status") == status)
    return _count_where(orders, pred, "order_id", alias)


def _stamped(orders: DataFrame, predicate, text_predicate) -> Column:
    """The day bound on the stored time where the rows have it, else on the date text."""
    return predicate(F.col("order_ts")) if "order_ts" in orders.columns else text_predicate(F.col("order_datestr"))


def count_until(orders: DataFrame, status: str, day: str, alias: str = "n_orders") -> DataFrame:
    """The day on or before ``day``. Rows with the stored time ``order_ts`` are bounded
    on it, so the bound reaches the scan; date text (``order_datestr``) is parsed."""
    until = _stamped(orders, lambda c: stamped_until(c, day), lambda c: on_or_before(c, day))
    return _count_where(orders, (F.col("order_status") == status) & until, "order_id", alias)


def count_until_epoch(orders: DataFrame, status: str, seconds: int, alias: str = "n_orders") -> DataFrame:
    """The day compared in seconds since the epoch: those whose midnight is not after
    ``seconds``."""
    until = _stamped(orders, lambda c: stamped_until(c, day_of_epoch(seconds)), lambda c: until_epoch(c, seconds))
    return _count_where(orders, (F.col("order_status") == status) & until, "order_id", alias)


def count_on(orders: DataFrame, status: str, day: str, alias: str = "n_orders") -> DataFrame:
    """orders on ``day`` itself (what the question asks)."""
    on = _stamped(orders, lambda c: stamped_on(c, day), lambda c: on_day(c, day))
    return _count_where(orders, (F.col("order_status") == status) & on, "order_id", alias)


def read_dated_until(dated: DataFrame, stamp: str, day: str, unit: str = "day") -> DataFrame:
    """F11 on a table written by ``sinks.write_dated``: only its partitions until ``day`` are
    listed and read."""
    return dated.filter(partitions_until(F.col(DATED), day, unit) & stamped_until(F.col(stamp), day))


def read_dated_on(dated: DataFrame, stamp: str, day: str, unit: str = "day") -> DataFrame:
    """F12 on a table written by ``sinks.write_dated``: one partition is read."""
    return dated.filter(partition_of(F.col(DATED), day, unit) & stamped_on(F.col(stamp), day))


def semi_join_revenue(
    items: DataFrame, orders: DataFrame, item_order_key: str, amount: str, status: str, day: str, alias: str = "revenue"
) -> DataFrame:
    """Exact sum of ``amount`` over items whose order has ``status`` and
    a day on or before ``day``. The day is bounded on the stored date ``order_ts``, so the
    bound reaches the scan. Joined on the order key (D9) as a left semi-join: an item is
    kept once however its order matches; the order side is only keys."""
    keys = orders.filter((F.col("order_status") == status) & (F.col("order_ts") < next_midnight(day))).select(
        F.col("order_id").alias(item_order_key)
    )
    kept = items.join(keys, item_order_key, "left_semi")
    return _with_sum(kept.agg(*_limb_sums(amount)), alias)


def as_dollars(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``$<amount>`` with two decimals, from the decimal's own digits."""
    return df.select(F.concat(F.lit("$"), F.col(column).cast(MONEY).cast("string")).alias(alias))


def date_part_counts(orders: DataFrame, alias: str = "n_orders") -> DataFrame:
    """X11: orders per year, month and day of the parsed date text."""
    d = F.substring(F.col("order_datestr"), 1, 10).try_cast("date")
    return (
        orders.select(F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"))
        .groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias(alias))
    )
