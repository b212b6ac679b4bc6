"""Two-file join on the symbol with growth and top-10 lists (rows S7, J1-J3, P8, P9,
O3-O5, K5, K6, D7, D14, D15).

Both inputs are keyed by ``symbol``. The join is a plain inner equi-join: Spark
broadcasts a side only when its measured size is under the session threshold, and
otherwise shuffles both sides on the key (a side already hash-partitioned on the key,
such as a per-symbol aggregate, is not shuffled again). Top lists use ``limit`` after
``orderBy``, which plans as a per-task top-k and a merge, not a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sheaf.functions.numbers import missing_to_zero, percent_growth, to_double
from sheaf.operators import fundamentals as fundamentals_rows
from sheaf.operators import screener
from sheaf.session import stored
from sheaf.sources.delimited import drop_header

KEY = "symbol"


def fundamentals_side(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``symbol, dividend, week52_low, week52_high`` (text) of fundamentals lines, read
    quote-aware, header dropped."""
    rows = drop_header(fundamentals_rows.records(lines, line_col), "symbol", fundamentals_rows.HEADER_SYMBOL)
    return rows.select("symbol", "dividend", "week52_low", "week52_high")


def listing_side(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``symbol, name, sector, last_sale`` (text) of listing lines."""
    return screener.listing_records(lines, line_col).select("symbol", "name", "sector", "last_sale")


def join_on_symbol(fundamentals: DataFrame, listings: DataFrame) -> DataFrame:
    """Symbols in both inputs with the columns of both; duplicates multiply."""
    return fundamentals.join(listings, KEY, "inner")


def count_symbols(joined: DataFrame) -> DataFrame:
    """``n_symbols``, rows of the join."""
    return joined.agg(F.count(F.lit(1)).alias("n_symbols"))


def _number(df: DataFrame, name: str, blank_too: bool) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return to_double(missing_to_zero(c, blank_too))
    return c.cast("double")


def growth_table(
    joined: DataFrame, dividend: str = "dividend", low: str = "week52_low", high: str = "week52_high"
) -> DataFrame:
    """``symbol, dividend, growth``: ``n/a`` (and a blank dividend) read as 0.0 (P8);
    growth in percent over the 52-week range, NULL when the low is 0 (P9, D7)."""
    lo = _number(joined, low, blank_too=False)
    hi = _number(joined, high, blank_too=False)
    return joined.select(
        KEY,
        _number(joined, dividend, blank_too=True).alias("dividend"),
        percent_growth(lo, hi).alias("growth"),
    )


def top_k(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` largest by ``column`` (NULLs last), ties broken by symbol."""
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(KEY).asc()).limit(k).select(KEY, column)


def top_lists(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """The ``k`` largest of each of ``columns`` in one pass: list (the column), place
    (from 1), symbol, value (DOUBLE), by the order of ``top_k``.

    Every row stands once in each list; each task keeps ``k`` rows a list before the lists
    meet, so what is shuffled does not grow with the input."""
    entries = F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).cast("double").alias("value")) for c in columns])
    lists = df.select(KEY, F.inline(entries))
    order = Window.partitionBy("list").orderBy(F.col("value").desc_nulls_last(), F.col(KEY).asc())
    placed = lists.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return placed.select("list", "place", KEY, "value")


def _sorted_with_ties_split(df: DataFrame, *order) -> DataFrame:
    """``orderBy(*order)`` plus a row id as the last key, so copies of one key can be
    split over range partitions. Used on stored rows only: there the ids are
    fixed, so a retried task places every row as before."""
    return df.withColumn("_row_id", F.monotonically_increasing_id()).orderBy(*order, "_row_id").drop("_row_id")


def growth_report(fundamentals: DataFrame, listings: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The whole job. The join (J1/J2, both inputs' columns) is written once as a Parquet
    table below the shared checkpoint folder (K6), of which each output reads its columns; the
    growth table, the count, both top lists (one pass) and the two sorted listings all read it,
    so the join runs once and survives executor loss."""
    joined = stored(join_on_symbol(fundamentals, listings))
    table = growth_table(joined)
    lists = stored(top_lists(table, ["growth", "dividend"], k))

    def listed(column: str) -> DataFrame:
        return lists.filter(F.col("list") == column).orderBy("place").select(KEY, F.col("value").alias(column))

    return {
        "joined": _sorted_with_ties_split(joined, F.col(KEY).asc()),
        "count": count_symbols(joined),
        "top_growth": listed("growth"),
        "top_dividend": listed("dividend"),
        "top_lists": lists,
        "by_growth": _sorted_with_ties_split(table, F.col("growth").desc_nulls_last(), F.col(KEY).asc()),
    }
