"""Fundamentals extract with record-quality counts (rows S2, S4, P6, P7, F4-F6, A7, A8,
O2, D3, D5).

Fields are read quote-aware, so a quoted name holding a comma leaves the later fields in
place. ``naive_scan`` keeps the plain split on every comma, which shifts them, next to it
with a ``shifted`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.numbers import NEGATIVE_INFINITY_TEXT, ZERO_TEXT, blank_to, is_blank, is_plain_decimal
from sheaf.sources.delimited import naive_fields, parse_quoted, quoted_field_count

# Field positions and width of a fundamentals line, and the header symbol.
SYMBOL, DIVIDEND, PRICE_EARNINGS = 0, 4, 5
WIDTH = 15
HEADER_SYMBOL = "Symbol"
SCHEMA = (
    "symbol STRING, name STRING, sector STRING, price STRING, dividend STRING, pe STRING, earnings STRING, "
    "book STRING, week52_low STRING, week52_high STRING, market_cap STRING, ebitda STRING, price_sales STRING, "
    "price_book STRING, filings STRING"
)


def records(lines: DataFrame, line_col: str = "value", *keep: str) -> DataFrame:
    """The named fields of each line, read quote-aware, with ``field_count``. An empty
    field is an empty text; a field past the end of a short line is NULL."""
    return parse_quoted(lines, SCHEMA, line_col, *keep)


def classify(lines: DataFrame, line_col: str = "value", *keep: str) -> DataFrame:
    """Every line with its fields and one flag per rule.

    ``short_or_blank``: wrong width, or blank dividend or P/E (counted, row kept).
    ``valid``: dividend and P/E pass the number test (P/E may be ``-Infinity``) and the
    row is not the header. A line too short to hold a field has NULL there and fails.
    """
    fields = records(lines, line_col, *keep).select(
        *keep, "symbol", F.col("dividend").alias("dividend_raw"), F.col("pe").alias("pe_raw"), "field_count"
    )
    no_dividend = is_blank(F.col("dividend_raw"))
    no_pe = is_blank(F.col("pe_raw"))
    dividend = blank_to(F.col("dividend_raw"), ZERO_TEXT)
    pe = blank_to(F.col("pe_raw"), NEGATIVE_INFINITY_TEXT)
    pe_ok = F.coalesce(pe == NEGATIVE_INFINITY_TEXT, F.lit(False)) | is_plain_decimal(pe)
    not_header = ~F.col("symbol").eqNullSafe(HEADER_SYMBOL)
    return fields.select(
        *keep,
        "symbol",
        dividend.alias("dividend"),
        pe.alias("pe"),
        "field_count",
        no_dividend.alias("no_dividend"),
        ((F.col("field_count") != WIDTH) | no_dividend | no_pe).alias("short_or_blank"),
        (is_plain_decimal(dividend) & pe_ok & not_header).alias("valid"),
    )


def extract(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``symbol, dividend, pe`` (text as in the file, with the blank replacements) and
    ``pe_value`` as a double (``-Infinity`` for a blank P/E) for the valid rows."""
    c = classify(lines, line_col).filter("valid")
    return c.select("symbol", "dividend", "pe", F.col("pe").try_cast("double").alias("pe_value"))


def quality_metrics() -> list[Column]:
    """The D3 counts over ``classify`` rows: ``total_lines, valid, no_dividend,
    invalid_rows, invalid_events``. ``invalid_events`` is the reference's invalid counter:
    a wrong-width or blank-field row adds one and a filtered row adds one more."""
    return [
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if("valid").alias("valid"),
        F.count_if("no_dividend").alias("no_dividend"),
        F.count_if(F.col("short_or_blank") | ~F.col("valid")).alias("invalid_rows"),
        (F.count_if("short_or_blank") + F.count_if(~F.col("valid"))).alias("invalid_events"),
    ]


def quality(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row of counts (``quality_metrics``) in one aggregate pass."""
    return classify(lines, line_col).agg(*quality_metrics())


def naive_scan(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """The plain split next to the quote-aware width: ``symbol, field_count,
    quoted_field_count, dividend_field, pe_field, shifted`` (D5)."""
    line = F.col(line_col)
    t = naive_fields(line)
    return lines.select(
        F.get(t, SYMBOL).alias("symbol"),
        F.size(t).alias("field_count"),
        quoted_field_count(line).alias("quoted_field_count"),
        F.get(t, DIVIDEND).alias("dividend_field"),
        F.get(t, PRICE_EARNINGS).alias("pe_field"),
        (F.size(t) != quoted_field_count(line)).alias("shifted"),
    )


def sorted_by_symbol(extracted: DataFrame, *tiebreak: str) -> DataFrame:
    """O2: ascending by symbol (range-partitioned sort, not one task); ``tiebreak``
    columns let the range partitioner split copies of one symbol."""
    return extracted.orderBy("symbol", *tiebreak)
