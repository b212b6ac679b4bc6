"""Stock screener over listing lines (rows S3, S4, P3-P5, P11, F2-F4, A3-A6, D4, D10, D11).

Records are parsed quote-aware, the header is dropped by value, lines of the wrong width
and caps that are unknown or in billions are dropped, and the cap text becomes an exact
DECIMAL. Per sector: ticker count and capital (partial + final aggregate, so a sector
holding a third of all listings still ships one row per task). The ticker list of a
sector is returned as rows ``(sector, ticker)`` in sorted order or as text in chunks of
bounded size, never gathered into one value, because a sector's list grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.money import (
    CAP_TYPE,
    keep_cap_by_substring,
    keep_cap_by_suffix,
    money_double,
    money_value,
    truncated_float_long,
)
from sheaf.operators.ordering import joined_chunks
from sheaf.sources.delimited import drop_header, parse_quoted

# The header's sector text, the width and fields of a listing line (the
# last one is the blank after the trailing comma), and the report line formats of the
# two screener programs (RDD job, then MapReduce job).
SECTOR_HEADER = "Sector"
LISTING_WIDTH = 9
LISTING_SCHEMA = (
    "symbol STRING, name STRING, last_sale STRING, market_cap STRING, ipo_year STRING, "
    "sector STRING, industry STRING, summary_quote STRING, trailing STRING"
)
CAPITAL_LINE = "(%s,(Sector capital = %s,Ticker count = %d))"
TOTALS_LINE = "Total tickers for %s = %d; Total capitalization for %s= $%d"


def listing_records(lines: DataFrame, line_col: str = "value", *keep: str) -> DataFrame:
    """Quote-aware fields of each line with its field count; header dropped."""
    parsed = parse_quoted(lines, LISTING_SCHEMA, line_col, *keep).drop("trailing")
    return drop_header(parsed, "sector", SECTOR_HEADER)


def market_cap_flags(records: DataFrame) -> DataFrame:
    """``symbol, cap_text, cap_value`` and both keep-flags: by substring (F2, the RDD
    job) and by equality and suffix (F3, the MapReduce job)."""
    cap = F.col("market_cap")
    return records.select(
        "symbol",
        cap.alias("cap_text"),
        money_value(cap).alias("cap_value"),
        keep_cap_by_substring(cap).alias("keep_substring"),
        keep_cap_by_suffix(cap).alias("keep_suffix"),
    )


def screen(records: DataFrame, rule: str = "suffix", check_width: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Listings that enter the rollup. Canonical: full width (F4) and a cap that is not
    ``n/a`` and does not end in ``B`` (F3, the MapReduce job). ``rule="substring"`` with
    ``check_width=False`` is the RDD job's filter (F2: no ``B``, no ``n/a`` anywhere).
    ``cap`` is exact (NULL when unparsable), ``cap_double`` the floating-point parse;
    ``keep`` names input columns to carry along."""
    cap = F.col("market_cap")
    if rule == "suffix":
        kept = keep_cap_by_suffix(cap)
    elif rule == "substring":
        kept = keep_cap_by_substring(cap)
    else:
        raise ValueError(f"unknown cap rule {rule!r}")
    if check_width:
        kept = kept & (F.col("field_count") == LISTING_WIDTH)
    return records.filter(kept).select(
        *keep,
        "sector",
        F.col("symbol").alias("ticker"),
        money_value(cap).alias("cap"),
        money_double(cap).alias("cap_double"),
    )


def sector_rollup(screened: DataFrame) -> DataFrame:
    """``sector, ticker_count, total_cap, unparsed_caps`` (A3, A5; D10)."""
    return screened.groupBy("sector").agg(
        F.count(F.lit(1)).alias("ticker_count"),
        F.sum("cap").cast(CAP_TYPE).alias("total_cap"),
        F.count_if(F.col("cap").isNull()).alias("unparsed_caps"),
    )


def sector_rollup_truncated(screened: DataFrame) -> DataFrame:
    """``sector, ticker_count, total_cap_truncated``: each cap cut to float, then to a
    long, then summed, as the counter-based job does (A6, D4)."""
    return screened.groupBy("sector").agg(
        F.count(F.lit(1)).alias("ticker_count"),
        F.sum(truncated_float_long(F.col("cap_double"))).alias("total_cap_truncated"),
    )


def sector_tickers(screened: DataFrame, *tiebreak: str) -> DataFrame:
    """``sector, ticker`` sorted (A4 in row form; padding blanks kept, D11). The sort is
    a range exchange on both columns, so one large sector spreads over many tasks;
    ``tiebreak`` (e.g. a scan-time line id) also splits copies of one ticker."""
    return screened.orderBy("sector", "ticker", *tiebreak).select("sector", "ticker")


def sector_ticker_text(screened: DataFrame, chunk_bytes: int = 1 << 16) -> DataFrame:
    """A4 as text: ``sector, chunk, tickers``; a sector's chunks one after another are its
    sorted tickers joined by commas. Only chunks of bounded size are gathered."""
    chunks = joined_chunks(screened.orderBy("sector", "ticker").select("sector", "ticker"), "sector", "ticker", chunk_bytes)
    return chunks.withColumnRenamed("ticker", "tickers")


def sector_report(screened: DataFrame) -> DataFrame:
    """One report per sector (P11, X17): the RDD job's ``(sector,(Sector capital = ...,
    Ticker count = ...))`` and the MapReduce job's totals lines."""
    g = screened.groupBy("sector").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("cap").cast(CAP_TYPE).alias("_cap"),
        F.sum(truncated_float_long(F.col("cap_double"))).alias("_cap_long"),
    )
    capital_line = F.format_string(CAPITAL_LINE, F.col("sector"), F.col("_cap").cast("string"), F.col("_n"))
    totals_line = F.format_string(TOTALS_LINE, F.col("sector"), F.col("_n"), F.col("sector"), F.col("_cap_long"))
    return g.select("sector", capital_line.alias("capital_line"), totals_line.alias("totals_line"))
