"""The batch programs as whole jobs over files: read, compute, write to a fresh
``<base>_<millis>`` folder, which appears when all of it is written. Each returns the output
folder (and the totals the programs print, as values); the tables that a job keeps on its way
are dropped when it ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sheaf.operators import fundamentals, growth, loads, screener, wordcount
from sheaf.session import storage_scope, stored
from sheaf.sources.nested_text import NestedFormat
from sheaf.sources.publish import Publication, publication
from sheaf.sources.sinks import run_path, tab_text, tuple_text, write_key_ranges, write_sorted_lines
from sheaf.sources.text import LINE_ID, read_lines


def word_count_job(
    spark: SparkSession, input_path: str, output_base: str, keep_empty: bool = False, parts: int | None = None
) -> str:
    """Word count of a folder of text files.

    ``keep_empty=False``: the MapReduce job, ``word<TAB>count`` in parts by ranges of the
    word, each sorted, ``parts`` of them if set. ``keep_empty=True``: the RDD job (empty word
    counted), ``(word,count)`` lines globally sorted by word."""
    out = run_path(output_base)
    lines = read_lines(spark, input_path)
    if keep_empty:
        counts = wordcount.word_count_raw(lines, "value", by_lines=False)
        write_sorted_lines(tuple_text("word", "occurrences"), counts, ["word"], out)
    else:
        counts = wordcount.word_count(lines, "value")
        write_key_ranges(tab_text("word", "occurrences"), counts, "word", out, parts)
    return out


def screener_job(
    spark: SparkSession, input_path: str, output_base: str, rule: str = "suffix", check_width: bool = True
) -> str:
    """Sector screener over listing CSV files: ``<out>/sectors`` holds one report line per
    sector, ``<out>/tickers`` the ``sector<TAB>ticker`` lines, both sorted. The defaults
    are the MapReduce program's filter; ``rule="substring", check_width=False`` is the
    RDD program's."""
    # Lines go through the column parser, which also counts the quote-aware fields that
    # the width check needs (the CSV file reader does not expose a count).
    records = screener.listing_records(read_lines(spark, input_path, line_id=True), "value", LINE_ID)
    with storage_scope(spark), publication(spark, output_base) as run:
        write_screened(screener.screen(records, rule=rule, check_width=check_width, keep=(LINE_ID,)), run)
    return run.path


def write_screened(screened: DataFrame, run: Publication) -> None:
    """Both outputs of the screener: ``sectors`` and ``tickers``. ``screened`` has a line id."""
    # parsed once: both outputs, and the sampling before each sort, read the stored rows
    screened = stored(screened)
    report = screener.sector_report(screened)
    write_sorted_lines(F.concat_ws("\t", "capital_line", "totals_line"), report, ["sector"], run.output("sectors"))
    # the line id splits copies of one listing across range partitions
    write_sorted_lines(tab_text("sector", "ticker"), screened, ["sector", "ticker", LINE_ID], run.output("tickers"))


def fundamentals_job(spark: SparkSession, input_path: str, output_base: str) -> tuple[str, dict]:
    """Fundamentals extract: ``(symbol,dividend,pe)`` lines sorted by symbol, and the
    record-quality totals, gathered through an ``Observation`` while the one parse of the
    files is stored; only the valid rows are sorted."""
    out = run_path(output_base)
    lines = read_lines(spark, input_path, line_id=True)
    observed = Observation("fundamentals_quality")
    classified = fundamentals.classify(lines, "value", LINE_ID).observe(observed, *fundamentals.quality_metrics())
    with storage_scope(spark):
        kept = stored(classified.filter("valid").select("symbol", "dividend", "pe", LINE_ID))
        # the line id splits copies of one symbol across range partitions
        write_sorted_lines(tuple_text("symbol", "dividend", "pe"), kept, ["symbol", LINE_ID], out)
    return out, dict(observed.get)


def growth_job(
    spark: SparkSession, fundamentals_path: str, listings_path: str, output_base: str, k: int = 10
) -> tuple[str, dict[str, DataFrame]]:
    """Join of the fundamentals and listing files on the symbol, growth over the 52-week
    range, both top-``k`` lists. ``<out>/joined`` lists each matched symbol with the
    fields of both files (sorted by symbol), ``<out>/growth`` the growth table sorted by
    growth. Both files are read quote-aware, headers dropped on both sides; the join is
    stored once and every output reads it. The report reads it too: it lasts until the
    caller's storage scope ends, or else the application."""
    fund = growth.fundamentals_side(read_lines(spark, fundamentals_path))
    listings = screener.listing_records(read_lines(spark, listings_path)).select("symbol", "name", "sector", "market_cap")
    report = growth.growth_report(fund, listings, k)
    # Both frames are already sorted (ties split by row id); writing keeps that order.
    joined = report["joined"]
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in joined.columns]
    with publication(spark, output_base) as run:
        joined.select(F.concat_ws("\t", *fields)).write.text(run.output("joined"))
        report["by_growth"].select(tuple_text("symbol", "dividend", "growth")).write.text(run.output("growth"))
    return run.path, report


def loyalty_job(
    spark: SparkSession, input_path: str, table: str, load_id: str, schema: str, fmt: NestedFormat = NestedFormat()
) -> int:
    """The loyalty file into its table: nested text files as load ``load_id``, which takes the
    place of an earlier try of the same load. Returns the rows of the load."""
    loads.create_loaded_table(spark, table, schema)
    loads.load_nested(spark, input_path, table, load_id, fmt)
    return spark.table(table).filter(F.col(loads.LOAD_ID) == load_id).count()
