"""One query per operator family of the reference, over the driver tables.

Each query is ``(spark, sf_dir) -> DataFrame``, reads whole tables and returns a lazy
plan; output columns carry the same names as the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.nested import array_item, map_value
from sheaf.operators import catalog, fundamentals, growth, loads, nested, retail, screener, wordcount
from sheaf.operators.ordering import numbered
from sheaf.plans import jobs
from sheaf.session import own_path, storage_scope, stored
from sheaf.sources import derive
from sheaf.sources.delimited import parse_tab
from sheaf.sources.nested_text import parse_nested
from sheaf.sources.publish import publication, published
from sheaf.sources.sinks import hashed_sorted, read_dated, tab_text, tuple_text, write_dated
from sheaf.sources.tables import table
from sheaf.sources.text import LINE_ID

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of the retail questions: the completed status and the cut-off day.
COMPLETE = "F"
CUTOFF_DAY = "1998-10-03"


# The cut-off in seconds since the epoch: midnight UTC of that day.
CUTOFF_SECONDS = 907372800
# Bytes of a chunk of a sector's tickers.
TEXT_CHUNK = 4096
# The customer that the key lookup asks for.
LOOKUP_KEY = 42


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Exact DECIMAL results leave the query as text with all their digits, which compares
    equal however the rows are fetched."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# ---- word counts -------------------------------------------------------------------

def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", "text")


@query("word_count")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count(_documents(spark, sf), "text")


@query("word_count_raw")
def word_count_raw(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_raw(_documents(spark, sf), "text")


@query("word_count_sorted")
def word_count_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """The counts in global byte order (range-partitioned sort), with each word's
    place in it."""
    return numbered(wordcount.sorted_by_word(wordcount.word_count(_documents(spark, sf), "text")))


@query("word_count_hashed")
def word_count_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """The counts in hash parts on the word, each sorted by word."""
    return hashed_sorted(wordcount.word_count(_documents(spark, sf), "text"), "word")


# ---- listings: quote-aware scan, cap parsing, sector rollups ---------------------------

def _customer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _listing_records(spark: SparkSession, sf: str) -> DataFrame:
    return screener.listing_records(derive.listing_lines(_customer(spark, sf)))


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    return screener.screen(_listing_records(spark, sf))


@query("csv_quoted_scan")
def csv_quoted_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _listing_records(spark, sf)


@query("market_cap_parse")
def market_cap_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _as_text(screener.market_cap_flags(_listing_records(spark, sf)), "cap_value")


@query("sector_rollup")
def sector_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _as_text(screener.sector_rollup(_screened(spark, sf)), "total_cap")


@query("sector_rollup_substring")
def sector_rollup_substring(spark: SparkSession, sf: str) -> DataFrame:
    """the rollup under the RDD program's filter (no B, no n/a anywhere; no width check)."""
    screened = screener.screen(_listing_records(spark, sf), rule="substring", check_width=False)
    return _as_text(screener.sector_rollup(screened), "total_cap")


@query("sector_rollup_truncated")
def sector_rollup_truncated(spark: SparkSession, sf: str) -> DataFrame:
    return screener.sector_rollup_truncated(_screened(spark, sf))


@query("sector_tickers")
def sector_tickers(spark: SparkSession, sf: str) -> DataFrame:
    return screener.sector_tickers(_screened(spark, sf))


@query("sector_report")
def sector_report(spark: SparkSession, sf: str) -> DataFrame:
    return screener.sector_report(_screened(spark, sf))


@query("sector_ticker_text")
def sector_ticker_text(spark: SparkSession, sf: str) -> DataFrame:
    return screener.sector_ticker_text(_screened(spark, sf), TEXT_CHUNK)


@query("sector_files")
def sector_files(spark: SparkSession, sf: str) -> DataFrame:
    """K1-K5: the screener's two outputs written and published as one run, and its files read
    back: output, line."""
    lines = derive.listing_lines(_customer(spark, sf)).withColumn(LINE_ID, F.monotonically_increasing_id())
    records = screener.listing_records(lines, "value", LINE_ID)
    base = os.path.join(own_path(spark), "run")  # the files outlast the scope below
    with storage_scope(spark), publication(spark, base) as run:
        jobs.write_screened(screener.screen(records, keep=(LINE_ID,)), run)
    files = [spark.read.text(path).select(F.lit(name).alias("output"), F.col("value").alias("line"))
             for name, path in sorted(published(spark, run.path).items())]
    return files[0].unionByName(files[1])


@query("rendered_rows")
def rendered_rows(spark: SparkSession, sf: str) -> DataFrame:
    per_nation = table(spark, sf, "customer", "c_nationkey").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    joined = per_nation.join(
        table(spark, sf, "nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "n_name",
        tuple_text("n_name", "n_customers").alias("tuple_line"),
        tab_text("n_name", "n_customers").alias("tab_line"),
    )


# ---- fundamentals: quote-aware extract, quality counts, plain split --------------------------------------------

def _fundamentals_lines(spark: SparkSession, sf: str) -> DataFrame:
    return derive.fundamentals_lines(_customer(spark, sf))


@query("csv_naive_scan")
def csv_naive_scan(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals.naive_scan(_fundamentals_lines(spark, sf))


@query("fundamentals_extract")
def fundamentals_extract(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals.extract(_fundamentals_lines(spark, sf))


@query("fundamentals_sorted")
def fundamentals_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the extract in ascending symbol order, with each row's place in it."""
    return numbered(fundamentals.sorted_by_symbol(fundamentals.extract(_fundamentals_lines(spark, sf))))


@query("fundamentals_quality")
def fundamentals_quality(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals.quality(_fundamentals_lines(spark, sf))


# ---- two-file join, growth, top lists ---------------------------------------------------

def _joined(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_totalprice")
    return growth.join_on_symbol(
        growth.fundamentals_side(derive.fundamentals_order_lines(orders)),
        growth.listing_side(derive.listing_lines(_customer(spark, sf))),
    )


@query("listing_join")
def listing_join(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf)


@query("listing_join_count")
def listing_join_count(spark: SparkSession, sf: str) -> DataFrame:
    return growth.count_symbols(_joined(spark, sf))


@query("listing_growth")
def listing_growth(spark: SparkSession, sf: str) -> DataFrame:
    return growth.growth_table(_joined(spark, sf))


@query("top_growth")
def top_growth(spark: SparkSession, sf: str) -> DataFrame:
    return growth.top_k(growth.growth_table(_joined(spark, sf)), "growth", 10)


@query("top_dividend")
def top_dividend(spark: SparkSession, sf: str) -> DataFrame:
    return growth.top_k(growth.growth_table(_joined(spark, sf)), "dividend", 10)


@query("top_lists")
def top_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Both top-10 lists from one scan of each input and one join."""
    return growth.top_lists(growth.growth_table(_joined(spark, sf)), ["growth", "dividend"], 10)


# ---- retail questions -----------------------------------------------------------------

@query("like_and_equals_filter")
def like_and_equals_filter(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    return retail.like_and_equals(customers, "c_name", "C%7", "c_mktsegment", "BUILDING")


@query("zero_value_filter")
def zero_value_filter(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return retail.equals_value(items, "l_discount", 0.0)


@query("count_rows")
def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return retail.count_column(table(spark, sf, "customer", "c_custkey"), "c_custkey", "n_customers")


@query("count_distinct_concat")
def count_distinct_concat(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer", "c_mktsegment", "c_nationkey")
    return retail.count_distinct_concat(customers, ["c_mktsegment", "c_nationkey"], "households")


@query("group_count_ranked")
def group_count_ranked(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation", "n_nationkey", "n_name")
    return retail.group_count_ranked_named(
        customers, nations, "c_nationkey", "n_nationkey", "n_name", "c_custkey", "n_customers"
    )


@query("top3_quantity")
def top3_quantity(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_partkey", "l_quantity")
    top = retail.top_sum(items, "l_partkey", "l_quantity", 3, "totalqty")
    return top.select(F.col("totalqty").cast("bigint").alias("totalqty"), F.col("l_partkey").alias("id"))


@query("top3_quantity_named")
def top3_quantity_named(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_partkey", "l_quantity")
    parts = table(spark, sf, "part", "p_partkey", "p_name")
    top = retail.top_sum_named(items, parts, "l_partkey", "p_partkey", "p_name", "l_quantity", 3, "totalqty")
    return top.select(F.col("totalqty").cast("bigint").alias("totalqty"), "l_partkey", F.col("p_name").alias("name"))


def _orders_text(spark: SparkSession, sf: str) -> DataFrame:
    return derive.orders_with_text_dates(table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus"))


@query("orders_until_date_lexical")
def orders_until_date_lexical(spark: SparkSession, sf: str) -> DataFrame:
    return retail.count_until_lexical(_orders_text(spark, sf), COMPLETE, CUTOFF_DAY)


@query("orders_until_date")
def orders_until_date(spark: SparkSession, sf: str) -> DataFrame:
    return retail.count_until(_orders_text(spark, sf), COMPLETE, CUTOFF_DAY)


@query("orders_until_epoch")
def orders_until_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """The same question in seconds since the epoch."""
    return retail.count_until_epoch(_orders_text(spark, sf), COMPLETE, CUTOFF_SECONDS)


@query("orders_on_date")
def orders_on_date(spark: SparkSession, sf: str) -> DataFrame:
    return retail.count_on(_orders_text(spark, sf), COMPLETE, CUTOFF_DAY)


@query("orders_until_dated")
def orders_until_dated(spark: SparkSession, sf: str) -> DataFrame:
    """F11 on the orders written as a table partitioned by month: later months are not read."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    path = own_path(spark)
    write_dated(orders, "o_orderdate", path, "month")
    dated = read_dated(spark, path, "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderstatus STRING")
    until = retail.read_dated_until(dated, "o_orderdate", CUTOFF_DAY, "month")
    return retail.count_column(until.filter(F.col("o_orderstatus") == COMPLETE), "o_orderkey", "n_orders")


def _revenue(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
    return retail.semi_join_revenue(items, _orders_text(spark, sf), "l_orderkey", "l_extendedprice", COMPLETE, CUTOFF_DAY)


@query("revenue_semi_join")
def revenue_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return _as_text(_revenue(spark, sf), "revenue")


@query("revenue_semi_join_sql")
def revenue_semi_join_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same question as one SQL statement; ``IN (subquery)`` plans as a left
    semi-join. DataFrames are bound to the placeholders, no global view is created."""
    items = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
    return catalog.run_sql(
        spark,
        f"""
        SELECT CAST(CAST(sum(CAST(o.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS STRING) AS revenue
        FROM {{items}} o
        WHERE o.l_orderkey IN (
            SELECT order_id FROM {{orders}}
            WHERE order_status = '{COMPLETE}'
              AND order_ts < CAST(date_add(DATE'{CUTOFF_DAY}', 1) AS TIMESTAMP_NTZ))
        """,
        items=items,
        orders=_orders_text(spark, sf),
    )


@query("revenue_decimal")
def revenue_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """The sum as DECIMAL with two places, shown as the SQL shell prints it."""
    return _revenue(spark, sf).select(F.col("revenue").cast("string").alias("revenue"))


@query("revenue_formatted")
def revenue_formatted(spark: SparkSession, sf: str) -> DataFrame:
    return retail.as_dollars(_revenue(spark, sf), "revenue", "revenue_text")


@query("date_parts")
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return retail.date_part_counts(_orders_text(spark, sf))


# ---- tab-delimited ratings ----------------------------------------------------------------

def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events", "ts", "user_id", "event_id", "value", "event_type", "props")
    return parse_tab(derive.rating_lines(events), derive.RATINGS_SCHEMA)


@query("ratings_scan")
def ratings_scan(spark: SparkSession, sf: str) -> DataFrame:
    # The cell is parsed as TINYINT (an overflow reads back as NULL); the nullable small
    # integer leaves the query as DOUBLE, which every fetch path (Python objects or
    # pandas, where a nullable integer turns into float64 or Int8) returns alike.
    return _ratings(spark, sf).withColumn("rating", F.col("rating").cast("double"))


@query("ratings_count")
def ratings_count(spark: SparkSession, sf: str) -> DataFrame:
    return _ratings(spark, sf).agg(F.count(F.lit(1)).alias("n_ratings"))


# ---- nested loyalty table ---------------------------------------------------------------------

def _loyalty(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_totalprice")
    return derive.loyalty_program(_customer(spark, sf), orders)


@query("map_lookup")
def map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return nested.lookup_map(_loyalty(spark, sf), "status_orders", "F", "finished_orders")


@query("array_index")
def array_index(spark: SparkSession, sf: str) -> DataFrame:
    """X15 on the stored vectors: an index inside and one behind the last element."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    third, beyond = array_item(F.col("embedding"), 2), array_item(F.col("embedding"), 100)
    return vectors.select("vec_id", third.cast("double").alias("third"), beyond.isNull().alias("beyond_is_null"))


@query("key_lookup")
def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """one customer's map, array and struct values; the key reaches both scans."""
    rows = _loyalty(spark, sf).filter(F.col("cust_id") == LOOKUP_KEY)
    return rows.select(
        "cust_id",
        map_value(F.col("status_orders"), "F").alias("finished_orders"),
        array_item(F.col("order_counts"), 2).alias("pending_orders"),
        F.col("order_value.total").alias("total_value"),
    )


@query("loyalty_load")
def loyalty_load(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the loyalty file read back into map, array and struct; nullable
    numbers leave the query as text."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    rows = parse_nested(derive.loyalty_lines(_customer(spark, sf), orders), derive.LOYALTY_SCHEMA)
    value = F.col("order_value")
    return rows.select(
        "cust_id", "statement", "fname", "lname", "email", "level",
        map_value(F.col("phone"), "HOME").alias("home_phone"),
        F.size("phone").cast("bigint").alias("n_phones"),
        F.array_size("order_ids").cast("string").alias("n_orders"),
        array_item(F.col("order_ids"), 0).cast("string").alias("first_order"),
        array_item(F.col("order_ids"), 2).cast("string").alias("third_order"),
        F.aggregate("order_ids", F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x, F.lit(0))).cast("string").alias("sum_of_ids"),
        *[value[x].cast("string").alias(f"value_{x}") for x in ("min", "max", "avg", "total")],
    )


@query("loyalty_table")
def loyalty_table(spark: SparkSession, sf: str) -> DataFrame:
    """The loyalty lines loaded into a catalog table in two loads, one of them run
    again; a column and then the table renamed; counted under the new names; dropped. A customer
    without orders has an empty array and so no first order."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    rows = parse_nested(derive.loyalty_lines(_customer(spark, sf), orders), derive.LOYALTY_SCHEMA)
    own = uuid.uuid4().hex
    name = f"loyalty_program_{own}"
    loads.create_loaded_table(spark, name, derive.LOYALTY_SCHEMA)
    try:
        for part in (0, 1, 1):
            loads.load(rows.filter(F.pmod("cust_id", F.lit(2)) == part), name, f"load {part}")
        catalog.rename_column(spark, name, "level", "status")
        catalog.rename_table(spark, name, f"reward_program_{own}")
        name = f"reward_program_{own}"
        return stored(catalog.run_sql(spark, f"""
            SELECT load_id, status, count(*) AS n_statements, count(phone['HOME']) AS n_home,
                   count(get(order_ids, 0)) AS n_first_orders, sum(order_value.total) AS total_value
            FROM {name} GROUP BY load_id, status"""))
    finally:
        catalog.drop_table(spark, name)


@query("third_order")
def third_order(spark: SparkSession, sf: str) -> DataFrame:
    """X15 on the loyalty rows: the third order id of every statement, NULL where it is short."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    rows = parse_nested(derive.loyalty_lines(_customer(spark, sf), orders), derive.LOYALTY_SCHEMA)
    found = nested.lookup_array(rows, "order_ids", 2, "third", key="cust_id")
    return found.select("cust_id", F.col("third").cast("string").alias("third"))


@query("struct_field")
def struct_field(spark: SparkSession, sf: str) -> DataFrame:
    return nested.lookup_struct(_loyalty(spark, sf), "order_value", "total", "total_value")


@query("rename_column")
def rename_column(spark: SparkSession, sf: str) -> DataFrame:
    return nested.rename_column(_loyalty(spark, sf), "level", "status").select("cust_id", "status")
