"""Reference-shaped inputs derived from the driver tables.

The reference reads listing and fundamentals CSV files, a tab-delimited ratings file,
retail tables and a nested loyalty table, none of which ship with it. The queries build
the same shapes from the driver tables inside the plan (a projection per row, or one
grouped aggregate), so the parsers and rules run on real, growing data. Per-row styles
(which cap form, which blank field) are picked from the row key, and every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.dates import as_text

# Header lines of the two listing file formats (an exchange's company list,
# and an index's constituents with financials).
LISTING_HEADER = '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",'
FUNDAMENTALS_HEADER = (
    "Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,"
    "52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings"
)

RATINGS_SCHEMA = "posted TIMESTAMP_NTZ, cust_id BIGINT, prod_id BIGINT, rating TINYINT, message STRING"


def _money2(amount: str, name: str) -> str:
    """A two-decimal amount as text, e.g. ``-994.28``, ``100.00``."""
    return f"string(CAST({amount} AS DECIMAL(12,2))) AS {name}"


def _with_header(lines: DataFrame, header: str) -> DataFrame:
    head = lines.sparkSession.range(1, numPartitions=1).select(F.lit(header).alias("value"))
    return head.unionByName(lines)


def listing_lines(customer: DataFrame, with_header: bool = True) -> DataFrame:
    """NASDAQ-style lines: 8 quoted fields and a trailing comma (9 fields).

    Ticker ``T<custkey>`` (every 50th padded with blanks), last sale = balance, sector =
    market segment. By key, names hold a comma, doubled quotes or end in a backslash; some
    lines lack the trailing comma (8 fields) or have one field more (10); caps are ``n/a``,
    ``$<bal>M``, ``$<bal>B``, ``$<bal>``, blank, no number, four or more decimals with and
    without ``M``, a ``B`` that is not at the end, or ``n/a`` with a remark behind it.
    """
    parts = customer.selectExpr("c_custkey AS k", "c_name", "c_nationkey", "c_mktsegment", _money2("c_acctbal", "bal"))
    lines = parts.selectExpr(r"""
        concat('"', concat_ws('","',
            CASE WHEN pmod(k, 50) = 0 THEN rpad(concat('T', k), 14, ' ') ELSE concat('T', k) END,
            CASE pmod(k, 11) WHEN 3 THEN concat(c_name, ' ""Q"" Inc.') WHEN 5 THEN concat(c_name, '\\')
                             ELSE concat(c_name, ', Inc.') END,
            bal,
            CASE pmod(k, 16)
                WHEN 0 THEN 'n/a'
                WHEN 2 THEN concat('$', bal, 'B')
                WHEN 3 THEN concat('$', bal)
                WHEN 4 THEN ''
                WHEN 5 THEN 'unknown'
                WHEN 6 THEN concat('$', pmod(k, 1000), '.', lpad(pmod(k * 37, 10000), 4, '0'), 'M')
                WHEN 7 THEN concat('$0.00', pmod(k, 10), 'M')
                WHEN 8 THEN concat('$', bal, 'BM')
                WHEN 9 THEN 'n/a est.'
                WHEN 10 THEN concat('$', pmod(k, 1000), '.', lpad(pmod(k * 7919, 1000000), 6, '0'))
                ELSE concat('$', bal, 'M') END,
            string(1990 + c_nationkey),
            c_mktsegment,
            concat('Industry ', c_nationkey),
            concat('quote/T', k)),
        '"', CASE pmod(k, 13) WHEN 4 THEN '' WHEN 9 THEN ',extra,' ELSE ',' END) AS value""")
    return _with_header(lines, LISTING_HEADER) if with_header else lines


def fundamentals_lines(customer: DataFrame, with_header: bool = True) -> DataFrame:
    """S&P-style lines, 15 comma-separated fields (dividend 4, P/E 5, low 8, high 9).

    By key: some names are quoted and hold a comma (16 naive fields) or doubled quotes;
    dividend is blank, ``n/a``, a whole number or ``d.dd``; P/E is blank, negative or the
    balance; every 17th line lacks its last field.
    """
    parts = customer.selectExpr(
        "c_custkey AS k", "c_name", "c_nationkey", "c_mktsegment", _money2("c_acctbal", "bal"),
        _money2("abs(c_acctbal)", "low"), _money2("abs(c_acctbal) * 2", "high"),
        "concat(pmod(c_custkey, 500), '.', lpad(pmod(c_custkey * 7, 100), 2, '0')) AS dec",
    )
    lines = parts.selectExpr(r"""
        concat_ws(',',
            concat('T', k),
            CASE pmod(k, 13) WHEN 0 THEN concat('"', c_name, ', Inc."') WHEN 6 THEN concat('"', c_name, ' ""Q"" Co"') ELSE c_name END,
            c_mktsegment,
            bal,
            CASE pmod(k, 7) WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN string(pmod(k, 500)) ELSE dec END,
            CASE pmod(k, 11) WHEN 0 THEN '' WHEN 1 THEN concat('-', dec) ELSE bal END,
            string(c_nationkey),
            '1.00', low, high, bal, '0', '1.50', '2.50',
            CASE WHEN pmod(k, 17) <> 0 THEN concat('filings/T', k) END) AS value""")
    return _with_header(lines, FUNDAMENTALS_HEADER) if with_header else lines


def fundamentals_order_lines(orders: DataFrame) -> DataFrame:
    """Fundamentals lines with a header, one per customer with orders (every 31st twice).

    By key: dividend is blank, ``n/a`` or the number of finished orders; the low is
    ``n/a``, ``0`` or the smallest order price, the high ``n/a`` or the largest; some names
    are quoted and hold a comma."""
    lines = fundamentals_by_customer(orders).withColumnRenamed("symbol", "k").selectExpr(r"""
        concat_ws(',',
            concat('T', k),
            CASE WHEN pmod(k, 13) = 0 THEN concat('"Co ', k, ', Inc."') ELSE concat('Co ', k) END,
            'S', '1.00',
            CASE pmod(k, 7) WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE dividend END,
            '1.0', '1', '1.00',
            CASE WHEN pmod(k, 19) = 0 THEN 'n/a' WHEN pmod(k, 29) = 0 THEN '0' ELSE string(CAST(week52_low AS DECIMAL(18,2))) END,
            CASE WHEN pmod(k, 23) = 0 THEN 'n/a' ELSE string(CAST(week52_high AS DECIMAL(18,2))) END,
            '0', '0', '1.50', '2.50', concat('filings/T', k)) AS value""", "explode(sequence(1, if(pmod(k, 31) = 0, 2, 1))) AS _copy")
    return _with_header(lines.select("value"), FUNDAMENTALS_HEADER)


def fundamentals_by_customer(orders: DataFrame) -> DataFrame:
    """What the fundamentals lines of the listing join say, one row per customer with orders:
    ``symbol``, ``dividend`` (text; ``n/a`` when no order is finished), ``week52_low``
    and ``week52_high`` (smallest and largest order price). One partial+final aggregate."""
    g = orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("_finished"),
        F.min("o_totalprice").alias("week52_low"),
        F.max("o_totalprice").alias("week52_high"),
    )
    dividend = F.when(F.col("_finished") == 0, F.lit("n/a")).otherwise(F.col("_finished").cast("string"))
    return g.select(F.col("o_custkey").alias("symbol"), dividend.alias("dividend"), "week52_low", "week52_high")


def listings_by_customer(customer: DataFrame) -> DataFrame:
    """The listing side of the join: ``symbol, name, sector, last_sale``."""
    return customer.select(
        F.col("c_custkey").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_acctbal").alias("last_sale"),
    )


def rating_lines(events: DataFrame) -> DataFrame:
    """Tab-delimited ratings: posted time, customer, product, rating, message.

    The rating is the event value's whole part, so values of 128 and more overflow the
    TINYINT column and read back as NULL, like any bad cell.
    """
    fields = [
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.col("user_id").cast("string"),
        F.col("event_id").cast("string"),
        F.floor(F.col("value")).cast("string"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")),
    ]
    return events.select(F.concat_ws("\t", *fields).alias("value"))


def orders_with_text_dates(orders: DataFrame) -> DataFrame:
    """``orders_corrected`` shape: ``order_id, order_datestr, order_status``, and the date
    as it is stored (``order_ts``), on which a filter reaches the scan."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        as_text(F.col("o_orderdate")).alias("order_datestr"),
        F.col("o_orderstatus").alias("order_status"),
    )


# Order status codes, in the order of the per-status count array.
ORDER_STATUSES = ("F", "O", "P")


def loyalty_level(balance: Column) -> Column:
    return F.when(balance >= 5000, F.lit("GOLD")).when(balance >= 1000, F.lit("SILVER")).otherwise(F.lit("BRONZE"))


def loyalty_program(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """The nested ``loyalty_program`` shape, one row per customer:
    ``cust_id, fname, lname, email, level, status_orders MAP<STRING,STRING>,
    order_counts ARRAY<BIGINT>, order_value STRUCT<min,max,avg,total BIGINT>``.

    The map holds the number of orders per status (statuses without orders absent),
    the array the same counts in ``ORDER_STATUSES`` order, the struct whole-dollar
    figures of the order prices. Everything comes from one grouped aggregate of fixed
    width per customer, so a customer with a third of all orders is still one small row.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    per_customer = orders.groupBy("o_custkey").agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"_n_{s}") for s in ORDER_STATUSES],
        F.count(F.lit(1)).alias("_n"),
        F.min("o_totalprice").alias("_min"),
        F.max("o_totalprice").alias("_max"),
        F.sum(cents).alias("_cents"),
    )
    joined = customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    status_map = F.map_filter(
        F.create_map(*[x for s in ORDER_STATUSES for x in (F.lit(s), F.col(f"_n_{s}").cast("string"))]),
        lambda _k, v: v.isNotNull() & (v != "0"),
    )
    order_value = F.struct(
        F.floor(F.col("_min")).cast("bigint").alias("min"),
        F.floor(F.col("_max")).cast("bigint").alias("max"),
        F.expr("_cents div (_n * 100)").alias("avg"),
        F.expr("_cents div 100").alias("total"),
    )
    return joined.select(
        F.col("c_custkey").alias("cust_id"),
        F.substring_index(F.col("c_name"), "#", 1).alias("fname"),
        F.substring_index(F.col("c_name"), "#", -1).alias("lname"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@mail.example")).alias("email"),
        loyalty_level(F.col("c_acctbal")).alias("level"),
        status_map.alias("status_orders"),
        F.array(*[F.coalesce(F.col(f"_n_{s}"), F.lit(0)) for s in ORDER_STATUSES]).alias("order_counts"),
        order_value.alias("order_value"),
    )


LOYALTY_SCHEMA = (
    "cust_id BIGINT, statement BIGINT, fname STRING, lname STRING, email STRING, level STRING, phone MAP<STRING,STRING>, "
    "order_ids ARRAY<BIGINT>, order_value STRUCT<min:BIGINT,max:BIGINT,avg:BIGINT,total:BIGINT>"
)
# About so many order ids stand in one line.
STATEMENT_ORDERS = 64


def loyalty_lines(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of the loyalty file: ``|`` between fields, ``,`` between items, ``:`` behind map
    keys. A customer has one line (statement 0) for every ``STATEMENT_ORDERS`` orders or part of
    it, with order numbers dealt by their remainder, so every order id stands in some line and
    no line grows with a customer's orders; one without orders has a line with an empty array.

    By customer: the phone map is empty, holds HOME, HOME and WORK, ``home``, a key without a
    number or HOME twice; some id arrays start with a bad number or are ``\\N``; some value
    structs are short or end in a bad number; every 17th line lacks its last field."""
    sizes = orders.groupBy(F.col("o_custkey").alias("_cust")).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(STATEMENT_ORDERS)).cast("bigint")
    dealt = orders.join(sizes, F.col("o_custkey") == F.col("_cust")).withColumn("_statement", F.pmod("o_orderkey", parts))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    statements = dealt.groupBy("o_custkey", "_statement").agg(
        F.sort_array(F.collect_list("o_orderkey")).alias("_ids"),
        F.min("o_totalprice").alias("_min"),
        F.max("o_totalprice").alias("_max"),
        F.sum(cents).alias("_cents"),
    )
    rows = customer.join(statements, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    text = k.cast("string")
    home, work = F.concat(F.lit("HOME:555-"), text), F.concat(F.lit("WORK:556-"), text)
    style = F.pmod(k, 6)
    phone = (
        F.when(style == 0, F.lit(""))
        .when(style == 2, F.concat_ws(",", home, work))
        .when(style == 3, F.concat(F.lit("home:555-"), text))
        .when(style == 4, F.concat(F.lit("HOME,"), work))
        .when(style == 5, F.concat(home, F.lit(",HOME:999")))
        .otherwise(home)
    )
    ids = F.coalesce(F.array_join("_ids", ","), F.lit(""))
    ids = F.when(F.pmod(k, 9) == 5, F.lit(r"\N")).when(F.pmod(k, 9) == 4, F.concat_ws(",", F.lit("x"), F.array_join("_ids", ","))).otherwise(ids)
    value = [F.floor("_min"), F.floor("_max"), F.expr("_cents div (size(_ids) * 100)"), F.expr("_cents div 100")]
    cells = [F.coalesce(v.cast("string"), F.lit(r"\N")) for v in value]
    order_value = (
        F.when(F.pmod(k, 7) == 2, F.concat_ws(",", *cells[:2]))
        .when(F.pmod(k, 7) == 3, F.concat_ws(",", *cells[:3], F.lit("n/a")))
        .otherwise(F.concat_ws(",", *cells))
    )
    fields = [
        text,
        F.coalesce(F.col("_statement"), F.lit(0)).cast("string"),
        F.substring_index("c_name", "#", 1),
        F.substring_index("c_name", "#", -1),
        F.concat(F.lit("c"), text, F.lit("@mail.example")),
        loyalty_level(F.col("c_acctbal")),
        phone,
        ids,
    ]
    short = F.concat_ws("|", *fields)
    return rows.select(F.when(F.pmod(k, 17) == 0, short).otherwise(F.concat_ws("|", short, order_value)).alias("value"))
