"""DuckDB SQL for each query in ``queries.py``, written independently from the Spark
plans: the oracle computes from the base columns (or renders the same lines and applies
the rules with DuckDB's own string and list functions). Column names and types match
the Spark results.
"""

from __future__ import annotations

CUTOFF = "1998-10-03"

# Listing records as the quote-aware parse must return them: names without any quote,
# the backslash kept, widths as the lines were cut.
_LISTING = r"""
WITH b AS (
  SELECT c_custkey AS k, c_name, c_nationkey, c_mktsegment,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS bal
  FROM customer),
rec AS (
  SELECT CASE WHEN k % 50 = 0 THEN rpad('T' || k, 14, ' ') ELSE 'T' || k END AS symbol,
         CASE k % 11 WHEN 3 THEN c_name || ' Q Inc.' WHEN 5 THEN c_name || '\' ELSE c_name || ', Inc.' END AS name,
         bal AS last_sale,
         CASE k % 16 WHEN 0 THEN 'n/a' WHEN 2 THEN '$' || bal || 'B' WHEN 3 THEN '$' || bal
                     WHEN 4 THEN '' WHEN 5 THEN 'unknown'
                     WHEN 6 THEN '$' || (k % 1000) || '.' || lpad(CAST((k * 37) % 10000 AS VARCHAR), 4, '0') || 'M'
                     WHEN 7 THEN '$0.00' || (k % 10) || 'M'
                     WHEN 8 THEN '$' || bal || 'BM' WHEN 9 THEN 'n/a est.'
                     WHEN 10 THEN '$' || (k % 1000) || '.' || lpad(CAST((k * 7919) % 1000000 AS VARCHAR), 6, '0')
                     ELSE '$' || bal || 'M' END AS market_cap,
         CAST(1990 + c_nationkey AS VARCHAR) AS ipo_year,
         c_mktsegment AS sector,
         'Industry ' || c_nationkey AS industry,
         'quote/T' || k AS summary_quote,
         CAST(CASE k % 13 WHEN 4 THEN 8 WHEN 9 THEN 10 ELSE 9 END AS INTEGER) AS field_count,
         k, CAST(bal AS DECIMAL(12,2)) AS amount
  FROM b),
-- the caps as numbers, from what they were written from: no text is parsed here
parsed AS (
  SELECT *,
    CAST(CASE WHEN k % 16 IN (0, 2, 4, 5, 8, 9) THEN NULL
              WHEN k % 16 = 3 THEN amount
              WHEN k % 16 = 6 THEN ((k % 1000) * 10000 + (k * 37) % 10000) * 100
              WHEN k % 16 = 7 THEN (k % 10) * 1000
              WHEN k % 16 = 10 THEN round(CAST((k % 1000) * 1000000 + (k * 7919) % 1000000 AS DECIMAL(38,6)) / 10000, 0) / 100
              ELSE amount * 1000000 END AS DECIMAL(38,2)) AS cap,
    CASE WHEN contains(market_cap, 'M')
         THEN TRY_CAST(replace(replace(market_cap, '$', ''), 'M', '') AS DOUBLE) * 1000000.0
         ELSE TRY_CAST(replace(market_cap, '$', '') AS DOUBLE) END AS cap_double
  FROM rec),
screened AS (
  SELECT sector, symbol AS ticker, cap, cap_double
  FROM parsed
  WHERE field_count = 9 AND market_cap <> 'n/a' AND NOT ends_with(market_cap, 'B'))
"""

# Fundamentals fields by customer, and the lines as the Spark side renders them, split on
# every comma (``c``). The quote-aware extract (``e``) takes the fields themselves.
_FUNDAMENTALS = r"""
WITH b AS (
  SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey, c_acctbal,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS bal,
         CAST(c_custkey % 500 AS VARCHAR) AS whole,
         CAST(c_custkey % 500 AS VARCHAR) || '.' || lpad(CAST((c_custkey * 7) % 100 AS VARCHAR), 2, '0') AS dec
  FROM customer),
f AS (
  SELECT k, [
    'T' || k,
    CASE k % 13 WHEN 0 THEN '"' || c_name || ', Inc."' WHEN 6 THEN '"' || c_name || ' ""Q"" Co"' ELSE c_name END,
    c_mktsegment,
    bal,
    CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN whole ELSE dec END,
    CASE k % 11 WHEN 0 THEN '' WHEN 1 THEN '-' || dec ELSE bal END,
    CAST(c_nationkey AS VARCHAR),
    '1.00',
    CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR),
    CAST(CAST(abs(c_acctbal) * 2 AS DECIMAL(12,2)) AS VARCHAR),
    bal, '0', '1.50', '2.50',
    'filings/T' || k] AS fields
  FROM b),
lines AS (
  SELECT CASE WHEN k % 17 = 0 THEN array_to_string(fields[1:14], ',') ELSE array_to_string(fields, ',') END AS value
  FROM f
  UNION ALL
  SELECT 'Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings'),
t AS (SELECT value, string_split(value, ',') AS t FROM lines),
c AS (
  SELECT value, t, t[1] AS symbol, t[5] AS dividend_raw, t[6] AS pe_raw, CAST(len(t) AS INTEGER) AS field_count FROM t),
by_field AS (
  SELECT fields[1] AS symbol, fields[5] AS dividend_raw, fields[6] AS pe_raw,
         CASE WHEN k % 17 = 0 THEN 14 ELSE 15 END AS field_count
  FROM f
  UNION ALL SELECT 'Symbol', 'Dividend Yield', 'Price/Earnings', 15),
d AS (
  SELECT *, coalesce(dividend_raw = '', false) AS no_dividend, coalesce(pe_raw = '', false) AS no_pe,
         CASE WHEN dividend_raw = '' THEN '0.0' ELSE dividend_raw END AS dividend,
         CASE WHEN pe_raw = '' THEN '-Infinity' ELSE pe_raw END AS pe
  FROM by_field),
e AS (
  SELECT *,
    (field_count <> 15 OR no_dividend OR no_pe) AS short_or_blank,
    (coalesce(regexp_full_match(dividend, '[0-9]*\.[0-9]*'), false)
      AND (coalesce(pe = '-Infinity', false) OR coalesce(regexp_full_match(pe, '[0-9]*\.[0-9]*'), false))
      AND symbol IS DISTINCT FROM 'Symbol') AS is_valid
  FROM d)
"""

_JOINED = _LISTING + r"""
, a AS (
  SELECT o_custkey AS ck, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
         min(o_totalprice) AS lo, max(o_totalprice) AS hi
  FROM orders GROUP BY o_custkey),
f1 AS (
  SELECT ck, 'T' || ck AS symbol,
         CASE WHEN ck % 7 = 0 THEN '' WHEN ck % 7 = 1 OR finished = 0 THEN 'n/a' ELSE CAST(finished AS VARCHAR) END AS dividend,
         CASE WHEN ck % 19 = 0 THEN 'n/a' WHEN ck % 29 = 0 THEN '0' ELSE CAST(CAST(lo AS DECIMAL(18,2)) AS VARCHAR) END AS week52_low,
         CASE WHEN ck % 23 = 0 THEN 'n/a' ELSE CAST(CAST(hi AS DECIMAL(18,2)) AS VARCHAR) END AS week52_high
  FROM a),
fund AS (SELECT * FROM f1 UNION ALL SELECT * FROM f1 WHERE ck % 31 = 0),
j AS (
  SELECT fund.symbol, dividend, week52_low, week52_high, rec.name, rec.sector, rec.last_sale
  FROM fund JOIN rec ON rec.symbol = fund.symbol),
n AS (
  SELECT symbol,
         CASE WHEN dividend IN ('n/a', '') THEN 0.0 ELSE TRY_CAST(dividend AS DOUBLE) END AS dividend,
         CASE WHEN week52_low = 'n/a' THEN 0.0 ELSE CAST(week52_low AS DOUBLE) END AS lo,
         CASE WHEN week52_high = 'n/a' THEN 0.0 ELSE CAST(week52_high AS DOUBLE) END AS hi
  FROM j),
g AS (SELECT symbol, dividend, (hi - lo) / nullif(lo, 0) * 100.0 AS growth FROM n)
"""

_ORDERS_TEXT = r"""
WITH o AS (
  SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_datestr,
         o_orderstatus AS order_status
  FROM orders)
"""

_REVENUE = _ORDERS_TEXT + rf"""
, r AS (
  SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
  FROM lineitem
  WHERE l_orderkey IN (
    SELECT order_id FROM o
    WHERE order_status = 'F' AND CAST(substr(order_datestr, 1, 10) AS DATE) <= DATE '{CUTOFF}'))
"""

_LOYALTY = r"""
WITH agg AS (
  SELECT o_custkey,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY o_custkey),
l AS (
  SELECT c_custkey AS cust_id, c_acctbal, n_f, coalesce(n_p, 0) AS n_p, cents
  FROM customer LEFT JOIN agg ON o_custkey = c_custkey)
"""

ORACLE_SQL: dict[str, str] = {
    "word_count": r"""
SELECT word, count(*) AS occurrences
FROM (SELECT unnest(regexp_split_to_array(text, '\W+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""",
    "word_count_raw": r"""
WITH d AS (SELECT string_split_regex(text, '\r\n|\r|\n') AS ls FROM documents),
l AS (SELECT ls[i] AS line, i, len(ls) AS n FROM d, range(1, len(ls) + 1) r(i)),
e AS (
  SELECT '' AS word FROM l
  WHERE NOT (i = n AND line = '')
    AND (line = '' OR (regexp_matches(line, '^\W') AND regexp_matches(line, '\w')))),
w AS (SELECT unnest(regexp_split_to_array(text, '\W+')) AS word FROM documents)
SELECT word, count(*) AS occurrences
FROM (SELECT word FROM w WHERE word <> '' UNION ALL SELECT word FROM e)
GROUP BY word
""",
    "csv_quoted_scan": _LISTING + """
SELECT symbol, name, last_sale, market_cap, ipo_year, sector, industry, summary_quote, field_count FROM rec
""",
    "market_cap_parse": _LISTING + """
SELECT symbol, market_cap AS cap_text, CAST(cap AS VARCHAR) AS cap_value,
       (NOT contains(market_cap, 'B') AND NOT contains(market_cap, 'n/a')) AS keep_substring,
       (market_cap <> 'n/a' AND NOT ends_with(market_cap, 'B')) AS keep_suffix
FROM parsed
""",
    "sector_rollup": _LISTING + """
SELECT sector, count(*) AS ticker_count, CAST(CAST(sum(cap) AS DECIMAL(38,2)) AS VARCHAR) AS total_cap,
       count(*) FILTER (WHERE cap IS NULL) AS unparsed_caps
FROM screened GROUP BY sector
""",
    "sector_rollup_substring": _LISTING + """
SELECT sector, count(*) AS ticker_count, CAST(CAST(sum(cap) AS DECIMAL(38,2)) AS VARCHAR) AS total_cap,
       count(*) FILTER (WHERE cap IS NULL) AS unparsed_caps
FROM parsed
WHERE NOT contains(market_cap, 'B') AND NOT contains(market_cap, 'n/a')
GROUP BY sector
""",
    "sector_rollup_truncated": _LISTING + """
SELECT sector, count(*) AS ticker_count,
       CAST(sum(CAST(trunc(CAST(cap_double AS FLOAT)) AS BIGINT)) AS BIGINT) AS total_cap_truncated
FROM screened GROUP BY sector
""",
    "sector_tickers": _LISTING + """
SELECT sector, ticker FROM screened
""",
    "sector_report": _LISTING + """
SELECT sector,
       '(' || sector || ',(Sector capital = ' || CAST(CAST(sum(cap) AS DECIMAL(38,2)) AS VARCHAR)
           || ',Ticker count = ' || count(*) || '))' AS capital_line,
       'Total tickers for ' || sector || ' = ' || count(*) || '; Total capitalization for ' || sector
           || '= $' || CAST(sum(CAST(trunc(CAST(cap_double AS FLOAT)) AS BIGINT)) AS BIGINT) AS totals_line
FROM screened GROUP BY sector
""",
    "rendered_rows": """
SELECT n_name, '(' || n_name || ',' || cnt || ')' AS tuple_line, n_name || chr(9) || cnt AS tab_line
FROM (SELECT c_nationkey, count(*) AS cnt FROM customer GROUP BY c_nationkey) c
JOIN nation ON n_nationkey = c_nationkey
""",
    "csv_naive_scan": _FUNDAMENTALS + r"""
, q AS (SELECT *, regexp_replace(value, '"[^"]*"', '', 'g') AS outside FROM c)
SELECT symbol, field_count,
       CAST(length(outside) - length(replace(outside, ',', '')) + 1 AS INTEGER) AS quoted_field_count,
       t[5] AS dividend_field, t[6] AS pe_field,
       field_count <> CAST(length(outside) - length(replace(outside, ',', '')) + 1 AS INTEGER) AS shifted
FROM q
""",
    "fundamentals_extract": _FUNDAMENTALS + """
SELECT symbol, dividend, pe, TRY_CAST(pe AS DOUBLE) AS pe_value FROM e WHERE is_valid
""",
    "fundamentals_quality": _FUNDAMENTALS + """
SELECT count(*) AS total_lines,
       count(*) FILTER (WHERE is_valid) AS valid,
       count(*) FILTER (WHERE no_dividend) AS no_dividend,
       count(*) FILTER (WHERE short_or_blank OR NOT is_valid) AS invalid_rows,
       count(*) FILTER (WHERE short_or_blank) + count(*) FILTER (WHERE NOT is_valid) AS invalid_events
FROM e
""",
    "listing_join": _JOINED + """
SELECT symbol, dividend, week52_low, week52_high, name, sector, last_sale FROM j
""",
    "listing_join_count": _JOINED + """
SELECT count(*) AS n_symbols FROM j
""",
    "listing_growth": _JOINED + """
SELECT symbol, dividend, growth FROM g
""",
    "top_growth": _JOINED + """
SELECT symbol, growth FROM g ORDER BY growth DESC NULLS LAST, symbol LIMIT 10
""",
    "top_dividend": _JOINED + """
SELECT symbol, dividend FROM g ORDER BY dividend DESC NULLS LAST, symbol LIMIT 10
""",
    "like_and_equals_filter": """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_name LIKE 'C%7' AND c_mktsegment = 'BUILDING'
""",
    "zero_value_filter": """
SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem WHERE l_discount = 0
""",
    "count_rows": """
SELECT count(c_custkey) AS n_customers FROM customer
""",
    "count_distinct_concat": """
SELECT count(DISTINCT c_mktsegment || CAST(c_nationkey AS VARCHAR)) AS households FROM customer
""",
    "group_count_ranked": """
SELECT n_name, count(c_custkey) AS n_customers
FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY n_customers DESC, n_name
""",
    "top3_quantity": """
SELECT CAST(trunc(sum(CAST(l_quantity AS DECIMAL(18,2)))) AS BIGINT) AS totalqty, l_partkey AS id
FROM lineitem GROUP BY l_partkey ORDER BY sum(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_partkey LIMIT 3
""",
    "top3_quantity_named": """
SELECT CAST(trunc(sum(CAST(l_quantity AS DECIMAL(18,2)))) AS BIGINT) AS totalqty, l_partkey, p_name AS name
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, p_name ORDER BY sum(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_partkey, p_name LIMIT 3
""",
    "orders_until_date_lexical": _ORDERS_TEXT + f"""
SELECT count(order_id) AS n_orders FROM o WHERE order_datestr <= '{CUTOFF}' AND order_status = 'F'
""",
    "orders_until_date": _ORDERS_TEXT + f"""
SELECT count(order_id) AS n_orders FROM o
WHERE order_status = 'F' AND CAST(substr(order_datestr, 1, 10) AS DATE) <= DATE '{CUTOFF}'
""",
    "orders_on_date": _ORDERS_TEXT + f"""
SELECT count(order_id) AS n_orders FROM o
WHERE order_status = 'F' AND CAST(substr(order_datestr, 1, 10) AS DATE) = DATE '{CUTOFF}'
""",
    "revenue_semi_join": _REVENUE + """
SELECT CAST(revenue AS VARCHAR) AS revenue FROM r
""",
    "revenue_decimal": _REVENUE + """
SELECT CAST(revenue AS VARCHAR) AS revenue FROM r
""",
    "revenue_formatted": _REVENUE + """
SELECT '$' || CAST(revenue AS VARCHAR) AS revenue_text FROM r
""",
    "date_parts": _ORDERS_TEXT + """
, d AS (SELECT CAST(substr(order_datestr, 1, 10) AS DATE) AS day_value FROM o)
SELECT CAST(year(day_value) AS INTEGER) AS year, CAST(month(day_value) AS INTEGER) AS month,
       CAST(day(day_value) AS INTEGER) AS day, count(*) AS n_orders
FROM d GROUP BY 1, 2, 3
""",
    "ratings_scan": """
SELECT ts AS posted, user_id AS cust_id, event_id AS prod_id,
       CAST(TRY_CAST(floor(value) AS TINYINT) AS DOUBLE) AS rating, event_type || ' ' || props AS message
FROM events
""",
    "ratings_count": """
SELECT count(*) AS n_ratings FROM events
""",
    "map_lookup": _LOYALTY + """
SELECT cust_id, CAST(nullif(n_f, 0) AS VARCHAR) AS finished_orders FROM l
""",
    "array_index": """
SELECT vec_id, CAST(embedding[3] AS DOUBLE) AS third, embedding[101] IS NULL AS beyond_is_null FROM embeddings
""",
    "key_lookup": _LOYALTY + """
SELECT cust_id, CAST(nullif(n_f, 0) AS VARCHAR) AS finished_orders, n_p AS pending_orders, cents // 100 AS total_value
FROM l WHERE cust_id = 42
""",
    "orders_until_epoch": """
SELECT count(o_orderkey) AS n_orders FROM orders
WHERE o_orderstatus = 'F' AND epoch(date_trunc('day', o_orderdate)) <= 907372800
""",
    "struct_field": _LOYALTY + """
SELECT cust_id, cents // 100 AS total_value FROM l
""",
    "rename_column": """
SELECT c_custkey AS cust_id,
       CASE WHEN c_acctbal >= 5000 THEN 'GOLD' WHEN c_acctbal >= 1000 THEN 'SILVER' ELSE 'BRONZE' END AS status
FROM customer
""",
}

# The sorted forms number their rows; the layout of hash parts does not change the rows.
ORACLE_SQL["word_count_sorted"] = f"""
SELECT word, occurrences, row_number() OVER (ORDER BY word) AS place FROM ({ORACLE_SQL["word_count"]})
"""
ORACLE_SQL["word_count_hashed"] = ORACLE_SQL["word_count"]
ORACLE_SQL["fundamentals_sorted"] = _FUNDAMENTALS + """
SELECT symbol, dividend, pe, TRY_CAST(pe AS DOUBLE) AS pe_value, row_number() OVER (ORDER BY symbol) AS place
FROM e WHERE is_valid
"""
ORACLE_SQL["revenue_semi_join_sql"] = ORACLE_SQL["revenue_semi_join"]

# A sector's tickers in order with the byte at which each starts; a chunk holds those that start in it.
ORACLE_SQL["sector_ticker_text"] = _LISTING + """
, o AS (
  SELECT sector, ticker, row_number() OVER w AS i,
         coalesce(sum(octet_length(encode(ticker)) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM screened WINDOW w AS (PARTITION BY sector ORDER BY ticker))
SELECT sector, CAST(start // 4096 AS BIGINT) AS chunk,
       string_agg(CASE WHEN start = 0 THEN ticker ELSE ',' || ticker END, '' ORDER BY i) AS tickers
FROM o GROUP BY 1, 2
"""
ORACLE_SQL["top_lists"] = _JOINED + """
, t AS (SELECT 'growth' AS list, symbol, growth AS value FROM g UNION ALL SELECT 'dividend', symbol, dividend FROM g),
p AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY value DESC NULLS LAST, symbol) AS n FROM t)
SELECT list, CAST(n AS INTEGER) AS place, symbol, value FROM p WHERE n <= 10
"""
# What the loyalty lines say, from the base columns: nothing is rendered or parsed here.
_STATEMENTS = r"""
WITH n AS (SELECT o_custkey, ceil(count(*) / 64) AS parts FROM orders GROUP BY 1),
s AS (
  SELECT o_custkey, CAST(o_orderkey % parts AS BIGINT) AS statement, list(o_orderkey ORDER BY o_orderkey) AS ids,
         min(o_totalprice) AS lo, max(o_totalprice) AS hi, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders JOIN n USING (o_custkey) GROUP BY 1, 2),
l AS (
  SELECT c_custkey AS k, c_name, c_acctbal, coalesce(statement, 0) AS statement, lo, hi, cents, len(ids) AS n_ids,
         CASE WHEN c_custkey % 9 = 5 THEN NULL WHEN c_custkey % 9 = 4 THEN list_prepend(NULL, coalesce(ids, CAST([] AS BIGINT[])))
              ELSE coalesce(ids, []) END AS order_ids
  FROM customer LEFT JOIN s ON o_custkey = c_custkey),
r AS (
  SELECT k AS cust_id, statement, string_split(c_name, '#')[1] AS fname, string_split(c_name, '#')[-1] AS lname,
         'c' || k || '@mail.example' AS email,
         CASE WHEN c_acctbal >= 5000 THEN 'GOLD' WHEN c_acctbal >= 1000 THEN 'SILVER' ELSE 'BRONZE' END AS level,
         CASE WHEN k % 6 IN (1, 2, 5) THEN '555-' || k END AS home_phone,
         CAST(CASE k % 6 WHEN 0 THEN 0 WHEN 2 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS BIGINT) AS n_phones,
         order_ids,
         CASE WHEN k % 17 <> 0 THEN CAST(floor(lo) AS BIGINT) END AS value_min,
         CASE WHEN k % 17 <> 0 THEN CAST(floor(hi) AS BIGINT) END AS value_max,
         CASE WHEN k % 17 <> 0 AND k % 7 <> 2 THEN cents // (n_ids * 100) END AS value_avg,
         CASE WHEN k % 17 <> 0 AND k % 7 NOT IN (2, 3) THEN cents // 100 END AS value_total
  FROM l)
"""
ORACLE_SQL["loyalty_load"] = _STATEMENTS + """
SELECT cust_id, statement, fname, lname, email, level, home_phone, n_phones,
       CAST(len(order_ids) AS VARCHAR) AS n_orders, CAST(order_ids[1] AS VARCHAR) AS first_order,
       CAST(order_ids[3] AS VARCHAR) AS third_order,
       CAST(CASE WHEN order_ids IS NOT NULL THEN coalesce(list_sum(order_ids), 0) END AS VARCHAR) AS sum_of_ids,
       CAST(value_min AS VARCHAR) AS value_min, CAST(value_max AS VARCHAR) AS value_max,
       CAST(value_avg AS VARCHAR) AS value_avg, CAST(value_total AS VARCHAR) AS value_total
FROM r
"""
ORACLE_SQL["third_order"] = _STATEMENTS + """
SELECT cust_id, CAST(order_ids[3] AS VARCHAR) AS third FROM r
"""
ORACLE_SQL["orders_until_dated"] = ORACLE_SQL["orders_until_date"]
ORACLE_SQL["sector_files"] = f"""
SELECT 'sectors' AS output, capital_line || chr(9) || totals_line AS line FROM ({ORACLE_SQL["sector_report"]})
UNION ALL SELECT 'tickers', sector || chr(9) || ticker FROM ({ORACLE_SQL["sector_tickers"]})
"""
ORACLE_SQL["loyalty_table"] = _STATEMENTS + """
SELECT 'load ' || (cust_id % 2) AS load_id, level AS status, count(*) AS n_statements, count(home_phone) AS n_home,
       count(order_ids[1]) AS n_first_orders, CAST(sum(value_total) AS BIGINT) AS total_value
FROM r GROUP BY 1, 2
"""
