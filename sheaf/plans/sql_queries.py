"""The retail and nested-table questions as single Spark SQL statements, the way they
are asked in SQL (T7): DataFrames are bound to ``{placeholders}``, no global view is
created. Each has a DataFrame twin in ``queries.py`` and shares its oracle. The date
questions parse the text (D8) and the semi-join uses the order key (D9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheaf.operators.catalog import run_sql
from sheaf.plans.queries import (
    COMPLETE,
    CUTOFF_DAY,
    _customer,
    _loyalty,
    _orders_text,
    query,
)
from sheaf.sources.tables import table

# Each entry: name -> (SQL text, tables it binds). ``orders_corrected`` and ``loyalty``
# are the derived shapes; the rest are driver tables.
STATEMENTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "like_and_equals_filter_sql": (
        """SELECT c_custkey, c_name, c_mktsegment FROM {customer}
           WHERE c_name LIKE 'C%7' AND c_mktsegment = 'BUILDING'""",
        ("customer",),
    ),
    "zero_value_filter_sql": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM {lineitem} WHERE l_discount = 0",
        ("lineitem",),
    ),
    "count_rows_sql": ("SELECT count(c_custkey) AS n_customers FROM {customer}", ("customer",)),
    "count_distinct_concat_sql": (
        "SELECT count(DISTINCT concat(c_mktsegment, c_nationkey)) AS households FROM {customer}",
        ("customer",),
    ),
    # The join forms count or sum the facts per key in a subquery first, so the join moves
    # one row per key (as their DataFrame twins do).
    "group_count_ranked_sql": (
        """SELECT n.n_name, CAST(sum(c.cnt) AS BIGINT) AS n_customers
           FROM (SELECT c_nationkey, count(c_custkey) AS cnt FROM {customer} GROUP BY c_nationkey) c
           JOIN {nation} n ON c.c_nationkey = n.n_nationkey
           GROUP BY n.n_name ORDER BY n_customers DESC, n.n_name""",
        ("customer", "nation"),
    ),
    "top3_quantity_sql": (
        """SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS BIGINT) AS totalqty, l_partkey AS id FROM {lineitem}
           GROUP BY l_partkey ORDER BY sum(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_partkey LIMIT 3""",
        ("lineitem",),
    ),
    "top3_quantity_named_sql": (
        """SELECT CAST(sum(q.qty) AS BIGINT) AS totalqty, q.l_partkey, p.p_name AS name
           FROM (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM {lineitem} GROUP BY l_partkey) q
           JOIN {part} p ON q.l_partkey = p.p_partkey
           GROUP BY q.l_partkey, p.p_name ORDER BY sum(q.qty) DESC, q.l_partkey, p.p_name LIMIT 3""",
        ("lineitem", "part"),
    ),
    "orders_until_date_lexical_sql": (
        f"""SELECT count(order_id) AS n_orders FROM {{orders_corrected}}
            WHERE order_datestr <= '{CUTOFF_DAY}' AND order_status = '{COMPLETE}'""",
        ("orders_corrected",),
    ),
    "orders_until_date_sql": (
        f"""SELECT count(order_id) AS n_orders FROM {{orders_corrected}}
            WHERE order_status = '{COMPLETE}'
              AND try_cast(substr(order_datestr, 1, 10) AS DATE) <= DATE'{CUTOFF_DAY}'""",
        ("orders_corrected",),
    ),
    "orders_on_date_sql": (
        f"""SELECT count(order_id) AS n_orders FROM {{orders_corrected}}
            WHERE order_status = '{COMPLETE}'
              AND try_cast(substr(order_datestr, 1, 10) AS DATE) = DATE'{CUTOFF_DAY}'""",
        ("orders_corrected",),
    ),
    "revenue_decimal_sql": (
        f"""SELECT CAST(CAST(sum(CAST(o.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS STRING) AS revenue
            FROM {{lineitem}} o
            WHERE o.l_orderkey IN (SELECT order_id FROM {{orders_corrected}}
                                   WHERE order_status = '{COMPLETE}'
                                     AND order_ts < CAST(date_add(DATE'{CUTOFF_DAY}', 1) AS TIMESTAMP_NTZ))""",
        ("lineitem", "orders_corrected"),
    ),
    "revenue_formatted_sql": (
        f"""SELECT concat('$', CAST(sum(CAST(o.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2))) AS revenue_text
            FROM {{lineitem}} o
            WHERE o.l_orderkey IN (SELECT order_id FROM {{orders_corrected}}
                                   WHERE order_status = '{COMPLETE}'
                                     AND order_ts < CAST(date_add(DATE'{CUTOFF_DAY}', 1) AS TIMESTAMP_NTZ))""",
        ("lineitem", "orders_corrected"),
    ),
    "map_lookup_sql": ("SELECT cust_id, status_orders['F'] AS finished_orders FROM {loyalty}", ("loyalty",)),
    "array_index_sql": (
        """SELECT vec_id, CAST(get(embedding, 2) AS DOUBLE) AS third, get(embedding, 100) IS NULL AS beyond_is_null
           FROM {embeddings}""",
        ("embeddings",),
    ),
    "struct_field_sql": ("SELECT cust_id, order_value.total AS total_value FROM {loyalty}", ("loyalty",)),
}

# The base query each statement answers (its oracle is shared).
TWIN = {name: name.removesuffix("_sql") for name in STATEMENTS}


def _bound(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "orders_corrected":
        return _orders_text(spark, sf)
    if name == "loyalty":
        return _loyalty(spark, sf)
    if name == "customer":
        return _customer(spark, sf)
    return table(spark, sf, name)


def _register(name: str, text: str, tables: tuple[str, ...]) -> None:
    @query(name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return run_sql(spark, text, **{t: _bound(spark, sf, t) for t in tables})


for _name, (_text, _tables) in STATEMENTS.items():
    _register(_name, _text, _tables)
