"""Name -> (Spark query, oracle SQL), the flagship query and the bench list."""

from __future__ import annotations

from sheaf.plans import sql_queries  # noqa: F401  (registers the SQL-text queries)
from sheaf.plans.oracle import ORACLE_SQL
from sheaf.plans.queries import QUERIES, Query
from sheaf.plans.sql_queries import TWIN

FLAGSHIP = "sector_rollup"

# The queries timed by bench.py: explode + big aggregate, parse + small aggregate,
# equi-join, join + top-k, join + two-key aggregate + top-k, semi-join + sum,
# distinct aggregate, and the pushed-down LIKE + equality filter (the one query with a
# published reference timing).
BENCH = (
    "word_count",
    "sector_rollup",
    "listing_join",
    "top_growth",
    "top3_quantity_named",
    "revenue_semi_join",
    "count_distinct_concat",
    "like_and_equals_filter",
)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """Every query's oracle; a SQL-text query shares its DataFrame twin's."""
    return {name: ORACLE_SQL[TWIN.get(name, name)] for name in QUERIES if TWIN.get(name, name) in ORACLE_SQL}
