"""The SQL-text forms keep their DataFrame twins' plan properties."""

import pytest

from sheaf.plans.registry import queries
from sheaf.plans.sql_queries import TWIN
from tests.conftest import SF_SMALL

PROPERTIES = ("partial_", "LeftSemi", "TakeOrderedAndProject")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(TWIN))
def test_sql_form_keeps_plan_properties(spark, name):
    sql_plan = physical(queries()[name](spark, SF_SMALL))
    twin_plan = physical(queries()[TWIN[name]](spark, SF_SMALL))
    for prop in PROPERTIES:
        if prop in twin_plan:
            assert prop in sql_plan, (name, prop)


def test_sql_join_forms_aggregate_before_the_join(spark):
    for name in ("top3_quantity_named_sql", "group_count_ranked_sql"):
        plan = physical(queries()[name](spark, SF_SMALL))
        found = [i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0]
        assert found, name
        below = plan[min(found):]
        assert "partial_" in below, name  # a partial aggregate sits under the join
