"""The reference-shaped inputs built from the driver tables."""

from pyspark.sql import functions as F

from sheaf.sources import derive
from sheaf.sources.delimited import naive_fields, quoted_field_count
from sheaf.sources.tables import table
from tests.conftest import SF_SMALL


def customers(spark):
    return table(spark, SF_SMALL, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def test_listing_lines_shape(spark):
    lines = derive.listing_lines(customers(spark))
    n = customers(spark).count()
    assert lines.count() == n + 1
    assert lines.filter(F.col("value") == derive.LISTING_HEADER).count() == 1
    widths = {r.w for r in lines.select(quoted_field_count(F.col("value")).alias("w")).distinct().collect()}
    assert widths == {8, 9, 10}
    caps = lines.select(F.from_csv("value", "a STRING, b STRING, c STRING, cap STRING").alias("r")).select("r.cap")
    kinds = {
        r.kind
        for r in caps.select(
            F.when(F.col("cap") == "n/a", "na")
            .when(F.col("cap").endswith("B"), "billions")
            .when(F.col("cap").contains("B"), "b_inside")
            .when(F.col("cap").endswith("M"), "millions")
            .when(F.col("cap").isNull(), "blank")
            .otherwise("plain")
            .alias("kind")
        ).collect()
    }
    assert {"na", "billions", "b_inside", "millions", "blank", "plain"} <= kinds


def test_fundamentals_lines_shape(spark):
    lines = derive.fundamentals_lines(customers(spark))
    counts = {
        (r.naive, r.quoted): r.n
        for r in lines.groupBy(
            F.size(naive_fields(F.col("value"))).alias("naive"), quoted_field_count(F.col("value")).alias("quoted")
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    assert counts.get((15, 15), 0) > 0  # the plain case and the header
    assert any(naive == 16 and quoted == 15 for naive, quoted in counts)  # a quoted name with a comma
    assert any(naive == 14 for naive, _ in counts)  # a line missing its last field
    assert sum(counts.values()) == customers(spark).count() + 1


def test_rating_lines_overflow_and_orders_text(spark):
    events = table(spark, SF_SMALL, "events")
    lines = derive.rating_lines(events)
    assert lines.count() == events.count()
    assert lines.filter(F.size(F.split("value", "\t")) != 5).count() == 0
    orders = derive.orders_with_text_dates(table(spark, SF_SMALL, "orders"))
    assert orders.filter(~F.col("order_datestr").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")).count() == 0


def test_loyalty_rows_are_one_per_customer(spark):
    loyalty = derive.loyalty_program(customers(spark), table(spark, SF_SMALL, "orders"))
    assert loyalty.count() == customers(spark).count()
    assert loyalty.select("cust_id").distinct().count() == loyalty.count()
    row = loyalty.filter(F.size("status_orders") > 0).first()
    assert sum(row.order_counts) == sum(int(v) for v in row.status_orders.values())


def test_order_lines_hold_every_case(spark):
    from sheaf.operators import growth

    orders = table(spark, SF_SMALL, "orders")
    lines = derive.fundamentals_order_lines(orders)
    side = growth.fundamentals_side(lines).collect()
    assert len(side) == lines.count() - 1  # the header
    assert {"", "n/a"} <= {r.dividend for r in side} and {"n/a", "0"} <= {r.week52_low for r in side}
    assert "n/a" in {r.week52_high for r in side}
    assert len(side) > len({r.symbol for r in side})


def test_rollup_rules_differ_and_caps_fail_to_parse(spark):
    from sheaf.plans.registry import queries

    one = {tuple(r) for r in queries()["sector_rollup"](spark, SF_SMALL).collect()}
    two = {tuple(r) for r in queries()["sector_rollup_substring"](spark, SF_SMALL).collect()}
    assert not one & two
    assert all(r[3] > 0 for r in one)
    growths = [r.growth for r in queries()["listing_growth"](spark, SF_SMALL).collect()]
    assert any(g is None for g in growths) and any(g is not None for g in growths)
