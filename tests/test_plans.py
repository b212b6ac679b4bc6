"""Plan shapes the scale decisions rely on (README, "Scale decisions")."""

from pyspark.sql import functions as F

from sheaf.operators import growth, retail, screener, wordcount
from sheaf.plans.registry import queries
from sheaf.sources.tables import table
from tests.conftest import SF_SMALL


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered_not_a_full_sort(spark):
    df = queries()["top_growth"](spark, SF_SMALL)
    plan = physical(df)
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_sorted_tickers_use_a_range_exchange(spark):
    plan = physical(queries()["sector_tickers"](spark, SF_SMALL))
    assert "rangepartitioning(sector" in plan


def test_join_falls_back_to_shuffle_above_the_broadcast_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(queries()["listing_join"](spark, SF_SMALL))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        # the per-symbol aggregate is already partitioned on the key: one exchange for it
        assert plan.count("hashpartitioning(o_custkey") == 1
        got = queries()["listing_join_count"](spark, SF_SMALL).first().n_symbols
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == queries()["listing_join_count"](spark, SF_SMALL).first().n_symbols


def test_aggregates_are_partial_before_every_shuffle(spark):
    for name in ["word_count", "sector_rollup", "top3_quantity_named", "group_count_ranked", "count_distinct_concat"]:
        plan = physical(queries()[name](spark, SF_SMALL))
        assert "partial_" in plan, name


def test_scans_read_only_named_columns(spark):
    plan = physical(queries()["top3_quantity_named"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_hot_key_with_a_third_of_the_rows(spark):
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), (F.col("id") % 97).cast("string"))).alias("value")
    )
    counts = {r.word: r.occurrences for r in wordcount.word_count(rows).collect()}
    assert counts["hot"] == n // 3 and sum(counts.values()) == n
    listings = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.lit("Cold")).alias("sector"),
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticker"),
        F.lit(1).cast("decimal(38,2)").alias("cap"),
        F.lit(1.0).alias("cap_double"),
    )
    got = {r.sector: (r.ticker_count, int(r.total_cap)) for r in screener.sector_rollup(listings).collect()}
    assert got == {"Hot": (n // 3, n // 3), "Cold": (n - n // 3, n - n // 3)}
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("oid"), F.lit(1.0).alias("amount")
    )
    orders = spark.createDataFrame([(0, "C"), (5, "C")], "order_id LONG, order_status STRING")
    orders = orders.withColumn("order_ts", F.lit("2014-01-01 00:00:00").cast("timestamp_ntz"))
    rev = retail.semi_join_revenue(items, orders, "oid", "amount", "C", "2014-12-31").first().revenue
    assert int(rev) == n // 3 + 1


def test_growth_table_keeps_one_row_per_join_match(spark):
    fund = spark.createDataFrame([("A", "1", 1.0, 2.0)], "symbol STRING, dividend STRING, week52_low DOUBLE, week52_high DOUBLE")
    listings = spark.createDataFrame([("A",), ("A",)], "symbol STRING")
    assert growth.growth_table(growth.join_on_symbol(fund, listings)).count() == 2


def test_line_id_splits_copies_in_a_range_sort(spark, tmp_path):
    from sheaf.operators import fundamentals
    from sheaf.sources.text import LINE_ID, read_lines

    copy = ",".join(["HOT", "N", "S", "1", "1.0", "2.0"] + ["1"] * 9)
    others = [",".join([f"S{i:04d}", "N", "S", "1", "1.0", "2.0"] + ["1"] * 9) for i in range(2000)]
    (tmp_path / "f.csv").write_text("\n".join([copy] * 1000 + others) + "\n")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = read_lines(spark, str(tmp_path), line_id=True)
        c = fundamentals.classify(lines, "value", LINE_ID)
        with_id = c.orderBy("symbol", LINE_ID).filter("symbol = 'HOT'").select(F.spark_partition_id().alias("p"))
        without = c.orderBy("symbol").filter("symbol = 'HOT'").select(F.spark_partition_id().alias("p"))
        assert with_id.distinct().count() > 1
        assert without.distinct().count() == 1
        assert with_id.count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_bucketed_listing_side_is_not_shuffled(spark):
    from sheaf.operators import catalog
    from sheaf.sources import derive

    catalog.drop_table(spark, "listings_bucketed")
    listings = derive.listings_by_customer(table(spark, SF_SMALL, "customer"))
    catalog.save_bucketed(listings, "listings_bucketed", "symbol", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = table(spark, SF_SMALL, "orders", "o_custkey", "o_orderstatus", "o_totalprice")
        joined = growth.join_on_symbol(derive.fundamentals_by_customer(orders), spark.table("listings_bucketed"))
        plan = physical(joined)
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange hashpartitioning") == 1  # the per-symbol aggregate only
        n = joined.count()
        orders_of = orders.select("o_custkey").distinct()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        catalog.drop_table(spark, "listings_bucketed")
    assert n == orders_of.join(table(spark, SF_SMALL, "customer"), F.col("o_custkey") == F.col("c_custkey")).count()


def test_sql_in_subquery_plans_as_semi_join(spark):
    df = queries()["revenue_semi_join_sql"](spark, SF_SMALL)
    assert "LeftSemi" in physical(df)
    assert df.first().revenue == queries()["revenue_semi_join"](spark, SF_SMALL).first().revenue


def test_semi_join_prefilters_the_large_side_with_a_bloom_filter(spark):
    """At scale the order keys are too many to broadcast; Spark then filters the line
    items with a bloom filter of the keys before the shuffle. The default applies it to
    scans over 10 GB; a lower threshold shows it here."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = queries()["revenue_semi_join"](spark, SF_SMALL)
        assert "might_contain" in physical(df)
        got = df.first().revenue
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == queries()["revenue_semi_join"](spark, SF_SMALL).first().revenue


def test_hot_order_key_in_the_semi_join_is_split_by_aqe(spark):
    """A third of the line items on one order key: with broadcast off, AQE's skew-join
    handling splits that key's partition (thresholds lowered to this data size)."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 60000
        # varied amounts: skew is judged on compressed shuffle bytes, and a constant
        # column would compress the hot partition away
        items = spark.range(n, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("oid"),
            (F.col("id") / 100).alias("amount"),
        )
        orders = spark.range(0, n, 2, numPartitions=8).select(
            F.col("id").alias("order_id"),
            F.lit("2014-01-01 00:00:00").cast("timestamp_ntz").alias("order_ts"),
            F.lit("C").alias("order_status"),
        )
        df = retail.semi_join_revenue(items, orders, "oid", "amount", "C", "2014-12-31")
        got = df.collect()[0].revenue
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
    # every hot row (key 7 is not an even order id) is dropped; even non-hot ids are kept
    want = sum(i for i in range(n) if i % 3 != 0 and i % 2 == 0) / 100
    assert float(got) == want


def test_word_count_shuffles_once_on_the_word(spark):
    plan = physical(queries()["word_count"](spark, SF_SMALL))
    assert plan.count("Exchange") == 1 and "hashpartitioning(word" in plan


def test_revenue_date_bound_and_lookup_key_reach_the_scans(spark):
    for name in ("revenue_semi_join", "revenue_semi_join_sql", "revenue_decimal_sql"):
        assert "LessThan(o_orderdate" in physical(queries()[name](spark, SF_SMALL)), name
    plan = physical(queries()["key_lookup"](spark, SF_SMALL))
    assert "EqualTo(c_custkey,42)" in plan and "EqualTo(o_custkey,42)" in plan
