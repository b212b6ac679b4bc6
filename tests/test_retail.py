from decimal import Decimal

from pyspark.sql import functions as F

from sheaf.operators import catalog, retail


def orders(spark):
    # FIXTURES.md 2, "orders_text_dates"
    days = ["2014-05-16 23:59:59", "2014-05-17 00:00:00", "2014-05-17", "2014-05-18 00:00:00"]
    rows = [(i * 2 + j, d, s) for i, d in enumerate(days) for j, s in enumerate(["COMPLETE", "PENDING"])]
    df = spark.createDataFrame(rows, "order_id INT, order_datestr STRING, order_status STRING")
    return df.withColumn("order_ts", F.col("order_datestr").cast("timestamp_ntz"))


def test_date_text_filters(spark):
    o = orders(spark)
    assert retail.count_until_lexical(o, "COMPLETE", "2014-05-17").first().n_orders == 2
    assert retail.count_until(o, "COMPLETE", "2014-05-17").first().n_orders == 3
    assert retail.count_on(o, "COMPLETE", "2014-05-17").first().n_orders == 2


def test_count_distinct_concat_skips_null_and_merges(spark):
    # FIXTURES.md 2, "households"
    df = spark.createDataFrame([("a", "b"), ("ab", ""), (None, "c")], "street STRING, city STRING")
    assert retail.count_distinct_concat(df, ["street", "city"], "households").first().households == 1


def test_like_equals_and_zero(spark):
    df = spark.createDataFrame(
        [("Bryan", "Chicago", 1.0), ("Brian", "Chicago", 0.0), ("Ben", "Boston", 0.0), ("Bo", "Chicago", 2.0)],
        "fname STRING, city STRING, price DOUBLE",
    )
    assert sorted(r.fname for r in retail.like_and_equals(df, "fname", "B%n", "city", "Chicago").collect()) == [
        "Brian",
        "Bryan",
    ]
    assert retail.equals_value(df, "price", 0).count() == 2


def test_group_count_ranked_orders_by_count(spark):
    df = spark.createDataFrame([(1, "PR"), (2, "PR"), (3, "CA"), (None, "CA"), (5, "NY")], "id INT, state STRING")
    got = [(r.state, r.n) for r in retail.group_count_ranked(df, "state", "id").collect()]
    assert got == [("PR", 2), ("CA", 1), ("NY", 1)]


def test_top_sum_named_equals_join_then_group(spark):
    items = spark.createDataFrame([(1, 5), (1, 7), (2, 3), (3, 20), (4, 1)], "pid INT, qty INT")
    # pid 3 twice with the same name, pid 4 twice with two names
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c"), (4, "d1"), (4, "d2")], "id INT, name STRING")
    got = retail.top_sum_named(items, products, "pid", "id", "name", "qty", 10, "totalqty")
    naive = (
        items.join(products, F.col("pid") == F.col("id"))
        .groupBy("pid", "name")
        .agg(F.sum("qty").alias("totalqty"))
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))
    assert [r.pid for r in retail.top_sum_named(items, products, "pid", "id", "name", "qty", 1, "t").collect()] == [3]


def test_semi_join_revenue_keeps_items_once(spark):
    o = orders(spark)
    items = spark.createDataFrame([(0, 1.10), (0, 2.20), (2, 3.30), (6, 100.0), (1, 50.0)], "oid INT, subtotal DOUBLE")
    got = retail.semi_join_revenue(items, o, "oid", "subtotal", "COMPLETE", "2014-05-17").first().revenue
    assert got == Decimal("6.60")
    assert retail.as_dollars(spark.createDataFrame([(got,)], "r DECIMAL(38,2)"), "r", "t").first().t == "$6.60"


def test_sql_form_gives_same_answer(spark):
    o = orders(spark)
    got = catalog.run_sql(
        spark,
        "SELECT count(order_id) AS n FROM {o} WHERE order_status = 'COMPLETE' "
        "AND cast(substr(order_datestr, 1, 10) AS DATE) <= DATE'2014-05-17'",
        o=o,
    ).first().n
    assert got == 3


def test_date_parts(spark):
    got = {(r.year, r.month, r.day): r.n_orders for r in retail.date_part_counts(orders(spark)).collect()}
    assert got == {(2014, 5, 16): 2, (2014, 5, 17): 4, (2014, 5, 18): 2}


def test_group_count_ranked_named_equals_join_then_group(spark):
    facts = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (None, 20), (5, 30)], "id INT, key INT")
    dims = spark.createDataFrame([(10, "PR"), (20, "CA"), (30, "PR"), (40, "NY")], "k INT, name STRING")
    got = [(r.name, r.n) for r in retail.group_count_ranked_named(facts, dims, "key", "k", "name", "id").collect()]
    assert got == [("PR", 3), ("CA", 1)]


def test_day_epoch_seconds_orders_like_the_day(spark):
    from sheaf.functions.dates import day_epoch_seconds

    o = orders(spark)
    cut = spark.createDataFrame([("2014-05-17",)], "d STRING").select(day_epoch_seconds(F.col("d")).alias("s")).first().s
    assert cut == 1400284800
    assert retail.count_until_epoch(o, "COMPLETE", cut).first().n_orders == retail.count_until(o, "COMPLETE", "2014-05-17").first().n_orders


def test_revenue_beyond_ten_digit_decimal(spark):
    # The sum passes decimal(10,2)'s 8 integer digits; DECIMAL(38,2) holds it exactly
    o = orders(spark)
    items = spark.createDataFrame([(0, 99999999.99)] * 12, "oid INT, subtotal DOUBLE")
    got = retail.semi_join_revenue(items, o, "oid", "subtotal", "COMPLETE", "2014-05-17").first().revenue
    assert got == Decimal("1199999999.88")


def test_money_keeps_its_digits(spark):
    from sheaf.functions.money import money_value

    caps = {
        "$1.2345M": "1234500.00", "$0.004M": "4000.00", "$1500": "1500.00", "$2.005": "2.01", "$2B": None, "n/a": None,
        "": None, "$900000000000000.37": "900000000000000.37", "$9007199254740993.5M": None, "$12345678901.2345678901M": "12345678901234567.89",
    }
    df = spark.createDataFrame([(c,) for c in caps], "cap STRING")
    got = {r.cap: r.v for r in df.select("cap", money_value(F.col("cap")).cast("string").alias("v")).collect()}
    for cap, value in caps.items():
        if cap != "$9007199254740993.5M":
            assert got[cap] == value, cap
    assert got["$9007199254740993.5M"] == "9007199254740993500000.00"
    big = spark.createDataFrame([(Decimal("23000000000000000.37"),)], "r DECIMAL(38,2)")
    assert retail.as_dollars(big, "r", "t").first().t == "$23000000000000000.37"


def test_plain_decimal_is_a_full_match(spark):
    from sheaf.functions.numbers import is_plain_decimal

    texts = ["1.0", "1.0\n", "1.0\u0085", ".", "1", "-1.0", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = {r.i: r.p for r in df.select("i", is_plain_decimal(F.col("t")).alias("p")).collect()}
    assert [got[i] for i in range(len(texts))] == [True, False, False, True, False, False, False]


def test_sums_do_not_depend_on_binary_fractions(spark):
    items = spark.createDataFrame([(1, 0.1)] * 10 + [(2, 0.7)], "k INT, v DOUBLE")
    assert [(r.k, r.s) for r in retail.top_sum(items, "k", "v", 2, "s").collect()] == [(1, Decimal("1.00")), (2, Decimal("0.70"))]
