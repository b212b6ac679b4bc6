"""Exact sums in limbs, both top lists in one pass, joined texts in bounded chunks."""

import decimal
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.functions.money import cents, limbs, merged_cents
from sheaf.operators import growth, retail, screener
from sheaf.operators.ordering import joined_chunks
from sheaf.plans.registry import queries
from tests.conftest import SF_SMALL
from tests.test_plans import physical

AMOUNTS = st.one_of(
    st.floats(-1e12, 1e12, allow_nan=False),
    st.integers(-10**15, 10**15).map(lambda n: n / 100),
    st.integers(-10**8, 10**8).map(lambda n: n / 1000),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.none() | AMOUNTS, max_size=200))
def test_limb_sums_equal_decimal_sums(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x DOUBLE")
    high, low = limbs(cents(F.col("x")))
    got = df.agg(F.sum(high).alias("h"), F.sum(low).alias("l")).select(merged_cents(F.col("h"), F.col("l")).alias("s")).first().s
    want = df.agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("decimal(38,2)").alias("s")).first().s
    assert got == want


def test_half_cents_round_as_decimals_do(spark):
    xs = [0.145, 1.005, -0.145, 2.675, 0.005, -0.005, 1e15 + 0.125, 0.125, 0.135]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE")
    rows = df.select(cents(F.col("x")).alias("c"), (F.col("x").cast("decimal(18,2)") * 100).cast("bigint").alias("d")).collect()
    assert [r.c for r in rows] == [r.d for r in rows]


def test_sums_beyond_a_long(spark):
    n = 200_000
    df = spark.range(n).select(F.lit(9e15).alias("x"), F.lit(1).alias("k"))
    top = retail.top_sum(df, "k", "x", 1, "total").first()
    assert top.total == decimal.Decimal(n) * decimal.Decimal(9 * 10**15) and n * 9 * 10**17 > 2**63


def test_no_decimal_in_the_partial_aggregate(spark):
    items = spark.createDataFrame([(1, 2.5)], "k INT, x DOUBLE")
    assert dict(items.groupBy("k").agg(*retail._limb_sums("x")).dtypes) == {"k": "int", "_high": "bigint", "_low": "bigint"}
    plan = physical(queries()["top3_quantity_named"](spark, SF_SMALL))
    partial = [line for line in plan.splitlines() if "partial_sum" in line]
    assert partial and all("shiftright" in line or "partial_sum(_high" in line for line in partial)


def test_both_lists_come_from_one_join(spark):
    df = queries()["top_lists"](spark, SF_SMALL)
    plan = physical(df)
    joined = physical(queries()["listing_join"](spark, SF_SMALL))
    assert plan.count("Join") == joined.count("Join") == 1
    assert plan.count("Scan parquet") == joined.count("Scan parquet")
    assert "WindowGroupLimit" in plan
    for column in ("growth", "dividend"):
        want = [tuple(r) for r in growth.top_k(queries()["listing_growth"](spark, SF_SMALL), column, 10).collect()]
        assert [(r.symbol, r.value) for r in sorted(df.collect(), key=lambda r: r.place) if r.list == column] == want


def test_top_lists_with_ties_nulls_and_few_rows(spark):
    rows = [("b", 1.0, None), ("a", 1.0, 5.0), ("c", None, 5.0), ("c", 0.0, 5.0)]
    df = spark.createDataFrame(rows, "symbol STRING, growth DOUBLE, dividend DOUBLE")
    got = [tuple(r) for r in growth.top_lists(df, ["growth", "dividend"], 3).orderBy("list", "place").collect()]
    assert got == [
        ("dividend", 1, "a", 5.0), ("dividend", 2, "c", 5.0), ("dividend", 3, "c", 5.0),
        ("growth", 1, "a", 1.0), ("growth", 2, "b", 1.0), ("growth", 3, "c", 0.0),
    ]
    assert growth.top_lists(df.limit(0), ["growth"], 3).collect() == []


def test_chunks_one_after_another_are_the_whole_text(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["A", "B", None]), rng.choice(["", "é", "TICK", f"T{rng.randint(0, 500)}", None]), rng.random())
        for _ in range(3000)
    ]
    rows += [("Hot", f"T{i:05d}", 0.0) for i in range(1500)] + [("One", "", 1.0)]
    df = spark.createDataFrame(rows, "sector STRING, ticker STRING, x DOUBLE")
    for size in (7, 100, 1 << 20):
        got = joined_chunks(df.orderBy("sector", "ticker"), "sector", "ticker", size).collect()
        texts = {}
        for r in sorted(got, key=lambda r: r.chunk):
            texts.setdefault(r.sector, []).append(r.ticker)
            assert len(r.ticker.encode()) <= size + 8
        for sector in ("A", "B", None, "Hot", "One"):
            own = sorted((t or "") for s, t, _ in rows if s == sector)
            assert "".join(texts[sector]) == ",".join(own)
    chunks = joined_chunks(df.orderBy("sector", "ticker"), "sector", "ticker", 100)
    assert chunks.filter("sector = 'Hot'").count() >= 1500 * 7 // 100


def test_sector_ticker_text_gathers_no_sector(spark):
    rows = [("Tech", f"T{i}", None, None) for i in range(500)]
    screened = spark.createDataFrame(rows, "sector STRING, ticker STRING, cap DOUBLE, cap_double DOUBLE")
    got = screener.sector_ticker_text(screened, 64).collect()
    assert max(len(r.tickers) for r in got) <= 70
    assert "".join(r.tickers for r in sorted(got, key=lambda r: r.chunk)) == ",".join(sorted(t for _, t, _, _ in rows))
