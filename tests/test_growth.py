from sheaf.operators import growth


def frames(spark):
    fund = spark.createDataFrame(
        [
            ("A", "1.5", "10.0", "15.0"),
            ("B", "n/a", "n/a", "12.0"),
            ("C", "", "0.0", "0.0"),
            ("D", "2.0", "20.0", "30.0"),
            ("E", "2.0", "4.0", "6.0"),
            ("X", "9.0", "1.0", "2.0"),
        ],
        "symbol STRING, dividend STRING, week52_low STRING, week52_high STRING",
    )
    listings = spark.createDataFrame(
        [("A", "Tech"), ("B", "Tech"), ("C", "Fin"), ("D", "Fin"), ("E", "Fin"), ("E", "Dup"), ("Z", "Only")],
        "symbol STRING, sector STRING",
    )
    return fund, listings


def test_join_keeps_matches_and_multiplicity(spark):
    fund, listings = frames(spark)
    joined = growth.join_on_symbol(fund, listings)
    assert sorted(r.symbol for r in joined.collect()) == ["A", "B", "C", "D", "E", "E"]
    assert growth.count_symbols(joined).first().n_symbols == 6
    assert set(joined.columns) == {"symbol", "dividend", "week52_low", "week52_high", "sector"}


def test_growth_rules(spark):
    fund, listings = frames(spark)
    got = {r.symbol: r for r in growth.growth_table(growth.join_on_symbol(fund, listings)).collect()}
    assert got["A"].growth == 50.0 and got["A"].dividend == 1.5
    assert got["B"].dividend == 0.0 and got["B"].growth is None  # low n/a -> 0 -> no growth
    assert got["C"].dividend == 0.0 and got["C"].growth is None


def test_top_k_nulls_last_and_ties_by_symbol(spark):
    fund, listings = frames(spark)
    table = growth.growth_table(growth.join_on_symbol(fund, listings))
    top = [(r.symbol, r.growth) for r in growth.top_k(table, "growth", 4).collect()]
    assert top == [("A", 50.0), ("D", 50.0), ("E", 50.0), ("E", 50.0)]
    top_div = [r.symbol for r in growth.top_k(table, "dividend", 3).collect()]
    assert top_div == ["D", "E", "E"]
    assert [r.symbol for r in growth.top_k(table, "growth", 10).collect()][-2:] == ["B", "C"]


def test_growth_report_reads_checkpointed_table(spark):
    fund, listings = frames(spark)
    report = growth.growth_report(fund, listings, k=2)
    assert report["count"].first().n_symbols == 6
    assert [r.symbol for r in report["top_growth"].collect()] == ["A", "D"]
    plan = report["top_growth"]._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan  # the join ran once, before the checkpoint
