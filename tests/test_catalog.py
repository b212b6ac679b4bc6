import pytest

from sheaf.operators import catalog


def test_table_lifecycle(spark):
    catalog.drop_table(spark, "loyalty_program")
    catalog.drop_table(spark, "reward_program")
    catalog.create_table(spark, "loyalty_program", "cust_id INT, level STRING")
    rows = spark.createDataFrame([(1200866, "SILVER"), (7, "GOLD")], "cust_id INT, level STRING")
    catalog.load_into(rows, "loyalty_program")
    catalog.load_into(rows.limit(1), "loyalty_program")
    assert spark.table("loyalty_program").count() == 3
    described = {r.col_name: r.data_type for r in catalog.describe_table(spark, "loyalty_program").collect()}
    assert described["cust_id"] == "int" and described["level"] == "string"
    catalog.rename_table(spark, "loyalty_program", "reward_program")
    assert not spark.catalog.tableExists("loyalty_program")
    view = catalog.rename_column_view(spark, "reward_program", "level", "status", "reward_program_v")
    assert "status" in view.columns
    got = spark.sql("SELECT status FROM reward_program_v WHERE cust_id = 1200866").collect()
    assert [r.status for r in got] == ["SILVER", "SILVER"]
    catalog.drop_table(spark, "reward_program")
    assert not spark.catalog.tableExists("reward_program")


def test_save_as_table(spark):
    catalog.drop_table(spark, "ratings_t")
    df = spark.createDataFrame([(1, 5)], "cust_id INT, rating TINYINT")
    catalog.save_as_table(df, "ratings_t")
    assert spark.table("ratings_t").first().rating == 5
    catalog.drop_table(spark, "ratings_t")


def test_tab_delimited_table_in_sql(spark, tmp_path):
    import datetime

    location = tmp_path / "ratings"
    location.mkdir()
    (location / "part1.tsv").write_text("2014-01-02 03:04:05\t1\t2\t4\tfine\n2014-01-03 00:00:00\t3\t4\t300\tbad rating\n")
    catalog.drop_table(spark, "ratings")
    catalog.create_delimited_table(
        spark, "ratings", "posted TIMESTAMP_NTZ, cust_id INT, prod_id INT, rating TINYINT, message STRING", str(location)
    )
    try:
        assert spark.sql("SELECT count(*) AS n FROM ratings").first().n == 2
        rows = {r.cust_id: r for r in spark.table("ratings").collect()}
        assert rows[1].posted == datetime.datetime(2014, 1, 2, 3, 4, 5) and rows[1].rating == 4
        assert rows[3].rating is None and rows[3].message == "bad rating"
        # LOAD DATA: more rows appended to the same table
        more = spark.createDataFrame(
            [(datetime.datetime(2014, 1, 4), 5, 6, 1, "more")],
            "posted TIMESTAMP_NTZ, cust_id INT, prod_id INT, rating TINYINT, message STRING",
        )
        catalog.load_into(more, "ratings")
        assert spark.sql("SELECT count(*) AS n FROM ratings").first().n == 3
    finally:
        catalog.drop_table(spark, "ratings")


def test_renamed_column_outlives_the_session(spark):
    for name in ("loyalty_t", "reward_t"):
        catalog.drop_table(spark, name)
    catalog.create_table(spark, "loyalty_t", "cust_id INT, level STRING, phone MAP<STRING,STRING>")
    rows = spark.createDataFrame([(1200866, "SILVER", {"HOME": "1"}), (7, "GOLD", None)], "cust_id INT, level STRING, phone MAP<STRING,STRING>")
    try:
        catalog.load_into(rows, "loyalty_t")
        catalog.rename_column(spark, "loyalty_t", "level", "status")
        other = spark.newSession()
        assert other.sql("SELECT status FROM loyalty_t WHERE cust_id = 1200866").first().status == "SILVER"
        assert [r.col_name for r in catalog.describe_table(other, "loyalty_t").collect()] == ["cust_id", "status", "phone"]
        catalog.rename_table(spark, "loyalty_t", "reward_t")
        other = spark.newSession()
        assert not other.catalog.tableExists("loyalty_t")
        assert other.sql("SELECT status FROM reward_t WHERE cust_id = 1200866").first().status == "SILVER"
        # the map follows further renames, and loads reach the rows behind it
        catalog.rename_column(other, "reward_t", "phone", "numbers")
        catalog.load_into(rows.limit(1), "reward_t")
        got = spark.sql("SELECT cust_id, status, numbers['HOME'] AS home FROM reward_t").collect()
        assert len(got) == 3 and sum(r.home == "1" for r in got) >= 1
        with pytest.raises(ValueError):
            catalog.rename_column(spark, "reward_t", "level", "x")
        with pytest.raises(ValueError):
            catalog.rename_column(spark, "reward_t", "status", "cust_id")
    finally:
        catalog.drop_table(spark, "reward_t")
    assert not spark.catalog.tableExists("reward_t") and not spark.catalog.tableExists("loyalty_t__base")
