import datetime

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.operators import catalog, loads, nested
from sheaf.plans.oracle import ORACLE_SQL
from sheaf.plans.queries import QUERIES
from sheaf.sources.nested_text import DEFAULT_DELIMITED, NestedFormat, nested_line, parse_nested, read_nested
from sheaf.sources.tables import SCHEMAS
from tests.conftest import lines_df

# FIXTURES.md 2, "loyalty". The nested schema and the stated answers.
SCHEMA = (
    "cust_id INT, fname STRING, lname STRING, email STRING, level STRING, phone MAP<STRING,STRING>, "
    "order_ids ARRAY<INT>, order_value STRUCT<min:INT,max:INT,avg:INT,total:INT>"
)
LINES = [
    "1200866|Ann|Lee|a@x|SILVER|HOME:408-555-4914,WORK:1|1,2,5278505|1,9,5,401874",
    "7|Bob||b@x|GOLD||3|3,3,3,3",
]


def test_stated_answers(spark):
    df = parse_nested(lines_df(spark, LINES), SCHEMA)
    assert [f.dataType.simpleString() for f in df.schema.fields][5:] == [
        "map<string,string>", "array<int>", "struct<min:int,max:int,avg:int,total:int>"]
    assert nested.lookup_map(df, "phone", "HOME", "v", key_value=1200866).first().v == "408-555-4914"
    assert nested.lookup_array(df, "order_ids", 2, "v", key_value=1200866).first().v == 5278505
    assert nested.lookup_struct(df, "order_value", "total", "v", key_value=1200866).first().v == 401874
    bob = df.filter("cust_id = 7").first()
    assert (bob.lname, bob.phone, bob.order_ids) == ("", {}, [3])


def test_short_bad_and_missing_parts(spark):
    lines = [
        r"x|\N|b||\N|HOME,WORK:2,WORK:3,:4,A:\N|1,x,,99999999999,3|1,2",
        "5|a",
        "",
        "6|a|b|c|d|k:v:w||1,2,3,4,5|more|fields",
    ]
    rows = parse_nested(lines_df(spark, [*lines, None]), SCHEMA).collect()
    assert rows[0].asDict() | {"phone": 0, "order_value": 0} == {
        "cust_id": None, "fname": None, "lname": "b", "email": "", "level": None,
        "phone": 0, "order_ids": [1, None, None, None, 3], "order_value": 0}
    assert rows[0].phone == {"HOME": None, "WORK": "2", "": "4", "A": None}
    assert tuple(rows[0].order_value) == (1, 2, None, None)
    assert (rows[1].cust_id, rows[1].fname, rows[1].lname, rows[1].phone, rows[1].order_value) == (5, "a", None, None, None)
    assert rows[2].cust_id is None and rows[2].fname is None
    assert rows[3].phone == {"k": "v:w"} and rows[3].order_ids == [] and tuple(rows[3].order_value) == (1, 2, 3, 4)
    assert all(v is None for v in rows[4])


def test_delimiters_are_parameters(spark):
    line = "\x01".join(["1", "a|b", "c", "d", "e", "H\x03x:y\x02W\x03z", "4\x025", "1\x022\x023\x024"])
    row = parse_nested(lines_df(spark, [line]), SCHEMA, DEFAULT_DELIMITED).first()
    assert (row.fname, row.phone, row.order_ids, row.order_value.total) == ("a|b", {"H": "x:y", "W": "z"}, [4, 5], 4)
    dotted = parse_nested(lines_df(spark, ["1.2*3.a^b"]), "a INT, b ARRAY<INT>, c MAP<STRING,STRING>", NestedFormat(".", "*", "^")).first()
    assert (dotted.a, dotted.b, dotted.c) == (1, [2, 3], {"a": "b"})
    for bad in [dict(field="||"), dict(field=","), dict(escape="|")]:
        with pytest.raises(ValueError):
            NestedFormat(**bad)
    with pytest.raises(ValueError):
        parse_nested(lines_df(spark, []), "a ARRAY<ARRAY<INT>>")


ANY = st.text(alphabet="ab|,:\\N é", max_size=5)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(
    st.none() | st.integers(-5, 5), st.none() | ANY, st.none() | st.dictionaries(ANY, st.none() | ANY, max_size=3),
    st.none() | st.lists(st.none() | ANY, max_size=3).filter(lambda x: x not in ([""], [None])),
    st.none() | st.tuples(st.none() | ANY, st.none() | st.integers(0, 9))), min_size=1, max_size=4))
def test_escaped_lines_read_back(spark, rows):
    schema = "a INT, b STRING, m MAP<STRING,STRING>, l ARRAY<STRING>, s STRUCT<x:STRING,y:INT>"
    fmt = NestedFormat(escape="\\", null="~")
    df = spark.createDataFrame(rows, schema)
    back = parse_nested(df.select(nested_line(df, fmt).alias("value")), schema, fmt)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def test_a_load_that_is_run_again(spark, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir()
    second.mkdir()
    (first / "loyalty_data.txt").write_text("\n".join(LINES) + "\n")
    (second / "a.txt").write_text("8|C|D|e|GOLD|HOME:1|1|1,1,1,1\n")
    catalog.drop_table(spark, "loyalty_loads")
    loads.create_loaded_table(spark, "loyalty_loads", SCHEMA)
    try:
        assert spark.table("loyalty_loads").count() == 0
        loads.load_nested(spark, str(first), "loyalty_loads", "day 1")
        loads.load_nested(spark, str(second), "loyalty_loads", "day 2")
        once = sorted(map(str, spark.table("loyalty_loads").collect()))
        loads.load_nested(spark, str(first), "loyalty_loads", "day 1")
        assert sorted(map(str, spark.table("loyalty_loads").collect())) == once
        assert {r.load_id: r.n_rows for r in loads.loads(spark, "loyalty_loads").collect()} == {"day 1": 2, "day 2": 1}
        got = spark.sql("SELECT phone['HOME'] AS home, order_ids[2] AS third FROM loyalty_loads WHERE cust_id = 1200866").first()
        assert (got.home, got.third) == ("408-555-4914", 5278505)
        # an empty load replaces what its first try has left
        loads.load(spark.table("loyalty_loads").filter("false").drop("load_id"), "loyalty_loads", "day 2")
        assert {r.load_id for r in loads.loads(spark, "loyalty_loads").collect()} == {"day 1"}
        with pytest.raises(ValueError):
            loads.load(spark.range(1), "loyalty_loads", "day 3")
    finally:
        catalog.drop_table(spark, "loyalty_loads")


def test_a_load_whose_first_try_fails(spark):
    catalog.drop_table(spark, "day_loads")
    loads.create_loaded_table(spark, "day_loads", "k BIGINT, at DATE")
    try:
        loads.load(spark.sql("SELECT id, DATE'2014-05-17' FROM range(10)"), "day_loads", "it's day 1")
        broken = spark.sql("SELECT id, CAST(if(id < 90, '2014-05-18', 'no day') AS DATE) FROM range(0, 100, 1, 5)")
        with pytest.raises(Exception, match="no day"):
            loads.load(broken, "day_loads", "day 2")
        assert spark.table("day_loads").count() == 10
        loads.load(spark.sql("SELECT id, DATE'2014-05-18' FROM range(100)"), "day_loads", "day 2")
        loads.load(spark.sql("SELECT id, DATE'2014-05-17' FROM range(3)"), "day_loads", "it's day 1")
        loads.load(spark.sql("SELECT id, DATE'2014-05-17' FROM range(0)"), "day_loads", "it's day 1")
        assert spark.table("day_loads").count() == 100
        assert spark.table("day_loads").first()["at"] == datetime.date(2014, 5, 18)
    finally:
        catalog.drop_table(spark, "day_loads")


def test_files_of_the_default_delimiters(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\x01k\x03v\n2\x01\n")
    rows = read_nested(spark, str(tmp_path), "a INT, m MAP<STRING,STRING>", DEFAULT_DELIMITED).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, {"k": "v"}), (2, {})]


def test_loyalty_table_with_customers_without_orders(spark, tmp_path):
    customers = [(k, f"Customer#{k:09d}", 1, 900.0 * (k % 8), "AUTO") for k in range(60)]
    orders = [(100 + k, k % 7, "F", 10.0 + k, None, "1-URGENT") for k in range(30)]
    for name, rows in (("customer", customers), ("orders", orders)):
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("customer", "orders"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(f"SELECT load_id, status, n_statements, n_home, n_first_orders, total_value FROM ({ORACLE_SQL['loyalty_table']})").fetchall()
    got = [tuple(r) for r in QUERIES["loyalty_table"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[2] for r in got) == 60 and 0 < sum(r[4] for r in got) <= 7
