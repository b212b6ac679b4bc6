import datetime

from sheaf.operators import nested
from sheaf.sources.delimited import parse_tab
from tests.conftest import lines_df

SCHEMA = (
    "cust_id INT, fname STRING, level STRING, phone MAP<STRING,STRING>, order_ids ARRAY<INT>, "
    "order_value STRUCT<min:INT,max:INT,avg:INT,total:INT>"
)


def loyalty(spark):
    # FIXTURES.md 2, "loyalty". The nested schema and the stated answers.
    rows = [
        (1200866, "Ann", "SILVER", {"HOME": "408-555-4914", "WORK": "1"}, [1, 2, 5278505], (1, 9, 5, 401874)),
        (7, "Bob", "GOLD", {"WORK": "2"}, [3], (3, 3, 3, 3)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_map_array_struct_access(spark):
    df = loyalty(spark)
    assert nested.lookup_map(df, "phone", "HOME", "v", key_value=1200866).first().v == "408-555-4914"
    assert nested.lookup_map(df, "phone", "home", "v", key_value=1200866).first().v is None
    assert nested.lookup_map(df, "phone", "HOME", "v", key_value=7).first().v is None
    assert nested.lookup_array(df, "order_ids", 2, "v", key_value=1200866).first().v == 5278505
    assert nested.lookup_array(df, "order_ids", 2, "v", key_value=7).first().v is None
    assert nested.lookup_struct(df, "order_value", "total", "v", key_value=1200866).first().v == 401874
    assert nested.lookup_struct(df, "order_value", "total", "v").count() == 2


def test_rename(spark):
    df = nested.rename_column(loyalty(spark), "level", "status")
    assert df.filter("cust_id = 1200866").select("status").first().status == "SILVER"
    assert dict(df.dtypes)["order_value"] == "struct<min:int,max:int,avg:int,total:int>"


def test_tab_table_bad_cells_become_null(spark):
    # FIXTURES.md 2, "ratings_tsv"
    lines = ["2014-01-02 03:04:05\t1\t2\t4\tgood \"quoted\" text", "not a time\tx\t3\t300\tbad"]
    rows = parse_tab(lines_df(spark, lines), "posted TIMESTAMP_NTZ, cust_id INT, prod_id INT, rating TINYINT, message STRING").collect()
    assert rows[0].posted == datetime.datetime(2014, 1, 2, 3, 4, 5)
    assert (rows[0].cust_id, rows[0].prod_id, rows[0].rating, rows[0].message) == (1, 2, 4, 'good "quoted" text')
    assert (rows[1].posted, rows[1].cust_id, rows[1].prod_id, rows[1].rating) == (None, None, 3, None)
