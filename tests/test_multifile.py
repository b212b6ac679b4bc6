"""Results do not depend on how the input is split: every registered query against its
oracle on a multi-file copy of the smallest tables (keys offset so joins stay consistent)."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from sheaf.plans import registry as entry
from sheaf.sources.tables import TABLES, table
from tests.conftest import SF_SMALL
from tests.test_oracle import canon

COPIES = 20
OFFSET_KEYS = {
    "documents": ["doc_id"],
    "customer": ["c_custkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey"],
    "events": ["event_id"],
}


@pytest.fixture(scope="module")
def multi_dir(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("multifile")
    for name in TABLES:
        df = table(spark, SF_SMALL, name)
        if name in OFFSET_KEYS:
            df = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
            for key in OFFSET_KEYS[name]:
                df = df.withColumn(key, F.col(key) * COPIES + F.col("copy"))
            df = df.drop("copy")
        df.repartition(4).write.parquet(str(out / f"{name}.parquet"))
    return str(out)


@pytest.fixture(scope="module")
def duck_multi(multi_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{multi_dir}/{name}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle_on_split_input(spark, multi_dir, duck_multi, name):
    df = entry.queries()[name](spark, multi_dir)
    rel = duck_multi.sql(entry.oracle_sql()[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())
