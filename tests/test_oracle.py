"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from sheaf.plans import registry as entry
from sheaf.sources.tables import TABLES
from tests.conftest import SF_SMALL


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("inf" if v == math.inf else "-inf" if v == -math.inf else f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.12g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.queries()) == set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["sector", "ticker_count", "total_cap", "unparsed_caps"]
    assert df.count() > 0


def plain(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle_through_pandas(spark, duck, name):
    """The same comparison on pandas frames with plain ``str`` values: column types must
    agree too (a DECIMAL or a nullable integer changes type on one side only)."""
    pdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(pdf.columns) == sorted(odf.columns)
    rows_s = list(pdf.itertuples(index=False))
    rows_o = list(odf.itertuples(index=False))
    assert plain(list(pdf.columns), rows_s) == plain(list(odf.columns), rows_o)
