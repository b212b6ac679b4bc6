from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sheaf.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="sheaf-warehouse-")
    session = get_session(
        "local[*]",
        app_name="sheaf-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sheaf-shared-")},
    )
    yield session
    session.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value STRING")
