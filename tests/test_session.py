import datetime

from sheaf.plans.registry import queries
from sheaf.session import checkpoint_dir, scale_settings
from tests.conftest import SF_SMALL


def test_scale_settings_grow_with_input():
    small = scale_settings(10 * 1024**2, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_settings(100 * 1024**4, cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "204800"
    bounded = scale_settings(100 * 1024**4, cores=8000, most_reducers=100_000)
    assert bounded["spark.sql.shuffle.partitions"] == "100000"
    assert int(scale_settings(1024**4, cores=100)["spark.sql.shuffle.partitions"]) == 2048


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["ratings_scan", "orders_until_date", "orders_on_date", "date_parts", "revenue_semi_join"]
    base = {n: sorted(map(tuple, queries()[n](spark, SF_SMALL).collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = {n: sorted(map(tuple, queries()[n](spark, SF_SMALL).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other
    assert isinstance(base["ratings_scan"][0][0], datetime.datetime)
