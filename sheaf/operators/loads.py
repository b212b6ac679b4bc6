"""Loads that can be run again (row S6).

A loaded table keeps each load in a partition of its own, named by a load id. Loading the
same id again replaces that partition alone, so a load that failed half-way, or whose answer
got lost, is simply run again: twice equals once, and no other load is touched.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.catalog import OWN_FOLDER, base_table, sql_text
from sheaf.sources.nested_text import NestedFormat, read_nested

LOAD_ID = "load_id"


def create_loaded_table(spark: SparkSession, name: str, schema: str, fmt: str = "parquet", location: str | None = None) -> None:
    """An empty table of ``schema`` (nested types too), partitioned by the load. An
    overwrite replaces the partitions it has rows for, when it commits.

    Its files lie in a folder of their own (``location``, by default a new one below the
    warehouse), which a renamed table keeps and ``catalog.drop_table`` deletes."""
    if spark.catalog.tableExists(name):
        return
    folder = location or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), f"loads-{uuid.uuid4()}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}, {LOAD_ID} STRING) USING {fmt} "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({LOAD_ID}) "
        f"LOCATION '{sql_text(folder)}' TBLPROPERTIES ('{OWN_FOLDER}' = '{sql_text(folder)}')"
    )


def load(df: DataFrame, name: str, load_id: str) -> None:
    """The rows of ``df`` as load ``load_id`` of the table, in place of what an earlier
    try of that load has left. The partition appears when the write commits."""
    names = [c for c in df.sparkSession.table(name).columns if c != LOAD_ID]
    if len(df.columns) != len(names):
        raise ValueError(f"{name} has the columns {names}, the load has {df.columns}")
    marked = df.toDF(*names).withColumn(LOAD_ID, F.lit(load_id))
    base = base_table(df.sparkSession, name)
    if df.isEmpty():  # an overwrite by partition leaves alone what it has no rows for
        _empty(df, base, load_id)
        return
    marked.write.insertInto(base, overwrite=True)


def _empty(rows: DataFrame, base: str, load_id: str) -> None:
    """A load without rows: its partition and files go (the files of a folder of its own stay
    behind a dropped partition, so an overwrite empties it first)."""
    spark, partition = rows.sparkSession, f"PARTITION ({LOAD_ID} = '{sql_text(load_id)}')"
    none = spark.createDataFrame([], rows.schema)
    spark.sql(f"INSERT OVERWRITE TABLE {base} {partition} SELECT * FROM {{none}}", none=none)
    spark.sql(f"ALTER TABLE {base} DROP IF EXISTS {partition}")


def load_nested(
    spark: SparkSession, path: str | list[str], name: str, load_id: str, fmt: NestedFormat = NestedFormat()
) -> None:
    """Nested text files into a loaded table, by the table's own column types."""
    fields = [f for f in spark.table(name).schema.fields if f.name != LOAD_ID]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    load(read_nested(spark, path, ddl, fmt), name, load_id)


def loads(spark: SparkSession, name: str) -> DataFrame:
    """load_id and n_rows of every load in the table."""
    return spark.table(name).groupBy(LOAD_ID).agg(F.count(F.lit(1)).alias("n_rows"))
