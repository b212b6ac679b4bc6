"""Table lifecycle in the session catalog (rows S6, T1, T2, T4, T6, T7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheaf.session import file_system
from sheaf.sources.delimited import TAB_OPTIONS


def create_table(spark: SparkSession, name: str, schema: str, fmt: str = "parquet") -> None:
    """An empty typed table."""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING {fmt}")


def create_delimited_table(spark: SparkSession, name: str, schema: str, location: str, sep: str = "\t") -> None:
    """T1/S5 in SQL: a typed table over delimited text files at ``location`` (the Spark
    form of ``ROW FORMAT DELIMITED FIELDS TERMINATED BY``), read with the same options
    as ``delimited.read_tab``: no quoting, a bad cell reads as NULL."""
    options = {**TAB_OPTIONS, "sep": sep, "path": location}
    clause = ", ".join(f"{k} '{sql_text(v)}'" for k, v in options.items())
    spark.sql(f"CREATE TABLE {name} ({schema}) USING csv OPTIONS ({clause})")


def sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'").replace("\t", "\\t")


def load_into(df: DataFrame, name: str) -> None:
    """Append rows to an existing table (by position, like ``LOAD DATA``); run twice, it
    appends twice (``loads`` has the repeatable form)."""
    df.write.insertInto(base_table(df.sparkSession, name), overwrite=False)


def save_as_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """A table holding ``df``."""
    df.write.format(fmt).mode(mode).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """T1 for a table joined often on ``key``: rows hashed into ``buckets`` files per
    write task and sorted by ``key``. A later join on ``key`` reads the table already
    partitioned, so only the other side is shuffled (to the same bucket count)."""
    df.write.format(fmt).bucketBy(buckets, key).sortBy(key).mode("errorifexists").saveAsTable(name)


def rename_column_view(spark: SparkSession, table: str, old: str, new: str, view: str) -> DataFrame:
    """T2/T5 for one session: a view exposing ``table`` with ``old`` renamed to ``new``."""
    df = spark.table(table).withColumnRenamed(old, new)
    df.createOrReplaceTempView(view)
    return df


# The properties of a renaming view that names the table behind it, and of a table whose files
# lie in a folder that goes with it.
BASE = "sheaf.base_table"
OWN_FOLDER = "sheaf.own_folder"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def base_table(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of ``name``: its own, or that behind its renaming view."""
    return _properties(spark, name).get(BASE, name)


def rename_column(spark: SparkSession, name: str, old: str, new: str) -> None:
    """A column of a catalog table renamed for every session; no data is rewritten.

    The session catalog refuses to rename a Parquet table's column, so the table steps behind a
    view of its own name that maps the columns; further renames change the view's map. The
    name can be queried, described, renamed, loaded (``load_into``) and dropped as before."""
    columns = spark.table(name).columns
    if old not in columns or new in columns:
        raise ValueError(f"cannot rename {old!r} to {new!r} in {name} with the columns {columns}")
    base = base_table(spark, name)
    if base == name:
        base = f"{name}__base"
        spark.sql(f"ALTER TABLE {name} RENAME TO {base}")
        spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{BASE}' = '{base}') AS SELECT * FROM {base}")
    shown = [new if c == old else c for c in columns]
    pairs = zip(spark.table(base).columns, shown, strict=True)
    spark.sql(f"ALTER VIEW {name} AS SELECT {', '.join(f'`{c}` AS `{as_}`' for c, as_ in pairs)} FROM {base}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """T4: ``ALTER TABLE old RENAME TO new`` (or its renaming view); the data stays."""
    kind = "TABLE" if base_table(spark, old) == old else "VIEW"
    spark.sql(f"ALTER {kind} {old} RENAME TO {new}")


def drop_table(spark: SparkSession, name: str) -> None:
    """The table, and where columns were renamed its view as well."""
    if not spark.catalog.tableExists(name):
        return
    base = base_table(spark, name)
    if base != name:
        spark.sql(f"DROP VIEW {name}")
    folder = _properties(spark, base).get(OWN_FOLDER)
    spark.sql(f"DROP TABLE IF EXISTS {base}")
    if folder:
        fs, target = file_system(spark, folder)
        fs.delete(target, True)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE name``."""
    return spark.sql(f"DESCRIBE {name}")


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """One SQL statement; ``{name}`` placeholders bind DataFrames without global views."""
    return spark.sql(text, **frames)
