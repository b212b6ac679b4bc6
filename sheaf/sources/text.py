"""Text inputs: one row per line (S1), from files or from a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the line terminators of Hadoop's line reader (\r\n, \r, \n).
LINE_BREAK = r"\r\n|\r|\n"


LINE_ID = "_line_id"


def read_lines(spark: SparkSession, path: str | list[str], line_id: bool = False, recursive: bool = False) -> DataFrame:
    """``value STRING``, one row per line; accepts files, folders and globs
    (``recursive`` also reads the files in sub-folders).

    ``line_id`` adds ``_line_id``, unique per line and taken right at the scan, where the
    row order is fixed by the files, so a retried task gives every line the same id. It
    breaks ties in sorts: a range sort cannot split rows with equal keys, and copies of
    one record may be a third of the input."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    lines = reader.text(path)
    return lines.withColumn(LINE_ID, F.monotonically_increasing_id()) if line_id else lines


def lines_of(df: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """Split a text column into its lines the way a file is read line by line.

    A terminator ends a line, so text ending in a terminator has no extra empty last
    line, and an empty text has no line at all. Output: ``*keep, line``.

    The final terminator is cut before the split (rather than dropping the last piece by
    its position), so the generator input is one expression per text and no per-line
    column refers back to the whole text.
    """
    t = F.col(text_col)
    n = F.length(t)
    body = (
        F.when(t.endswith("\r\n"), t.substr(F.lit(1), n - 2))
        .when(t.endswith("\n") | t.endswith("\r"), t.substr(F.lit(1), n - 1))
        .otherwise(t)
    )
    # The body is cut once, in a projection under the generator.
    cut = df.select(*keep, (t == "").alias("_empty"), body.alias("_body"))
    b = F.col("_body")
    pieces = (
        F.when(F.col("_empty"), F.array().cast("array<string>"))
        .when(b == "", F.array(F.lit("")))
        .otherwise(F.split(b, LINE_BREAK, -1))
    )
    return cut.select(*keep, F.explode(pieces).alias("line"))
