"""Word counts (rows P1, P2, F1, A1, A2, O1).

Two variants: ``word_count`` drops empty words (the MapReduce job); ``word_count_raw``
keeps the empty word exactly where Java's ``split`` produces it (the RDD job, rule D1).
Both rely on partial aggregation: every task folds its words before the shuffle, so a
word that makes up a third of the corpus still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import java_split_candidates, keep_java_piece, split_words
from sheaf.sources.text import lines_of


def words(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per non-empty word. Line breaks are separators, so whole texts split
    the same as their lines."""
    return (
        df.select(F.explode(split_words(F.col(text_col))).alias("word"))
        .filter(F.col("word") != "")
    )


def raw_words(df: DataFrame, text_col: str = "value", by_lines: bool = True) -> DataFrame:
    """One row per piece of each line as Java's ``String.split`` gives it.

    With ``by_lines`` the column holds whole texts and is cut into lines first; with
    ``by_lines=False`` each row already is one line (a ``spark.read.text`` scan).
    """
    lines = lines_of(df, text_col) if by_lines else df.select(F.col(text_col).alias("line"))
    pieces = lines.select("line", F.posexplode(java_split_candidates(F.col("line"))).alias("i", "word"))
    return pieces.filter(keep_java_piece(F.col("word"), F.col("i"), F.col("line"))).select("word")


def count_words(word_rows: DataFrame) -> DataFrame:
    return word_rows.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``word, occurrences`` with empty words dropped (A1)."""
    return count_words(words(df, text_col))


def word_count_raw(df: DataFrame, text_col: str = "value", by_lines: bool = True) -> DataFrame:
    """``word, occurrences`` including the empty word (A2)."""
    return count_words(raw_words(df, text_col, by_lines))


def sorted_by_word(counts: DataFrame) -> DataFrame:
    """Global ascending sort in byte order (range-partitioned, no single task)."""
    return counts.orderBy(F.col("word").asc())
