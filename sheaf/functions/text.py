"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's word separator (a run of ASCII non-word characters)
# and the word-character class. Java's \W and \w are ASCII-only, as in Spark's regex.
WORD_SEPARATOR = r"\W+"
WORD_CHAR = r"\w"


def split_words(text: Column) -> Column:
    """All pieces of ``text`` between separators, empty pieces included."""
    return F.split(text, WORD_SEPARATOR, -1)


def java_split_candidates(line: Column) -> Column:
    """Pieces of a line to explode with their index; ``keep_java_piece`` then keeps
    exactly the pieces Java's ``String.split(regex)`` returns.

    Java returns ``[""]`` for an empty line where Spark's ``split`` returns ``[]``.
    """
    return F.when(line == "", F.array(F.lit(""))).otherwise(split_words(line))


def keep_java_piece(word: Column, index: Column, line: Column) -> Column:
    """Rule D1. Java drops trailing empty pieces and keeps a leading empty piece only
    when a word follows it; an empty line yields one empty word. A run of separators
    never leaves an empty piece in the middle, so empty pieces sit only at the ends."""
    return (word != "") | ((index == 0) & ((line == "") | line.rlike(WORD_CHAR)))
