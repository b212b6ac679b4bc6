"""The place of every row in a global sort (O1, O2), so that an order can be compared like
any other column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.session import stored


def joined_chunks(
    ordered: DataFrame, group: str, text: str, chunk_bytes: int, separator: str = ",", chunk: str = "chunk"
) -> DataFrame:
    """A4: the texts of each group, joined in the order of ``ordered`` (a global sort by
    ``group`` first): group, chunk (from 0), text. A group's chunks one after another are its
    whole joined text; a text goes to the chunk in which it starts, by its byte offset in the group.

    The sorted rows are stored once. Offsets run inside each of the sort's partitions; what a
    group has in earlier partitions is added from one row a partition and group. A chunk is
    gathered alone, ``chunk_bytes`` and one text at most, so no task holds a group."""
    held = stored(ordered.select(group, F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumns({
        "_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id(),
    }))
    size = F.octet_length("_text") + len(separator.encode())
    pieces = held.groupBy(group, "_part").agg(F.sum(size.cast("long")).alias("_bytes"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col(group).alias("_group"), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_before"),
    )
    # texts of one partition are in place: their offsets run from its first row of the group
    inside = Window.partitionBy(group, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    running = held.withColumn("_own", F.coalesce(F.sum(size.cast("long")).over(inside), F.lit(0)))
    placed = running.join(starts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group")))
    offset = F.col("_before") + F.col("_own")
    shown = F.when(offset == 0, F.col("_text")).otherwise(F.concat(F.lit(separator), F.col("_text")))
    cut = placed.select(group, F.floor(offset / F.lit(chunk_bytes)).alias(chunk), "_row", shown.alias("_shown"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("_row", "_shown"))), lambda x: x["_shown"])
    return cut.groupBy(group, chunk).agg(F.array_join(in_order, "").alias(text))


def numbered(ordered: DataFrame, name: str = "place") -> DataFrame:
    """``ordered`` (the result of a global sort) with each row's place in it, from 1.

    The sorted rows are stored once with their partition and their number there; the sizes
    of the partitions before a row's own (one row a partition) are added to it. No rows are
    gathered: the sort's partitions stay as they are."""
    held = stored(
        ordered.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    )
    own = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = own.select(F.col("_part").alias("_p"), "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = held.join(parts, F.col("_part") == F.col("_p"))
    place = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return placed.select(*ordered.columns, place.alias(name))
