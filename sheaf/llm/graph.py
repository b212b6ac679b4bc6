"""Small helpers for steps of many rounds: bounded broadcasts and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.session import stored

BROADCAST_ROWS = 500_000


def few(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` (a stored table of one number a row) marked for broadcast if it has at most
    ``limit`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id it is connected to) of every id in ``edges`` (a, b).

    Each round gives every id the smallest component among its neighbours, then follows
    that component's own component; rounds end when nothing changes. Rounds grow with the
    logarithm of a chain's length; each is kept in the checkpoint folder.
    """
    both = stored(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct()
    )
    labels = stored(both.groupBy(F.col("src").alias("id")).agg(F.least("id", F.min("dst")).alias("component")))
    while True:
        near = both.join(labels, F.col("src") == F.col("id")).groupBy("dst").agg(F.min("component").alias("_near"))
        lower = labels.join(near, F.col("id") == F.col("dst"), "left").select(
            "id", F.col("component").alias("_was"), F.least("component", "_near").alias("component")
        )
        of = labels.select(F.col("id").alias("_of"), F.col("component").alias("_further"))
        after = lower.join(of, F.col("component") == F.col("_of"), "left").select(
            "id", "_was", F.least("component", "_further").alias("component")
        )
        labels = stored(after)
        if labels.filter(F.col("component") < F.col("_was")).isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
