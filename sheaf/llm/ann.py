"""Approximate nearest neighbours by cross-polytope hashing.

Each table rotates the vectors pseudo-randomly (three rounds of random signs and a fast
Hadamard transform) and puts a vector into the bucket of the nearest signed axis. A query
looks into its own bucket and the next nearest ones (multiprobe) of every table. Buckets
meet their queries in a cogroup that returns the k nearest of that bucket by the exact
distance; candidates themselves are never written out as pairs. A bucket beyond ``SHARD``
rows is dealt in as many parts as it needs, and so are its queries beyond ``BLOCK``: every
row is indexed and compared, however skewed the buckets are.

Equal vectors cannot both matter beyond the k + 1 smallest ids, so only those are indexed
(no neighbour is lost: ties go to the smaller id). All rows that ask are asked.

Cases: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id; repeated rows count once and a query
never finds its own id; a query with fewer than k candidates found gets those; an empty
table gives none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.mips import usable

TABLES = 8
PROBES = 16
SHARD = 16384
BLOCK = 2048
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row (a power of two wide), normalised."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, -1, 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def signs(tables: int, width: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, ROUNDS, width))


def axes(x: np.ndarray, flips: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of every row under one table's rotation: axis i
    is bucket i, its negative width + i."""
    width = flips.shape[1]
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x
    for flip in flips:
        y = hadamard(y * flip)
    both = np.concatenate([y, -y], 1)
    return np.argsort(-both, 1, kind="stable")[:, :probes]


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and ``point`` (the vector as stored) of the rows that take part."""
    own = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    own = own.filter(F.exists("embedding", lambda x: x != 0))
    return own.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("point"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as doubles; they travel as they are stored."""
    values = np.asarray(column.flatten()).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _hashed(points: DataFrame, width: int, tables: int, probes: int) -> DataFrame:
    """vec_id, point, bucket: a row for each table and probe."""
    flips = signs(tables, 1 << (width - 1).bit_length())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x = _matrix(part.column("point"))
                for t in range(tables):
                    found = axes(x, flips[t], probes) + t * 2 * flips.shape[2]
                    row = np.repeat(np.arange(len(x)), found.shape[1])
                    yield pa.record_batch({
                        "vec_id": part.column("vec_id").take(pa.array(row)),
                        "point": part.column("point").take(pa.array(row)),
                        "bucket": pa.array(found.ravel(), pa.int64()),
                    })

    return points.mapInArrow(task, f"vec_id long, point {points.schema['point'].dataType.simpleString()}, bucket long")


def _nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, distance) of each query's k nearest here, ties to the smaller id."""
    found: list[tuple] = []
    size = (points**2).sum(1)
    for a in range(0, len(queries), 64):
        part = queries[a:a + 64]
        rough = size[None] - 2 * part @ points.T  # squared distance less the query's own size
        for q, query, row in zip(query_ids[a:a + 64].tolist(), part, rough, strict=True):
            own = ids == q
            row[own] = np.inf
            if k + 1 < len(row):
                # rounding of the rough value stays far below this slack
                slack = 1e-9 * (1 + size.max() + query @ query)
                near = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1] + slack)
            else:
                near = np.arange(len(row))
            near = near[~own[near]]
            exact = np.sqrt(((points[near] - query) ** 2).sum(1))
            for i in np.lexsort((ids[near], exact))[:k]:
                found.append((q, int(ids[near[i]]), float(exact[i])))
    return found


def search(
    points: DataFrame, is_query: Column, k: int = 10, tables: int = TABLES, probes: int = PROBES,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance). ``points`` comes from
    ``vectors``; queries are those rows that ``is_query`` holds for."""
    widest = points.groupBy(F.size("point").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if widest is None:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = widest["n"]
    points = points.filter(F.size("point") == width)
    same = Window.partitionBy("point").orderBy("vec_id")
    kept = points.withColumn("_n", F.dense_rank().over(same)).filter(F.col("_n") <= k + 1).drop("_n")
    index = _hashed(kept.dropDuplicates(["vec_id", "point"]), width, tables, 1)
    asking = _hashed(points.filter(is_query).dropDuplicates(["vec_id"]), width, tables, probes)

    def parts(rows: DataFrame, limit: int, name: str) -> DataFrame:
        """Parts of each bucket: a table of 2 * width * tables rows at most."""
        return rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias(name))

    sizes = F.broadcast(parts(index, shard, "shards").join(parts(asking, block, "blocks"), "bucket"))

    def spread(rows: DataFrame, own: str, others: str) -> DataFrame:
        """Each row in its own part of the bucket, once for each of the other side's parts."""
        there = rows.join(sizes, "bucket").withColumn(own[:-1], F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int"))
        return there.withColumn(others[:-1], F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("shards", "blocks")

    def bucket(here: pa.Table, asked: pa.Table) -> pa.Table:
        kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not here.num_rows or not asked.num_rows:
            return kinds.empty_table()
        found = _nearest(
            np.asarray(asked["vec_id"].combine_chunks()), _matrix(asked["point"].combine_chunks()),
            np.asarray(here["vec_id"].combine_chunks()), _matrix(here["point"].combine_chunks()), k,
        )
        return pa.Table.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in found], kinds)

    key = ["bucket", "shard", "block"]
    left, right = spread(index, "shards", "blocks"), spread(asking, "blocks", "shards")
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(bucket, "query_id long, vec_id long, score double")
    once = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
