"""Exact top-k by inner product with one KD-tree per shard.

Vectors are dealt to shards by a hash of id and vector, and every query visits every shard. A
task reads its shards in order, the vectors of each before its queries: it splits the shard at
medians of its widest axis, keeps the tight box of every node, and walks that one tree for each
query as it streams by, best box first: the largest inner product a box allows is the sum of the
better of its two corners on every axis. A box whose bound does not exceed the query's k-th score
so far is left out. That k-th score starts from the query's own floor: its k-th best over a small
leading set that every task has. The k best of each shard are then merged.

Cases: vectors that are null, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id; of repeated rows each counts, and a
query never finds rows with its own id; ties go to the smaller id; a query with fewer than
k candidates gets them all; an empty table gives none; extra columns are not read. A shard has
about ``SHARD`` rows whatever the table's size: a task holds one shard and a batch of queries. A
vector moves once, a query once a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 8192
LEAF = 256
FLOORS = 512


class Tree:
    """Nodes in arrays: rows [first, last) of the reordered points, children, box."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((ids,))
        self.points, self.ids = points[order], ids[order]
        self.first, self.last, self.left, self.right = [], [], [], []
        low, high = [], []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            node = len(self.first)
            if parent >= 0:
                (self.left if side == 0 else self.right)[parent] = node
            own = self.points[a:b]
            low.append(own.min(0))
            high.append(own.max(0))
            self.first.append(a)
            self.last.append(b)
            self.left.append(-1)
            self.right.append(-1)
            if b - a <= leaf or (low[-1] == high[-1]).all():
                continue
            axis = int((high[-1] - low[-1]).argmax())
            middle = (b - a) // 2
            by = np.argpartition(own[:, axis], middle)
            self.points[a:b], self.ids[a:b] = own[by], self.ids[a:b][by]
            stack += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The largest inner product that each node's box allows."""
        return np.maximum(query * self.low, query * self.high).sum(1)

    def search(self, query: np.ndarray, own_id: int, k: int, floor: float) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, of at least ``floor``."""
        if not len(self.ids):
            return []
        bound = self.bounds(query)
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst kept comes first
        heap = [(-bound[0], 0)]
        kth = floor
        while heap:
            b, node = heapq.heappop(heap)
            if -b < kth:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bound[child] >= kth:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            rows = slice(self.first[node], self.last[node])
            scores, ids = self.points[rows] @ query, self.ids[rows]
            for i in np.flatnonzero((scores >= kth) & (ids != own_id)):
                item = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
                if len(best) == k:
                    kth = max(kth, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def usable(vector: Column) -> Column:
    """Not null, not empty, every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def scaled(rows: DataFrame, factor: int = 1024) -> DataFrame:
    """vec_id and ``point``: floor(factor * x) of every component x, taken as double."""
    own = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    point = F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return own.select(F.col("vec_id").cast("long").alias("vec_id"), point.alias("point"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = np.asarray(flat.flatten())
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0), np.int64)


RESULT = "query_id long, vec_id long, score long"


def search(points: DataFrame, is_query: Column, k: int = 10, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score. ``points`` has vec_id and point (long arrays of one
    length); queries are those rows that ``is_query`` holds for."""
    width = points.groupBy(F.size("point").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = points.filter(F.size("point") == width["n"])
    total = points.count()
    queries = points.filter(is_query).dropDuplicates(["vec_id"])
    shards = -(-total // shard)
    leading = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FLOORS).toArrow()  # a fixed number of rows
    lead_ids, lead = np.asarray(leading["vec_id"].combine_chunks()), _matrix(leading["point"])
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going, held, tree = -1, [], None
        for batch in batches:
            own, asks = np.asarray(batch.column("shard")), np.asarray(batch.column("asks"))
            cuts = np.flatnonzero((np.diff(own) != 0) | (np.diff(asks) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True):
                if a == b:
                    continue
                if own[a] != going:
                    going, held, tree = own[a], [], None
                part = pa.table(batch.slice(a, b - a).select(["vec_id", "point"]))
                if not asks[a]:
                    held.append(part)
                    continue
                if held and tree is None:
                    rows = pa.concat_tables(held)
                    tree = Tree(_matrix(rows["point"]).copy(), np.asarray(rows["vec_id"].combine_chunks()).copy())
                if tree is not None:
                    yield _answers(tree, part)

    def _answers(tree: Tree, asking: pa.Table) -> pa.RecordBatch:
        found: list[tuple[int, int, int]] = []
        for q, query in zip(asking["vec_id"].to_pylist(), _matrix(asking["point"]), strict=True):
            others = (lead @ query)[lead_ids != q]
            floor = np.partition(others, -k)[-k] if len(others) >= k else -np.inf
            found += [(q, i, s) for s, i in tree.search(query, q, k, floor)]
        return pa.record_batch([list(x) for x in zip(*found, strict=True)] if found else [[], [], []], schema=kinds)

    dealt = points.select(F.pmod(F.xxhash64("vec_id", "point"), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "vec_id", "point")
    visits = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    asked = queries.select(visits.alias("shard"), F.lit(1).alias("asks"), "vec_id", "point")
    ordered = dealt.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "asks")
    best = ordered.mapInArrow(task, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
