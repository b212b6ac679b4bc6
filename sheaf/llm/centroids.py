"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Every vector keeps an upper bound on the distance to its own centroid and a lower bound to
each other one, each with the round it was measured in. The centroids of all rounds are
kept. Before a round a bound is loosened by how far its centroid lies from where it was when
the bound was measured, as one norm of the whole displacement; steps that cancel out loosen
nothing. A vector whose upper bound stays below all its lower bounds keeps its centroid
unseen. Otherwise the own distance is measured, and where that does not settle it the
centroids whose bound failed, in whole numbers; so results equal a full search, ties going
to the smaller number.

A round is one pass over a Parquet table of vectors and their bounds, which a task walks in
Arrow batches. It writes the next table and one row of exact sums a task and cluster; Spark
adds these up, and ``k`` rows reach the driver. Tables lie in the shared checkpoint folder,
so a lost executor repeats its own tasks only.

Cases: vectors that are null, of another length or hold null or non-finite components take no
part. A row without an id takes part, but is a first centroid only after all others; repeated
rows each count, and of equal hashes the smaller vector comes first. With fewer than ``k``
vectors each is a centroid; an empty table gives no rows. Extra columns are not read.
Components beyond 2**26 either way are held at that, so that distances fit a long; sums of
distances are null where they do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.mips import usable
from sheaf.session import stored

WIDTH = 64
LARGEST = 1 << 26
ROWS = 16384
# double sums of 64 squares, their roots and the float32 they are stored in: far inside this
SLACK = 1e-5


def scaled(rows: DataFrame, factor: int = 64, width: int = WIDTH) -> DataFrame:
    """vec_id and ``point``: floor(factor * x) of the components of vectors of ``width``."""
    own = rows.filter(usable(F.col("embedding")) & (F.size("embedding") == width))

    def whole(x):
        bounded = F.greatest(F.least(F.floor(x.cast("double") * factor), F.lit(LARGEST)), F.lit(-LARGEST))
        return bounded.cast("int")

    return own.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("point"))


def first_centroids(points: DataFrame, k: int) -> np.ndarray:
    """The points of the ``k`` rows with the smallest sha256 of ``1:<vec_id>``."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = points.select(digest.alias("_hash"), "point").orderBy(F.col("_hash").asc_nulls_last(), "point").limit(k).collect()
    return np.array([r.point for r in rows], np.int64)


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).flatten()).reshape(batch.num_rows, -1)


class Bounds:
    """The bounds of a block of vectors against a history of centroids."""

    def __init__(self, points: np.ndarray, history: list[np.ndarray]):
        self.points, self.history = points, history
        self.now = history[-1]
        n, k = len(points), len(self.now)
        self.low = np.zeros((n, k), np.float32)
        self.round = np.zeros((n, k), np.int16)
        self.cluster = np.zeros(n, np.int32)
        self.measured = 0

    def measure(self, rows: np.ndarray, j: int) -> np.ndarray:
        """Exact squared distances of ``rows`` to centroid ``j``, kept as bounds of this round."""
        gap = self.points[rows] - self.now[j]
        squared = np.einsum("ij,ij->i", gap, gap)
        self.low[rows, j] = np.sqrt(squared.astype(np.float64))
        self.round[rows, j] = len(self.history) - 1
        self.measured += len(rows)
        return squared

    def start(self) -> None:
        """Everything is measured in the first round."""
        every = np.arange(len(self.points))
        best = np.full(len(every), np.iinfo(np.int64).max)
        for j in range(len(self.now)):
            squared = self.measure(every, j)
            closer = squared < best
            best[closer], self.cluster[closer] = squared[closer], j

    def step(self) -> None:
        """One round: ``cluster`` follows the last centroids of the history."""
        moved = np.array([np.sqrt(((self.now - old) ** 2).sum(1, dtype=np.float64)) for old in self.history])
        k = len(self.now)
        drift = moved[self.round, np.arange(k)]
        every = np.arange(len(self.points))
        own = self.cluster
        least = (self.low - drift) * (1 - SLACK) - SLACK
        least[every, own] = np.inf
        most = (self.low[every, own] + drift[every, own]) * (1 + SLACK) + SLACK
        open_ = np.flatnonzero(most >= least.min(1))
        if not len(open_):
            return
        # the own distance first, then every centroid that it does not rule out
        best = np.zeros(len(self.points), np.int64)
        for j in range(k):
            rows = open_[own[open_] == j]
            best[rows] = self.measure(rows, j)
        most[open_] = self.low[open_, own[open_]] * (1 + SLACK) + SLACK
        before = own.copy()
        for j in range(k):
            rows = open_[(least[open_, j] <= most[open_]) & (before[open_] != j)]
            if not len(rows):
                continue
            squared = self.measure(rows, j)
            closer = (squared < best[rows]) | ((squared == best[rows]) & (j < self.cluster[rows]))
            rows, squared = rows[closer], squared[closer]
            self.cluster[rows], best[rows] = j, squared
            most[rows] = self.low[rows, j] * (1 + SLACK) + SLACK

    def distances(self) -> np.ndarray:
        """Exact squared distances to the own centroids."""
        gap = self.points - self.now[self.cluster]
        return np.einsum("ij,ij->i", gap, gap)


STATE = "vec_id long, point array<int>, cluster int, low array<float>, round array<short>, size long, total array<long>, measured long"


def _pass(rows: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """``rows`` with clusters and bounds for the last centroids of the history; a further
    row for each block and cluster has its ``size`` and the ``total`` of its points instead."""
    k = len(history[-1])
    shapes = pa.schema([
        ("vec_id", pa.int64()), ("point", pa.list_(pa.int32())), ("cluster", pa.int32()), ("low", pa.list_(pa.float32())),
        ("round", pa.list_(pa.int16())), ("size", pa.int64()), ("total", pa.list_(pa.int64())), ("measured", pa.int64()),
    ])

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(at, pa.array(values.ravel(), kind))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, totals, measured = np.zeros(k, np.int64), np.zeros(history[-1].shape, object), 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                own = Bounds(_rows(batch, "point").astype(np.int64), history)
                if len(history) == 1:
                    own.start()
                else:
                    own.cluster = np.asarray(batch.column("cluster")).copy()
                    own.low, own.round = _rows(batch, "low").copy(), _rows(batch, "round").copy()
                    own.step()
                measured += own.measured
                sizes += np.bincount(own.cluster, minlength=k)
                member = (own.cluster == np.arange(k)[:, None]).astype(np.float64)
                totals = totals + (member @ own.points).astype(np.int64)  # below 2**41: exact
                none = pa.nulls(batch.num_rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), batch.column("point"), pa.array(own.cluster), lists(own.low, pa.float32()),
                    lists(own.round, pa.int16()), none.cast(pa.int64()), none.cast(pa.list_(pa.int64())), none.cast(pa.int64()),
                ], schema=shapes)
        if sizes.any():
            seen = np.flatnonzero(sizes)
            none = pa.nulls(len(seen))
            yield pa.RecordBatch.from_arrays([
                none.cast(pa.int64()), none.cast(pa.list_(pa.int32())), pa.array(seen, pa.int32()),
                none.cast(pa.list_(pa.float32())), none.cast(pa.list_(pa.int16())), pa.array(sizes[seen]),
                pa.array([[int(x) for x in row] for row in totals[seen]], pa.list_(pa.int64())),
                pa.array([measured] + [0] * (len(seen) - 1), pa.int64()),
            ], schema=shapes)

    return rows.mapInArrow(task, STATE)


def _moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after the sums in ``state``: exact floors of the means; empty clusters
    stay. With the number of distances measured."""
    width = centroids.shape[1]
    parts = state.filter(F.col("size").isNotNull())
    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)]
    rows = parts.groupBy("cluster").agg(F.sum("size").alias("n"), F.sum("measured").alias("measured"), *sums).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster] = [int(r[f"t{i}"]) // r.n for i in range(width)]
    return out, sum(r.measured for r in rows)


def cluster(points: DataFrame, k: int = 16, rounds: int = 3) -> tuple[DataFrame, np.ndarray, list[int]]:
    """vec_id, cluster and distance (squared) of every row of ``points``, the last centroids,
    and how many distances each pass measured."""
    held = stored(points)
    history = [first_centroids(held, k)]
    measured: list[int] = []
    if not len(history[0]):
        return points.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), history[0], measured
    rows = held
    for _ in range(rounds):
        state = stored(_pass(rows, list(history)))
        after, n = _moved(state, history[-1])
        history.append(after)
        measured.append(n)
        rows = state.filter("size IS NULL").select("vec_id", "point", "cluster", "low", "round")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Bounds(_rows(batch, "point").astype(np.int64), history)
            own.cluster = np.asarray(batch.column("cluster")).copy()
            own.low, own.round = _rows(batch, "low").copy(), _rows(batch, "round").copy()
            own.step()
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "cluster": own.cluster, "distance": own.distances()})

    return rows.mapInArrow(finish, "vec_id long, cluster int, distance long"), history[-1], measured


def described(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``clustered`` with the sum of distances of each row's cluster and of all, and the
    digest of its centroid. Only the clusters' own rows are sent to the tasks."""
    held = stored(clustered)
    sums = held.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in sums)
    texts = [",".join(str(int(x)) for x in c) for c in centroids]
    rows = [(r.cluster, _long(int(r.s)), _long(total), sha256(texts[r.cluster].encode()).hexdigest()) for r in sums]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return held.join(F.broadcast(held.sparkSession.createDataFrame(rows, kind)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
