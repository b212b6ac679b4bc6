from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import centroids

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, point string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 9, "x") for i, v in rows], VECTORS)


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k, rounds, width):
    own = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if usable(v, width)]

    def place(row):
        i, p = row
        return (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", p)

    centres = [list(p) for _, p in sorted(own, key=place)[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, p in own:
            groups[nearest(p)[1]].append(p)
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centres, strict=True)]
    return sorted(((i, nearest(p)[1], nearest(p)[0]) for i, p in own), key=repr), centres


def clumps(seed, n, width, spread=0.2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (7, width))
    return [(int(k), [float(x) for x in (middle[rng.integers(7)] + rng.normal(0, spread, width)).astype(np.float32)]) for k in range(n)]


@pytest.mark.parametrize("seed,k,rounds,spread", [(1, 16, 3, 0.2), (2, 5, 6, 1.0), (3, 1, 2, 0.5)])
def test_equals_full_search(spark, seed, k, rounds, spread):
    rows = clumps(seed, 400, 8, spread)
    rows += rows[:30] + [(None, rows[3][1]), (900, None), (901, [1.0] * 7), (902, [math.nan] * 8), (903, [1.0] * 7 + [None])]
    random.Random(seed).shuffle(rows)
    points = centroids.scaled(table_of(spark, rows).repartition(4), width=8)
    out, last, measured = centroids.cluster(points, k, rounds)
    want, centres = brute(rows, k, rounds, 8)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert last.tolist() == centres
    assert len(measured) == rounds


def test_bounds_leave_most_distances_unmeasured(spark):
    rows = clumps(5, 3000, 16, 0.05)
    _, _, measured = centroids.cluster(centroids.scaled(table_of(spark, rows), width=16), 7, 6)
    assert measured[0] == 7 * 3000
    assert measured[-1] < 0.3 * measured[0]


def test_bounds_use_the_norm_of_the_whole_displacement():
    """A centroid that goes away and comes back leaves the bounds as they were."""
    points = np.array([[0, 0], [10, 0], [12, 0]])
    here = np.array([[0, 0], [11, 0]])
    bounds = centroids.Bounds(points, [here])
    bounds.start()
    back = centroids.Bounds(points, [here, here + 1000, here])
    back.low, back.round, back.cluster = bounds.low.copy(), bounds.round.copy(), bounds.cluster.copy()
    back.step()
    assert back.measured == 0 and back.cluster.tolist() == [0, 1, 1]


def test_few_vectors_ties_and_an_empty_table(spark):
    out, last, _ = centroids.cluster(centroids.scaled(table_of(spark, []), width=2), 16, 3)
    assert out.collect() == [] and len(last) == 0
    assert centroids.described(out, last).collect() == []
    rows = [(k, [float(k % 2), 0.0]) for k in range(6)]
    points = centroids.scaled(table_of(spark, rows), width=2)
    out, last, _ = centroids.cluster(points, 16, 3)
    want, centres = brute(rows, 16, 3, 2)
    assert sorted(tuple(r) for r in out.collect()) == want and last.tolist() == centres


def test_huge_components_are_held_and_sums_that_do_not_fit_are_null(spark):
    rows = [(k, [3e38 if k % 2 else -3e38] * 64) for k in range(40)]
    points = centroids.scaled(table_of(spark, rows))
    assert points.select(F.max(F.abs(F.col("point")[0]))).first()[0] == centroids.LARGEST
    got = centroids.described(*centroids.cluster(points, 1, 1)[:2]).collect()
    assert len(got) == 40 and {r.inertia for r in got} == {None} and min(r.distance for r in got) > 0


def test_digest_columns(spark):
    rows = clumps(8, 100, 64)
    clustered, last, _ = centroids.cluster(centroids.scaled(table_of(spark, rows)), 16, 3)
    want, centres = brute(rows, 16, 3, 64)
    for r in centroids.described(clustered, last).collect():
        assert r.inertia == sum(x[2] for x in want)
        assert r.cluster_inertia == sum(x[2] for x in want if x[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
