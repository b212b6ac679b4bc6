from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import ann, mips

SF = "/root/testdata/sf0.1"
VECTORS = "vec_id long, embedding array<float>, label int, point string, score int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)


def odd_rows(rng, n=700, d=10):
    """Clusters, many copies of one vector, repeated rows and rows that take no part."""
    centres = rng.normal(size=(5, d))
    rows = [(k, (centres[k % 5] + 0.3 * rng.normal(size=d)).astype(np.float32).tolist()) for k in range(n)]
    hot = rows[0][1]
    rows += [(1000 + k, hot) for k in range(400)]
    rows += [(3, rows[3][1]), (None, hot), (2000, None), (2100, [float("nan")] * d), (2200, [None] * d)]
    rows += [(2300, [float("inf")] * d), (2400, []), (2500, [1.0] * (d + 1)), (2600, [0.0] * d), (2700, [0.0] * (d - 1) + [1e-3])]
    return rows


def good(rows, d, zero):
    out = {}
    for i, v in rows:
        if i is None or v is None or len(v) != d or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            out[i] = np.array(v, np.float32)
    return out


def test_exact_top_k(spark):
    rows = odd_rows(np.random.default_rng(1))
    own = {i: np.floor(1024 * v.astype(float)).astype(np.int64) for i, v in good(rows, 10, True).items()}
    got = mips.search(mips.scaled(table_of(spark, rows).filter("not (vec_id = 3 and embedding is null)").dropDuplicates(["vec_id", "embedding"])),
                      F.col("vec_id") % 100 == 0, shard=128)
    want = []
    for q in (i for i in own if i % 100 == 0):
        best = sorted(((-int(own[q] @ v), i) for i, v in own.items() if i != q))[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_top_k_of_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (100, [0.5, 0.5])]
    got = mips.search(mips.scaled(table_of(spark, rows)), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 100), (100, 1, 0), (100, 2, 1)]
    for found in (
        mips.search(mips.scaled(table_of(spark, [])), F.lit(True)),
        ann.search(ann.vectors(table_of(spark, [])), F.lit(True)),
        mips.search(mips.scaled(table_of(spark, rows)), F.lit(False)),
        ann.search(ann.vectors(table_of(spark, rows)), F.lit(False)),
    ):
        assert found.count() == 0


def test_kd_tree_search_is_exact():
    rng = np.random.default_rng(3)
    points, ids = rng.integers(-300, 300, (2000, 6)), rng.permutation(2000)
    tree = mips.Tree(points.copy(), ids.copy(), leaf=16)
    for q in range(20):
        query = rng.integers(-300, 300, 6)
        want = sorted((-int(s), int(i)) for s, i in zip(points @ query, ids, strict=True) if i != q)[:10]
        assert [(-s, i) for s, i in tree.search(query, q, 10, -np.inf)] == want


def brute_nearest(own, queries, k=10):
    ids = np.array(sorted(own))
    matrix = np.stack([own[i].astype(float) for i in ids])
    out = {}
    for q in queries:
        distance = np.sqrt(((matrix - own[q].astype(float)) ** 2).sum(1))
        order = np.lexsort((ids, distance))
        out[q] = [(int(ids[j]), float(distance[j])) for j in order if ids[j] != q][:k]
    return out


def test_nearest_neighbours_with_all_probes_are_exact(spark):
    rows = odd_rows(np.random.default_rng(2))
    own = good(rows, 10, False)
    points = ann.vectors(table_of(spark, rows))
    got = ann.search(points, F.col("vec_id") % 100 == 0, tables=2, probes=32, shard=64, block=3).collect()
    want = brute_nearest(own, [i for i in own if i % 100 == 0])
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        i, distance = want[r.query_id][r["rank"] - 1]
        assert r.vec_id == i and r.score == pytest.approx(distance, abs=1e-12)


def test_recall_on_random_unit_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 64)) + 2 * rng.normal(size=(10, 64))[rng.integers(0, 10, 3000)] / 3
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = ann.search(ann.vectors(table_of(spark, rows)), F.col("vec_id") % 100 == 0).collect()
    want = brute_nearest(good(rows, 64, False), range(0, 3000, 100))
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert len(got) == 300 and hits >= 0.9 * 300


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(5).normal(size=(7, 16))
    y = ann.hadamard(x)
    assert np.allclose((y**2).sum(1), (x**2).sum(1)) and np.allclose(ann.hadamard(y), x)


def test_recall_of_the_registered_query(spark):
    from sheaf.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op1_ann"](spark, SF).collect()
    want = brute_nearest(good(rows, len(rows[0][1]), False), [i for i, _ in rows if i % 100 == 0])
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))
    scores = {(q, i): s for q, best in want.items() for i, s in best}
    assert all(r.score == pytest.approx(scores[r.query_id, r.vec_id], abs=1e-12) for r in got if (r.query_id, r.vec_id) in scores)
