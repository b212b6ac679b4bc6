from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheaf.llm import packing
from tests.llm.conftest import docs_df, odd_texts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "The", " ", "  ", "\n", "\t", "é", "É", "ß", "İ", "Σ", "日本", "1", "23", "'s", "'LL", "...", "!!",
    "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85", "\xa0", "é", " ́", "\U0001f600", "ǅ", "​",
    "٣", "²", "Ａ", "word.", "word,", "Éa,",
]


OWN = Tokenizer.from_file(PATH)


def ids_of(text):
    return OWN.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, got, room=packing.SEQUENCE):
    """Every id lies in exactly one piece; sequences are gapless and within bounds."""
    want = {}
    for i, t in rows:
        want.setdefault(i, ids_of(t))
    copies = defaultdict(int)
    for i, _ in rows:
        copies[i] += 1
    starts = defaultdict(list)
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and 0 < r.length <= room
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        starts[r.doc_id].append((r.start, r.length))
    for i, ids in want.items():
        covered = sorted(x for s, n in starts[i] for x in range(s, s + n))
        assert covered == sorted(list(range(len(ids))) * copies[i])
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return len(sequences)


def test_pieces_and_sequences(spark):
    rng = random.Random(3)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    rows = list(enumerate(made, 100)) + odd_texts()
    got = packing.pack(packing.items(docs_df(spark, rows), PATH)).collect()
    n = check(rows, got)
    total = sum(r.length for r in got)
    assert n <= total / packing.SEQUENCE * 1.05 + 3


def test_a_hot_length(spark):
    rows = [(k, "word " * 300) for k in range(200)] + [(1000 + k, "word " * (k % 290 + 1)) for k in range(400)]
    got = packing.pack(packing.items(docs_df(spark, rows), PATH)).collect()
    n = check(rows, got)
    assert n <= sum(r.length for r in got) / packing.SEQUENCE * 1.05 + 3


def test_ranks_have_no_gaps(spark):
    items = spark.range(500).select("id", (F.col("id") % 3).alias("class"))
    got = packing.ranked(items, [F.col("id")], 5).groupBy("class").agg(F.sort_array(F.collect_list("rank")).alias("r")).collect()
    assert all(r.r == list(range(len(r.r))) for r in got)


def test_empty_table(spark):
    assert packing.pack(packing.items(docs_df(spark, []), PATH)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_solver_covers_the_demand_and_beats_first_fit(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 65), 20, replace=False))
    demand = rng.integers(0, 200, 20)
    found = packing.solve(sizes, demand, 64)
    assert (sum(n * p for n, p in found) == demand).all()
    assert all(p @ sizes <= 64 for _, p in found)
    free: list[int] = []
    for size, n in zip(sizes[::-1].tolist(), demand[::-1].tolist(), strict=True):
        for _ in range(n):
            k = next((k for k, x in enumerate(free) if x >= size), None)
            if k is None:
                free.append(64 - size)
            else:
                free[k] -= size
    assert sum(n for n, _ in found) <= len(free) + len(sizes)


def test_best_pattern_is_optimal():
    rng = np.random.default_rng(9)
    sizes, worth = np.array([3, 5, 7]), rng.random(3)
    value, pattern = packing.best_pattern(sizes, worth, 20)
    best = max(
        a * worth[0] + b * worth[1] + c * worth[2]
        for a in range(7) for b in range(5) for c in range(3) if 3 * a + 5 * b + 7 * c <= 20
    )
    assert value == pytest.approx(best) and pattern @ worth == pytest.approx(best) and pattern @ sizes <= 20
