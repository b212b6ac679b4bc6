from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sheaf.llm import graph, jaccard
from tests.llm.conftest import docs_df, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and rows[x][0] is not None and rows[y][0] is not None and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((root(rows[x][0]), root(rows[y][0])))
                parent[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in jaccard.join(docs_df(spark, rows)).collect()), key=str)


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = f"e{rng.random()}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = []
    for g in range(8):
        words = [f"g{g}w{rng.randint(0, 500)}" for _ in range(rng.randint(5, 120))]
        texts += variants(rng, words, rng.choice([1, 3, 40]), 6)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} " + " ".join(f"q{rng.random()}" for _ in range(rng.randint(3, 40))) for _ in range(50)]
    rng.shuffle(texts)
    rows = [(3 * k + 1, t) for k, t in enumerate(texts)]
    assert run(spark, rows) == brute(rows)


def test_links_at_the_threshold(spark):
    # sets of 9 shingles with 8 shared are 8 of 10; 17 words make 13, 12 shared are 12 of 14
    base = [f"w{k}" for k in range(13)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "X"])), (3, " ".join(["Y", *base[1:-1], "X"]))]
    assert run(spark, rows) == brute(rows)
    assert {r[2] for r in run(spark, rows)[:2]} == {1}


def test_odd_texts(spark):
    rows = odd_texts() + [(30, "A B c D"), (31, "one"), (None, "one")]
    assert run(spark, rows) == brute(rows)


def test_large_group_of_near_copies_and_a_hot_class(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(150)]
    texts = variants(rng, words, 150, 5) + [" ".join(words)] * 100
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 200)] + [(500, 600)], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 201), 1), 500: 500, 600: 500}


def shingle_sets(rows):
    """The smallest document of each different set."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        own = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        if i is not None and own:
            sets[own] = min(i, sets.get(own, i))
    return sets


def brute_links(rows):
    sets = list(shingle_sets(rows).items())
    return sorted({
        (min(i, j), max(i, j)) for x, (s, i) in enumerate(sets) for t, j in sets[:x]
        if i != j and 100 * len(s & t) >= 80 * len(s | t)
    })


def test_every_link_inside_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT_ROWS", 20)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(150)]
    texts = variants(rng, words, 150, 2) + [" ".join(words)] * 20
    texts += variants(rng, [f"v{k}" for k in range(90)], 20, 4)
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(1000 + (i or 0) if i else i, t) for i, t in odd_texts(300)]
    want = brute_links(rows)
    assert len(want) > 10 * len(texts)
    got = sorted(tuple(r) for r in jaccard.links(docs_df(spark, rows)).collect())
    assert got == want
    assert jaccard.links(docs_df(spark, [])).count() == 0


def test_link_counts_of_every_document(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT_ROWS", 20)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(120)]
    texts = variants(rng, words, 60, 2) + [" ".join(words)] * 30 + variants(rng, [f"v{k}" for k in range(40)], 9, 3)
    rng.shuffle(texts)
    rows = [(5 * k + 100, t) for k, t in enumerate(texts)] + [(i, t) for i, t in odd_texts(300) if i != 7] + [(None, texts[0])]
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        if i is not None:
            sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    named = shingle_sets(rows)
    want = sorted(
        (i, named.get(s, i), sum(j != i and bool(s) and 100 * len(s & t) >= 80 * len(s | t) for j, t in sets.items()))
        for i, s in sets.items()
    )
    got = jaccard.link_counts(docs_df(spark, rows))
    assert got.columns == ["doc_id", "class_id", "n_links"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert jaccard.link_counts(docs_df(spark, [])).count() == 0


def test_grouping_holds_one_small_group_and_deals_hot_shingles(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute

    # one token met 500 times, one met thrice, others once
    token = np.sort(np.concatenate([np.full(500, 8), np.full(3, 16), np.arange(100, 500) * 4]))
    rows = pa.table({"token": token, "id": np.arange(len(token)), "place": np.full(len(token), 100 << 32), "salt": np.zeros(len(token), np.int64)})
    read = []

    def batches():
        for k, b in enumerate(rows.to_batches(max_chunksize=50)):
            read.append(k)
            yield b

    out = jaccard._grouped(batches())
    first = next(out)
    assert len(read) == 1 and first.num_rows == 50  # nothing waits for the rest of the token
    rest = pa.Table.from_batches([first, *out])
    assert rest.filter(pa.compute.is_null(rest["b"])).num_rows == 500 and rest.num_rows == 503

    monkeypatch.setattr(jaccard, "HOT_LEVEL", 4)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(120)]
    family = list(enumerate(variants(rng, words, 100, 3) + variants(rng, words[:70], 60, 3) + variants(rng, [f"v{k}" for k in range(60)], 5, 2)))
    df = docs_df(spark, family)
    tokens = jaccard.prefixes(df, jaccard.frequent_shingles(jaccard.profiles(df)))
    assert tokens.groupBy("token").agg({"salt": "max", "id": "count"}).filter("`count(id)` > 40 and `max(salt)` = 0").count() == 0
    assert tokens.filter("salt > 0").select("salt").distinct().count() > 20
    assert run(spark, family) == brute(family)
    assert sorted(tuple(r) for r in jaccard.links(df).collect()) == brute_links(family)


class TaskOnly:
    """Takes a frame's place: what is mapped over it comes back as it is."""

    def mapInArrow(self, task, schema):
        return task


def profiled(texts):
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    return pa.Table.from_batches(jaccard.profiles(TaskOnly())(iter([batch])))


def test_a_task_works_in_little_memory(monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 1 << 20)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(1000)]
    tracemalloc.start()
    try:
        found = profiled(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.num_rows == 1000
    assert peak < 50e6


def test_recurring_shingles_are_counted():
    texts = ["a b c d e f", "b c d e f g", None, "", "a b c d e f g h", "b c d e f"] + ["x y"] * 3
    # a-e twice, b-f four times, c-g twice, x y three times
    assert sorted(r["n"] for r in profiled(texts).to_pylist() if r["kind"] == 1) == [2, 2, 3, 4]


@pytest.mark.parametrize("counted", [1, 5])
def test_a_text_longer_than_the_count(monkeypatch, counted):
    monkeypatch.setattr(jaccard, "COUNTED", counted)
    monkeypatch.setattr(jaccard, "WORDS", 1)
    rows = profiled(["a b a b c d e f g", "x x y"]).to_pylist()
    assert [r["n"] for r in rows if r["kind"] == 0] == [7, 2] and not [r for r in rows if r["kind"] == 1]


@pytest.mark.parametrize("least", [1, 2, 3, 50])
def test_recurring_names(least):
    rng = np.random.default_rng(least)
    for n in (0, 1, 2, 3, 400):
        names = rng.integers(0, 90, n).astype(np.uint64)
        expected = sorted((k, c) for k, c in Counter(names.tolist()).items() if c >= least)
        often, count = jaccard._recurring(names, least)
        assert list(zip(often.tolist(), count.tolist(), strict=True)) == expected
