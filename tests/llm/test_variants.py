from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sheaf.llm import variants
from tests.llm.conftest import docs_df, odd_texts

UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(rows, least=3, shortest=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if c >= least and len(w) >= shortest}


def distance_is_one(v, w):
    row = list(range(len(w) + 1))
    for i, a in enumerate(v, 1):
        row, before = [i], row
        for j, b in enumerate(w, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return row[-1] == 1


def brute(n, times=2):
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and distance_is_one(v, w)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= times * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def made_words(seed, k, letters="abcdeé", shortest=5, longest=8):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest))): int(2 ** rng.uniform(0, 9)) for _ in range(k)}


def words_df(spark, n):
    return spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, form string")


def run(df, **options):
    got = variants.variants(df, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("most", [1 << 15, 60, 1])
def test_equals_brute_force_however_the_trie_is_cut(spark, most):
    n = made_words(most, 250 if most > 1 else 40)
    n |= {"abcde": 900, "abcdef": 400, "abcdefg": 100, "abcdefgh": 40, "z" * 250: 8, "z" * 249: 3, "y" * 40 + "x" * 40: 5, "y" * 40 + "x" * 39: 1}
    assert run(words_df(spark, n), most=most) == brute(n)


def test_words_of_equal_letters_are_dealt_over_salts(spark):
    rng = random.Random(4)
    n = {}
    while len(n) < 120:
        w = list("aabbccdd")
        rng.shuffle(w)
        n["".join(w)] = rng.randint(1, 99)
    # á and é are in the groups of other letters: the same group with a letter replaced
    n |= {w.replace("a", chr(ord("a") + 26 * 5), 1): 7 for w in list(n)[:40]}
    assert run(words_df(spark, n), most=10) == brute(n)


def test_counted_words_of_whole_texts(spark):
    rng = random.Random(7)
    pool = [*made_words(7, 60), "Straße", "ÉCOLE", "École", "naïveté", "tiny"]
    rows = [(rng.randint(0, 900), " ".join(rng.choice(pool) for _ in range(rng.randint(0, 90)))) for _ in range(200)]
    rows += odd_texts(500) + [(None, "alpha beta gamma alpha"), (5, "x" * 300_000 + " alpha")]
    got = variants.counted_words(docs_df(spark, rows).repartition(4))
    assert {r.word: r.n for r in got.collect()} == words_of(rows)


def test_forms_from_documents(spark):
    rows = [(k, "colour colour colours color-coded colour " + ("kolour " * (k % 2)) + "étoile etoile étoiles") for k in range(30)]
    assert run(variants.counted_words(docs_df(spark, rows))) == brute(words_of(rows))


def test_empty_tables_and_words_without_near_ones(spark):
    assert run(words_df(spark, {})) == []
    assert run(variants.counted_words(docs_df(spark, []))) == []
    assert run(words_df(spark, {"alone": 4})) == [("alone", None, "alone", 4, 0, None)]


def test_chains_of_forms_end_at_their_last(spark):
    n = {"a" * (5 + k): 3 ** (12 - k) for k in range(12)}
    got = run(words_df(spark, n))
    assert got == brute(n)
    assert {r[2] for r in got} == {"aaaaa"}


@pytest.mark.parametrize("seed", range(20))
def test_letters_are_compared_exactly(seed):
    words = [*made_words(seed, 60, "ab"), "a" * 31, "a" * 32, "a" * 33, "a" * 32 + "b", "ba" * 40, "ba" * 39 + "b"]
    every = variants.Letters(words, *variants.letters(words))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    got = variants.near(every, i, every, j)
    assert got.tolist() == [distance_is_one(words[a], words[b]) for a, b in zip(i, j, strict=True)]
