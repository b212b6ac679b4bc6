from __future__ import annotations

import re

import numpy as np
import pytest

from sheaf.llm import substring
from tests.llm.conftest import docs_df, odd_texts, random_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 62


def brute(rows, width=13):
    """(doc_id, words, removed, kept) of each row, straight from the definition."""
    texts = [(LAST if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    least: dict[tuple, int] = {}
    for own, _, words in texts:
        for k in range(len(words) - width + 1):
            key = tuple(words[k:k + width])
            least[key] = min(least.get(key, LAST), own)
    out = []
    for own, i, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if least[tuple(words[k:k + width])] < own:
                gone[k:k + width] = [True] * width
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return sorted(out, key=str)


def run(spark, rows):
    got = substring.dedup(docs_df(spark, rows)).select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("seed,vocabulary", [(1, "ab"), (2, "abcdefgh"), (3, [f"w{k}" for k in range(60)])])
def test_against_brute_force(spark, seed, vocabulary):
    rows = list(enumerate(random_texts(seed, 60, list(vocabulary), 60)))
    rows += [(100 + k, " ".join(["a"] * k)) for k in (5, 13, 14, 40)]
    rows += [(200 + k, " ".join((["a", "b", "c"] * 30)[k:])) for k in range(3)]
    assert run(spark, rows) == brute(rows)


def test_odd_texts(spark):
    rows = odd_texts() + [(20, " ".join(f"w{k % 997}" for k in range(500, 900))), (None, " ".join("abcdefghijklmnopq"))]
    rows += [(21, " ".join("abcdefghijklmnopq")), (21, " ".join("abcdefghijklmnopq"))]
    assert run(spark, rows) == brute(rows)


def test_hot_passage(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(k, f"x{k} y{k} {passage} z{k}") for k in range(300)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    out = substring.dedup(docs_df(spark, []))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "n_removed", "kept"]
    assert out.count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 2, 3])
def test_equal_windows_get_equal_names(rounds):
    """Whatever stands around a window, its phrase name depends on its words alone."""
    import numpy as np

    rng = np.random.default_rng(rounds)
    for letters in (1, 2, 3, 30):
        words = rng.integers(0, letters, 4000).astype(np.uint64)
        first = np.array([0, 700, 700, 705, 2000, 4000])
        names = substring.mix(words)
        start, _, best = substring.phrase_names(names, first, rounds)
        seen: dict[bytes, int] = {}
        for s, b in zip(start, best.tolist(), strict=True):
            assert seen.setdefault(words[s:s + substring.WIDTH].tobytes(), b) == b


def test_a_third_of_the_rows_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(substring, "GROUP_BYTES", 4096)
    texts = random_texts(5, 150, [f"w{k}" for k in range(40)], 60)
    rows = [(None if k % 3 == 0 else k, t) for k, t in enumerate(texts)]
    rows += [(None, texts[1]), (None, texts[1]), (None, texts[0])]
    assert run(spark, rows) == brute(rows)


def test_the_layout_of_what_stays(spark):
    passage = " ".join(f"p{k}" for k in range(13))
    texts = {
        1: f"{passage}\n", 2: f"def f():\n    return 1\n\n{passage}\n\ttail  end\n", 3: f"  {passage}", 4: f"a\n{passage}\nb {passage}",
        5: "left  as\tit\n was", 6: None, 7: f"é\n{passage} ü",
    }
    got = {r.doc_id: r.kept for r in substring.dedup(docs_df(spark, list(texts.items())), layout=True).collect()}
    assert got == {
        1: texts[1], 2: "def f():\n    return 1\n\ntail  end\n", 3: "  ", 4: "a\nb ", 5: texts[5], 6: "", 7: "é\nü",
    }


def test_columns_that_are_called_like_its_own(spark):
    df = spark.createDataFrame([(1, "a b", 5, 6, 7)], f"doc_id long, text string, `{substring.GROUP}x` int, _id int, _group int")
    out = substring.dedup(df)
    assert out.columns == [*df.columns, "n_words", "n_removed", "kept"] and tuple(out.first())[:5] == (1, "a b", 5, 6, 7)


def test_sorted_rows_leave_no_second_copy():
    columns = [np.array([2, 1, 2, 1]), np.array([1, 5, 0, 5]), np.array([10, 20, 30, 40])]
    assert [c.tolist() for c in substring._sorted(columns)] == [[1, 1, 2, 2], [5, 5, 0, 1], [20, 40, 30, 10]]
    assert columns == []
