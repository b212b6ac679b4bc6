from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sheaf.llm import lines
from tests.llm.conftest import docs_df, odd_texts

UPPER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(UPPER)


def brute(rows, least=40, documents=5):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if i is None else i)
    keeper = {k: max(h) for k, h in holders.items() if len(h) >= documents}
    out = []
    for i, text in rows:
        of = (text or "").split("\n")
        kept = [x for x in of if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(of), len(of) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(df, **options):
    got = lines.dedup(df, **options)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def made_lines(seed, docs, most):
    rng = random.Random(seed)
    pool = [f"Line {k} of a text that is wide enough to count {k * 7}" for k in range(60)] + ["short", "", "Ünïcode " * 6]
    dress = [str, str.upper, lambda x: f" \t{x}\x0b", lambda x: x + "\r", lambda x: x.replace("Ü", "ü")]
    out = []
    for i in range(docs):
        picked = [rng.choice(dress)(rng.choice(pool[:rng.choice([5, 63])])) for _ in range(rng.randint(0, most))]
        out.append((rng.randint(1, docs), "\n".join([*picked, f"the only line of this kind, number {i} of them all"][rng.randint(0, 1):])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made_lines(seed, 120, 12) + odd_texts(2000)
    assert run(docs_df(spark, rows).repartition(5)) == brute(rows)


def test_rows_without_an_id_are_one_document(spark):
    line = "a line of forty characters or more, in any document at all"
    rows = [(None, line)] * 9 + [(k, line) for k in range(1, 5)]
    assert run(docs_df(spark, rows)) == brute(rows)
    assert all(r[2] == 0 for r in run(docs_df(spark, rows[:12])))


def test_hot_line_in_a_third_of_all_rows_and_in_one_document_often(spark):
    line = "boilerplate that stands in every third document of this table"
    rows = [(k, f"own {k}\n{line}" if k % 3 == 0 else f"own text number {k}, long enough for a key of its own") for k in range(300)]
    rows.append((1000, "\n".join([line] * 50)))
    assert run(docs_df(spark, rows).repartition(7)) == brute(rows)


def test_empty_table_and_limits(spark):
    assert run(docs_df(spark, [])) == []
    rows = [(k, "x" * 39 + "\n" + "y" * 40) for k in range(5)]
    assert [r[2] for r in run(docs_df(spark, rows, extra=False))] == [1, 1, 1, 1, 0]
    assert run(docs_df(spark, rows), least=3, documents=2) == brute(rows, 3, 2)


def test_the_twice_seen_filters_miss_no_repeat_and_suspect_few_others(spark, monkeypatch):
    monkeypatch.setattr(lines, "PAGE_KEYS", 512)
    texts = [(k, f"a line that stands in one document only, number {k}\na line that two documents share, number {k // 2}")
             for k in range(4000)]
    df = lines._texts(docs_df(spark, texts).repartition(9))
    filters = lines.twice_seen(df)
    assert len(filters) > 10
    found = {(r.doc_id, r.h1) for r in lines._suspects(df, filters, 40).collect()}
    assert 4000 <= len(found) < 4400
    monkeypatch.setattr(lines, "MOST_BITS", 8)  # the filters hold nothing any more
    assert run(docs_df(spark, texts[:40])) == brute(texts[:40])


def test_lines_of_a_block():
    block = next(lines.blocks(iter([__import__("pyarrow").record_batch({
        "doc_id": [1, 2, 3, 4], "text": ["a\n\nb\n", "", "\n", "c"]})]), "doc_id", "text"))
    starts, ends, first = lines.split_lines(block)
    assert np.diff(first).tolist() == [4, 1, 2, 1]
    got = [block.data[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
    assert got == ["a", "", "b", "", "", "", "", "c"]
