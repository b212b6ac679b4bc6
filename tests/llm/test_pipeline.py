from __future__ import annotations

import re

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from sheaf.llm.queries import ORACLE_SQL, QUERIES
from sheaf.session import BATCH_BYTES, BATCH_SETTING
from tests.llm import test_jaccard, test_packing, test_substring
from tests.llm.conftest import odd_texts
from tests.llm.test_secrets import brute as brute_secrets

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage had and returned, over the smallest tables and odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    passage = " ".join(f"zq{k}" for k in range(60))
    more = [(10_000 + (i or 0) if i is not None else None, t, "en", "src0", None if t is None else len(t)) for i, t in odd_texts(3000)]
    more += [(20_000 + k, f"alpha beta {k} {passage} gamma {k} " * 1 + f"x{k} " * 100, "en", "src0", 1) for k in range(3)]
    more += [(30_000, "the api_key = abcdefghijklmnop1 is here and there of the", "en", "src0", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, COLUMNS))
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.stored(stage(spark, found[-1], SF)))
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_language_drops_texts_without_letters_and_odd_short_ones(steps):
    want = [(i, t) for i, t in rows(steps[0]) if t is not None and any(c.isalpha() for c in t)]
    kept = rows(steps[1])
    gone = sorted({t for _, t in want} - {t for _, t in kept})
    # single letters, and a mix of scripts
    assert set(gone) <= {"a b c d", "a b c d e f g", dict(odd_texts())[5]}
    assert sorted(kept, key=str) == sorted([(i, t) for i, t in want if t not in gone], key=str)


def test_one_document_of_each_group_stays(steps):
    before = rows(steps[1])
    component = {}
    for i, _, c in test_jaccard.brute(before):
        component[i] = c
    want = [(i, t) for i, t in before if i is None or component[i] == i]
    assert sorted(rows(steps[2]), key=str) == sorted(want, key=str)
    assert len(want) < len(before)


def test_repeated_passages_go(steps):
    before = rows(steps[2])
    want = []
    by_id = dict(before)
    for i, _, removed, kept in test_substring.brute(before):
        want.append((i, kept if removed else by_id[i]))
    words = test_substring.WORD.findall
    after = rows(steps[3])
    changed = {i for i, t in after if i in by_id and t != by_id[i]}
    assert sorted(((i, " ".join(words(t)) if i in changed else t) for i, t in after), key=str) == sorted(want, key=str)
    assert any("\n" in t for i, t in after if i in changed)
    left = dict(want)
    assert "zq30" in left[20_000].split() and "zq30" not in left[20_001].split()


def test_secrets_are_replaced(steps):
    for i, t in rows(steps[4]):
        assert not brute_secrets(t), i
    clean = {i: t for i, t in rows(steps[3]) if not brute_secrets(t)}
    after = dict(rows(steps[4]))
    assert all(after[i] == t or re.search(r"\[(private_key|github)\]", after[i]) for i, t in clean.items())
    assert "[assign]" in after[30_000]
    sizes = {r.doc_id: (r.n_chars, r.text) for r in steps[4].collect()}
    assert sizes[30_000][0] == len(sizes[30_000][1])


def test_packed_pieces_cover_every_text(steps):
    test_packing.check(rows(steps[4]), steps[5].collect())


def test_stages_with_columns_called_like_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    extra = docs.selectExpr("*", "1 AS kept", "2 AS n_removed", "'x' AS component_id", "3 AS id", "4 AS spans", "5 AS _id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, extra = stage(spark, docs, SF), stage(spark, extra, SF)
        assert extra.columns == [*docs.columns, "kept", "n_removed", "component_id", "id", "spans", "_id"]
        assert sorted(map(tuple, extra.select(docs.columns).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
        assert {tuple(r)[5:] for r in extra.collect()} == {(1, 2, "x", 3, 4, 5)}


def test_a_run_leaves_one_checkpoint_and_no_table(spark):
    import glob

    from sheaf.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/table-*"))
    out = corpus_pipeline.run(spark, SF)
    assert set(glob.glob(f"{folder}/table-*")) == before
    assert out.count() > 100


def test_run_and_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 100
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name]).fetchall()
    columns = [c[0] for c in con.sql(ORACLE_SQL[name]).description]
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_op9_and_op2_against_brute_force_on_the_smallest_tables(spark):
    import hashlib

    docs = rows(spark.read.parquet(f"{SF}/documents.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op9_jaccard"](spark, SF).collect()), key=str)
    assert got == test_jaccard.brute(docs)
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in test_substring.brute(docs)]
    assert sorted((tuple(r) for r in QUERIES["op2_substring"](spark, SF).collect()), key=str) == sorted(want, key=str)


def test_every_stage_bounds_its_batches(monkeypatch):
    class Bounded(Exception):
        pass

    def bounded(spark):
        raise Bounded

    monkeypatch.setattr(corpus_pipeline, "bounded_batches", bounded)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Bounded):
            stage(None, None, "")


def test_a_stage_sends_long_texts_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"n": [b.num_rows], "bytes": [b.nbytes]})

    own = spark.newSession()
    rows = [(i, f"{i} " + "word " * 2000, "en", "src0", 0) for i in range(1200)]
    docs = own.createDataFrame(rows, COLUMNS).coalesce(1)
    redacted = corpus_pipeline.secret_spans(own, docs, SF)
    sent = redacted.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in sent) == 1200
    assert max(r.bytes for r in sent) < BATCH_BYTES + 20_000  # a row more at most


def test_a_batch_size_that_is_set_stays(spark):
    own = spark.newSession()
    own.conf.set(BATCH_SETTING, "12345678")
    corpus_pipeline.bounded_batches(own)
    assert int(own.conf.get(BATCH_SETTING).rstrip("b")) == 12345678
