from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import langid, quality, sampling
from tests.llm.conftest import docs_df, odd_texts

SF = "/root/testdata/sf0.01"
SYLLABLES = {
    "aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "er", "ein"], "cc": ["ció", "qué", "las", "ndo"],
    "dd": ["ție", "ulu", "esc", "î"], "ee": ["ння", "ого", "ра", "ти"],
}


def corpus(spark, n=200, languages=tuple(SYLLABLES)):
    rng = random.Random(7)
    rows = []
    for k in range(n):
        lang = languages[k % len(languages)]
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        rows.append((k, " ".join(words), lang, "s", 0, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 9])
def test_codewords_are_apart_and_every_bit_splits(n):
    code = langid.codewords(n)
    assert set(np.unique(code)) <= {-1, 1} and len(code) == n
    if n > 1:
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= max(1, code.shape[1] // 4)
        assert (np.abs(code.sum(0)) < n).all()


def test_languages_held_out(spark):
    df = corpus(spark)
    held = sampling.remainder(F.col("doc_id"), 3) == 1
    got = langid.predict(df, langid.fit(df, ~held)).join(df.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got) and len(got) > 40
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_predictions_do_not_depend_on_labels_or_other_columns(spark):
    df = corpus(spark)
    model = langid.fit(df, F.lit(True))
    other = df.withColumns({"lang": F.lit("zz"), "source": F.lit("q")}).withColumn("doc_id", F.col("doc_id") + 1000)
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    two = {r.doc_id - 1000: (r.lang_pred, r.score) for r in langid.predict(other, model).collect()}
    assert one == two


def test_odd_texts_and_no_labels(spark):
    model = langid.fit(corpus(spark), F.lit(True))
    rows = odd_texts()
    got = {r.doc_id: r for r in langid.predict(docs_df(spark, rows), model).collect()}
    assert len(got) == len({i for i, _ in rows})
    for i, t in rows:
        none = t is None or not any(c.isalpha() for c in t)
        assert (got[i].lang_pred == "und") == none and (not none or got[i].score == 0)
    unlabelled = docs_df(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(unlabelled, F.lit(True)) is None
    assert {r.lang_pred for r in langid.predict(unlabelled, None).collect()} == {"und"}
    assert langid.predict(docs_df(spark, []), model).count() == 0
    kept = langid.keep_identified(unlabelled, None)
    assert kept.columns == unlabelled.columns
    assert kept.count() == sum(t is not None and any(c.isalpha() for c in t) for _, t in rows)
    one = langid.fit(corpus(spark, 20, ("aa",)), F.lit(True))
    assert {r.lang_pred for r in langid.predict(corpus(spark, 20, ("aa",)), one).collect()} == {"aa"}


def test_short_noise_goes_and_short_words_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    rng = random.Random(7)
    noise = [(k, "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(20))) for k in range(200)]
    clean = [r for r in docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", F.substring("text", 1, 20).alias("text")).collect()
             if any(c.isalpha() for c in r.text)]
    rows = [(k, t) for k, t in noise] + [(10_000 + k, r.text) for k, r in enumerate(clean)] + [(99_999, "q")]
    kept = {r.doc_id for r in langid.keep_identified(docs_df(spark, rows), model).collect()}
    assert sum(k < 200 for k in kept) <= 10
    assert sum(10_000 <= k < 99_999 for k in kept) >= 0.98 * len(clean)
    assert 99_999 in kept  # too short for any n-gram: nothing tells against it


def test_one_text_scores_alike_in_any_block(spark):
    import pyarrow as pa

    from sheaf.llm.arrays import blocks

    df = corpus(spark, 60)
    model, table = langid.fit(df, F.lit(True)), df.toArrow()
    whole = [s for b in blocks(table.to_batches(), "doc_id", "text") for s in langid._answers(model, b)[1]]
    parts = [s for b in blocks(table.to_batches(), "doc_id", "text", 1) for s in langid._answers(model, b)[1]]
    assert len(parts) == 60 and isinstance(table, pa.Table)
    assert np.allclose(whole, parts, rtol=0, atol=1e-6)


def test_sample_is_bounded_and_smallest_by_hash(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("label"), F.col("id").alias("key"))
    got = sampling.per_label(rows, "label", "key", 7).collect()
    assert len(got) == 21
    all_ = sorted((r.h, r.key) for r in rows.filter("label = '1'").select("key", F.xxhash64("key").alias("h")).collect())
    assert {r.key for r in got if r.label == "1"} == {k for _, k in all_[:7]}


def quality_rows(n=240):
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        words = [rng.choice(["the", "of", "ander", "eating", "thing", "ontion"]) for _ in range(rng.randint(8, 60))]
        if not good:
            words = [w.upper() + "!!" for w in words] if k % 2 else [words[0]] * len(words)
        docs.append((k, " ".join(words)))
        labels.append((k, int(good)))
    return docs, labels


def test_quality_held_out(spark):
    docs, labels = quality_rows()
    df = docs_df(spark, docs)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (7, 9)], "doc_id long, label int")
    held = sampling.remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(df, marks, ~held)
    got = {r.doc_id: r for r in quality.score(df, model).filter(held).collect()}
    truth = dict(labels)
    good = [r.score for i, r in got.items() if truth[i]]
    bad = [r.score for i, r in got.items() if not truth[i]]
    assert len(bad) > 10 and sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())


def test_quality_odd_texts(spark):
    docs, labels = quality_rows(60)
    model = quality.fit(docs_df(spark, docs), spark.createDataFrame(labels, "doc_id long, label int"), F.lit(True))
    rows = odd_texts()
    got = quality.score(docs_df(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = {r.doc_id: r.score for r in got}
    assert empty[1] == empty[2] == pytest.approx(40 / 60, abs=1e-5)
    none = quality.fit(docs_df(spark, docs), spark.createDataFrame([], "doc_id long, label int"), F.lit(True))
    assert none is None and {r.score for r in quality.score(docs_df(spark, rows), none).collect()} == {0.5}
    assert quality.score(docs_df(spark, []), model).count() == 0


def test_scores_and_languages_by_their_definition(spark):
    """Scores of a trained model, recomputed for each text by plain loops over its features;
    languages by the losses of every codeword."""
    import pyarrow as pa

    from sheaf.llm import grams
    from sheaf.llm.arrays import blocks

    docs, labels = quality_rows(90)
    odd = [(900 + k, t) for k, t in enumerate(["", "one", "two words", "é ü", "a  b\nc", None])]
    df = docs_df(spark, docs + odd)
    model = quality.fit(df, spark.createDataFrame(labels, "doc_id long, label int"), F.lit(True))
    languages = langid.fit(corpus(spark, 60), F.lit(True))

    def name(data: bytes) -> int:
        return int(quality._WORDS.of_bytes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])

    def hashed(data: bytes, width: int, bits: int) -> list[int]:
        return [int(grams.ids(np.frombuffer(data[k:k + width], np.uint8), width, bits)[0]) for k in range(len(data) - width + 1)]

    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    quarter = 1 << quality.BITS - 2
    for i, text in docs[::7] + odd:
        data = (text or "").encode()
        own = [name(w) for w in data.split()]
        kinds = [[k * quarter + x for x in hashed(data, width, quality.BITS - 2)] for k, width in enumerate(quality.GRAMS)]
        kinds.append([2 * quarter + (x >> 64 - quality.BITS + 2) for x in own])
        pairs = [(a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(own, own[1:])]
        kinds.append([3 * quarter + (int(quality.mix(np.array([x], np.uint64))[0]) >> 64 - quality.BITS + 2) for x in pairs])
        odds = sum(float(np.mean(model.odds[k])) if k else 0.0 for k in kinds) / 4 + model.prior
        assert got[i] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-5)

    table = pa.table({"doc_id": [1, 2, 3], "text": ["aa bb", "de la casa", "ung ander"]})
    for block in blocks(table.to_batches(), "doc_id", "text"):
        names, score, _ = langid._answers(languages, block)
        for i in range(len(block)):
            data = grams.lower(np.frombuffer(block.text(i), np.uint8)).tobytes()
            margin = sum(
                np.mean([weights[x] for x in hashed(data, width, langid.BITS)], axis=0)
                for width, weights in zip(langid.WIDTHS, languages.weights, strict=True)
            ) * min(len(data), langid.EVIDENCE)
            losses = [float((np.logaddexp(0, -margin * code) * languages.trust).sum()) for code in languages.code]
            assert names[i] == languages.languages[int(np.argmin(losses))]
            assert score[i] == pytest.approx(1 / sum(np.exp(min(losses) - x) for x in losses), abs=1e-6)


def test_conflicting_labels_do_not_count(spark):
    docs, labels = quality_rows(30)
    marks = spark.createDataFrame(labels + [(k, 1 - v) for k, v in labels], "doc_id long, label int")
    assert quality.fit(docs_df(spark, docs), marks, F.lit(True)) is None


def test_registered_classifiers_on_held_out_documents(spark):
    from sheaf.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op4_langid"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op6_quality"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)


def test_neighbours_in_a_block_change_no_result(spark):
    from sheaf.llm.arrays import blocks

    docs, labels = quality_rows(60)
    short = [(1000 + k, t) for k, t in enumerate(["ka", "k", "", "ung", "qué", "lo", "ander of", "of the", "the", "of"])]
    mixed = docs_df(spark, docs + short).coalesce(1).toArrow()
    good = quality.fit(docs_df(spark, docs), spark.createDataFrame(labels, "doc_id long, label int"), F.lit(True))
    model = langid.fit(corpus(spark, 60), F.lit(True))
    turned = mixed.take(list(reversed(range(len(mixed)))))
    found = []
    for table, limit in ((mixed, 1 << 20), (mixed, 1), (turned, 1 << 20)):
        own = {}
        for b in blocks(table.to_batches(), "doc_id", "text", limit):
            names, score, unsure = langid._answers(model, b)
            for row in zip(b.key.to_pylist(), names, score, unsure, quality._scores(good, b), strict=True):
                own[row[0]] = row[1:]
        found.append(own)
    whole = found[0]
    for own in found[1:]:
        assert own.keys() == whole.keys()
        for i, row in own.items():
            assert row[0] == whole[i][0] and row[2] == whole[i][2]
            assert np.allclose([row[1], row[3]], [whole[i][1], whole[i][3]], rtol=0, atol=1e-6)


def test_language_stage_drops_noise_and_keeps_short_clean_texts(spark):
    import base64

    import corpus_pipeline

    df = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL AND lang IS NOT NULL")
    rng = random.Random(4)
    noise = ["".join(rng.choice("asdfghjklqwertyuiopzxcvbnm ") for _ in range(n)) for n in (60, 400, 3000)]
    noise += [base64.b64encode(rng.randbytes(n)).decode() for n in (100, 1000)]
    rows = spark.createDataFrame([(10_000_000 + k, t) for k, t in enumerate(noise)], "doc_id long, text string")
    clean = df.select("doc_id", "text", "lang")
    short = clean.select((F.col("doc_id") + 20_000_000).alias("doc_id"), F.substring("text", 1, 60).alias("text"), F.lit(None).cast("string").alias("lang"))
    docs = clean.unionByName(rows.withColumn("lang", F.lit(None).cast("string"))).unionByName(short)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).select("doc_id").collect()}
    want = {r.doc_id for r in clean.unionByName(short).filter("text RLIKE '[A-Za-z]'").select("doc_id").collect()}
    assert kept == want


def test_the_language_named_goes_on_to_the_packed_pieces(spark):
    import corpus_pipeline

    clean = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) >= 200 AND lang IS NOT NULL").limit(150)
    known = {r.doc_id: r.lang for r in clean.select("doc_id", "lang").collect()}
    own = F.pmod("doc_id", F.lit(3))  # the stage learns from remainders 0 and 2
    wrong = F.when(F.col("lang") == "en", F.lit("de")).otherwise(F.lit("en"))
    docs = clean.withColumn("lang", F.when(own != 1, F.col("lang")).when(F.pmod("doc_id", F.lit(2)) == 0, wrong))
    docs = docs.unionByName(spark.createDataFrame([(10_000_000, "a", "es", "x", 1)], docs.schema))
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.schema == docs.schema
    got = {r.doc_id: r.lang for r in kept.select("doc_id", "lang").collect()}
    assert got.pop(10_000_000) == "es"  # too short to tell: its label stays
    assert sum(got[i] == x for i, x in known.items()) >= 0.98 * len(known)
    pieces = corpus_pipeline.sequences(spark, kept, SF).select("doc_id", "lang").distinct().collect()
    assert {r.doc_id: r.lang for r in pieces} == got | {10_000_000: "es"}
    assert "lang" not in corpus_pipeline.sequences(spark, kept.drop("lang"), SF).columns


def test_a_text_must_fit_the_language_named(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True))
    model.fit[:, 1:] = -9  # of these languages no n-gram is known
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) >= 200")
    first = {r.doc_id for r in langid.predict(docs, model).collect() if r.lang_pred == model.languages[0] or r.ambiguous}
    assert {r.doc_id for r in langid.keep_identified(docs, model).select("doc_id").collect()} == first
