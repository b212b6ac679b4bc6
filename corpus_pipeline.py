"""Documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame: all but the last the columns of ``documents``, the last the packed pieces. Each
stage works on everything its predecessor kept, whether that is read back from Parquet
(as ``run`` does) or not.

1. language: documents whose language cannot be told go: null texts, those without a letter,
   and those that do not fit the language that the classifier names. That language is the
   document's ``lang`` from here on; ambiguous ones and those of a few letters keep the label
   they came with (``langid.keep_identified``).
2. near_duplicates: of each group of linked documents the one with the smallest doc_id
   stays; documents without words link with nothing and stay, and so do rows without an id.
3. substrings: words in windows of 13 that also start in a smaller document go, with the
   white space behind them; all else of a text stays as it is, line breaks too. A document
   may end up empty; it stays.
4. secrets: every span found is replaced by its kind in brackets, a private key whole.
5. packing: pieces of at most 4096 ids with their place in a sequence, and their ``lang``.

n_chars follows the text where a stage changes it. Empty tables pass through all stages. Null
texts go in stage 1 and rows with a null doc_id count as documents of their own, but are never
dropped as near duplicates; repeated rows of one doc_id stay or go together; of equal texts the
one with the smallest doc_id stays. Texts of any length are worked on whole. Further columns pass
through all stages but the last, whatever they are called. ``run`` keeps the table of one
stage while the next one reads it, and drops it then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import jaccard, langid, packing, sampling, secrets, substring
from sheaf.llm.graph import few
from sheaf.llm.queries import tokenizer_path
from sheaf.session import Scope, bounded_batches, storage_scope, stored
from sheaf.sources.tables import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = langid.fit(docs, sampling.remainder(F.col("doc_id"), 3) != 1)
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    linked = jaccard.join(docs.select("doc_id", "text"))
    gone = stored(linked.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct())
    return docs.join(few(gone), "doc_id", "left_anti").select(docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    own = {c: f"own {k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}  # clashes with no result
    shortened = substring.dedup(docs.withColumnsRenamed(own), layout=True)
    changed = F.col("n_removed") > 0
    out = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in own:
        out["n_chars"] = F.when(changed, F.length("kept").cast("long")).otherwise(F.col(own["n_chars"]))
    return shortened.select(*[out.get(c, F.col(own.get(c, c))).alias(c) for c in docs.columns])


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return secrets.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    label = "lang" if "lang" in docs.columns else None
    return packing.pack(packing.items(docs, tokenizer_path("word_bpe_49k.json"), label))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("secrets", secret_spans),
    ("packing", sequences),
]

# No stage but the third could be said in SQL: the models, the automaton and the packing
# cannot. tests/llm/test_pipeline.py holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with storage_scope(spark) as before:
        for _, stage in STAGES[:-1]:
            kept = Scope(spark)
            with storage_scope(spark):  # what the stage itself has stored
                docs = stored(stage(spark, docs, sf_dir), kept)
            before.drop()
            before.paths.extend(kept.paths)
        # packing reads its documents once, into a checkpoint
        return STAGES[-1][1](spark, docs, sf_dir)
