"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier a bit (log-odds of hashed byte 2- and
3-grams) predicts which half of the languages a text belongs to, and the text gets the
language whose codeword loses least. Each bit's loss counts by how well the bit did on the
training sample.

Cases: a null text, or one without a letter, is ``und`` with score 0; null ids stay; every
row gives one row; an empty table or a sample without languages gives ``und`` throughout
(score 0); extra columns are not read. Whole texts are scored, in time linear in their
length. With one language in the sample every text with letters gets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm import grams, sampling
from sheaf.llm.arrays import BLOCK_BYTES, Block, blocks

BITS = 16
WIDTHS = (2, 3)
SAMPLE_PER_LANGUAGE = 400
UNDETERMINED = "und"
# n-grams after which more of them make a decision no surer
EVIDENCE = 16
# texts of at most this many letters' worth of margin between the two best are ambiguous
MARGIN = 0.1
# Texts of at least this many 3-grams are told apart from noise: their mean log-likelihood
# ratio, best language against no language (all hashes alike), must reach LEAST_FIT.
# Measured on sf0.001 and sf0.01: clean texts 2.7 or more from 24 bytes on, random letters
# and base64 -1.6 to 0.3. Losses do not tell: 0.00 on 400 random home-row letters.
# With fewer than NOISE_GRAMS the bound is LOOSER by the growth of the mean's error (one over
# the root of their number): on check_s it drops 1 of 1000 clean texts cut to 6 to 24 bytes.
NOISE_GRAMS = 32
LEAST_FIT = 0.0
LOOSER = 8.0
# The pipeline's stage reads the bits' and the fit's tables for each block: half a block at once.
STAGE_BLOCK = BLOCK_BYTES // 2


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of +1/-1. Up to 6 languages all splits in two (2**(n-1) - 1 bits), so any two
    differ in 2**(n-2) bits; beyond, of 200 random codes that with the largest distance."""
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1)) if n > 1 else np.array([0])
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(n)])
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits))
        apart = (bits - code @ code.T) // 2
        least = int(apart[~np.eye(n, dtype=bool)].min())
        varied = bool((np.abs(code.sum(0)) < n).all())
        if varied and least > most:
            best, most = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: list[np.ndarray]  # of each n-gram width: [hash, bit]
    trust: np.ndarray
    fit: np.ndarray  # log-likelihood ratios of the widest n-grams: [hash, language]


def _bit_margins(model: Model, block: Block) -> np.ndarray:
    """Mean log-odds of every bit over the n-grams inside each document, times the evidence."""
    data = grams.lower(block.data)
    total = np.zeros((len(block), model.code.shape[1]))
    for width, weights in zip(WIDTHS, model.weights, strict=True):
        own, first = grams.within(data, block.offsets, width, BITS)
        total += grams.per_document(weights[own], first) / np.maximum(np.diff(first), 1)[:, None]
    return total * np.minimum(np.diff(block.offsets), EVIDENCE)[:, None]


def _losses(model: Model, margins: np.ndarray) -> np.ndarray:
    """Each language's loss: the log losses of its codeword's bits, weighted by trust."""
    z = -margins[:, None, :] * model.code[None]
    return (np.logaddexp(0, z) * model.trust).sum(-1)


def _ambiguous(losses: np.ndarray) -> np.ndarray:
    ordered = np.sort(losses, 1)
    return ordered[:, 1] - ordered[:, 0] < MARGIN if losses.shape[1] > 1 else np.zeros(len(losses), bool)


def train(sample: pa.Table) -> Model:
    langs = sample["lang"].to_pylist()
    languages = sorted(set(langs))
    code = codewords(len(languages))
    label = np.array([languages.index(x) for x in langs])
    counts = [np.zeros((len(languages), 1 << BITS)) for _ in WIDTHS]
    held: list[tuple[Block, np.ndarray]] = []
    at = 0
    for block in blocks(sample.to_batches(), "doc_id", "text"):
        data, own = grams.lower(block.data), label[at:at + len(block)]
        at += len(block)
        held.append((block, own))
        for width, count in zip(WIDTHS, counts, strict=True):
            found, first = grams.within(data, block.offsets, width, BITS)
            flat = np.repeat(own, np.diff(first)) * (1 << BITS) + found
            count += np.bincount(flat, minlength=count.size).reshape(count.shape)
    weights = []
    for count in counts:
        share = (count + 0.5) / (count.sum(1, keepdims=True) + 0.5 * (1 << BITS))
        odds = [
            np.log(share[code[:, b] > 0].mean(0) / share[code[:, b] < 0].mean(0)) if len(languages) > 1
            else np.zeros(1 << BITS)
            for b in range(code.shape[1])
        ]
        weights.append(np.stack(odds, 1).astype(np.float32))
    # of the last count, so of the widest n-grams
    model = Model(languages, code, weights, np.ones(code.shape[1]), np.log(share * (1 << BITS)).T.astype(np.float32))
    right = np.zeros(code.shape[1])
    for block, own in held:
        right += ((_bit_margins(model, block) > 0) == (code[own] > 0)).sum(0)
    share = np.clip(right / max(len(label), 1), 0.5, 1)
    trust = np.maximum(2 * share - 1, 1e-3)
    model.trust = trust / trust.sum()
    return model


def fit(docs: DataFrame, usable: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model of the ``usable`` rows with a language and a text: a sample of at most
    ``per_language`` documents of each language, whole texts."""
    rows = docs.select("doc_id", "text", "lang").filter(
        usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    )
    chosen = sampling.per_label(rows, "lang", "doc_id", per_language).select("doc_id")
    # the chosen ids are per_language a language at most
    return sampling.fit(rows.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text", "lang"), train)


def _without_letter(block: Block) -> np.ndarray:
    """Documents without any Unicode letter; only those without an ASCII one are decoded."""
    letter = (grams.FOLD[block.data] != 0x20) & (block.data < 0x80)
    seen = grams.per_document(letter, block.offsets) > 0
    for i in np.flatnonzero(~seen):
        seen[i] = any(c.isalpha() for c in block.text(int(i)).decode())
    return ~seen


def _answers(model: Model | None, block: Block) -> tuple[list[str], np.ndarray, np.ndarray]:
    if model is None:
        return [UNDETERMINED] * len(block), np.zeros(len(block)), np.ones(len(block), bool)
    losses = _losses(model, _bit_margins(model, block))
    best = losses.argmin(1)
    likely = np.exp(-(losses - losses.min(1, keepdims=True)))
    score = 1 / likely.sum(1)
    unsure = _ambiguous(losses)
    none = _without_letter(block)
    names = np.array(model.languages, object)[best]
    names[none] = UNDETERMINED
    score[none] = 0
    return names.tolist(), score, unsure | none


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, lang_pred, score and whether it is ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "doc_id", "text"):
            names, score, unsure = _answers(shared.value, block)
            yield pa.record_batch({
                "doc_id": block.key, "lang_pred": pa.array(names, pa.string()), "score": score, "ambiguous": unsure,
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, lang_pred string, score double, ambiguous boolean")


def _identified(model: Model | None, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Which documents have a letter and fit the language that the output codes name, and that
    language. Ambiguous documents, and those shorter than EVIDENCE, get None and may fit any
    learned language; fitting two alike is no noise. The fewer n-grams tell it, the worse the
    fit may be. Without a model every document with a letter, and no language."""
    lettered = ~_without_letter(block)
    if model is None:
        return lettered, np.full(len(block), None, object)
    losses = _losses(model, _bit_margins(model, block))
    best = losses.argmin(1)
    told = ~_ambiguous(losses) & (np.diff(block.offsets) >= EVIDENCE)
    own, first = grams.within(grams.lower(block.data), block.offsets, WIDTHS[-1], BITS)
    count = np.diff(first)
    fits = grams.per_document(model.fit[own], first) / np.maximum(count, 1)[:, None]
    fit = np.where(told, fits[np.arange(len(block)), best], fits.max(1))
    few = np.maximum(1 / np.sqrt(np.maximum(count, 1)) - 1 / np.sqrt(NOISE_GRAMS), 0)
    keep = lettered & ((count == 0) | (fit >= LEAST_FIT - LOOSER * few))
    return keep, np.where(told, np.array(model.languages, object)[best], None)


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language can be told (not ``und``, nor noise that does not fit the
    language named), with that language as their ``lang``, where there is such a column; ambiguous
    and very short ones keep the label they have. All else is unchanged. Without a model nothing
    can be told apart, and every document with a letter stays as it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "doc_id", "text", STAGE_BLOCK):
            keep, names = _identified(shared.value, block)
            rows = block.rows
            at = rows.schema.get_field_index("lang")
            if at >= 0:
                field = rows.schema.field(at)
                named = pa.array(names.tolist(), pa.string()).cast(field.type)
                rows = rows.set_column(at, field, pc.coalesce(named, rows.column(at)))
            yield rows.filter(pa.array(keep))

    return docs.mapInArrow(task, docs.schema)
