"""Substring dedup by recompression.

Every text is a sequence of word symbols. A round first names each run of one symbol, then
each neighbouring pair whose left symbol falls on the left half of the alphabet and whose
right one on the right half (a bit of its name decides). A name is a 64-bit hash of what
it stands for, so equal stretches get equal names in every task without any exchange, and
inside a repeated passage all symbols agree but for those at its edges.

For a window of ``width`` words only the symbols that no text around it can change count:
a run or an unpaired half at an edge is dropped. Of the phrases (consecutive symbols of
``PHRASE`` words or more) left on the highest level that has one, the smallest name stands
for the window, and neighbouring windows mostly share theirs. Spark then

1. groups the phrase names and the names of whole texts over all documents,
2. sends names that more than one document has back to the group of documents they came
   from; windows under such a phrase are named by 128 bits each, and these are grouped,
3. sends windows (and whole texts) that also start in a smaller document back, where the
   words they cover are dropped.

A group of documents reports a name once however many of its documents share it, so one
passage in a third of all documents is no more rows than there are groups. Groups have about
``GROUP_BYTES`` of text, so their number grows with the input.

Cases: a null text has no words; a null doc_id counts as larger than all others and stays
null (such rows are spread by their text); rows with the same doc_id never shorten each other
and share a group; texts under ``width`` words stay whole; an empty table gives none. Extra
columns are passed on; one that is called like a result column is replaced by it. Texts of any
length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sheaf.llm.arrays import U64, Block, Rolling, blocks, give_back, mix, signed, windows, words

WIDTH = 13
PHRASE = 5
ROUNDS = 1
GROUPS_PER_PARTITION = 4
# text bytes of a group of documents, which a task holds
GROUP_BYTES = 32 << 20
LAST = 2**62
# rows without an id have numbers from here on, by their text: they are spread over groups, and
# compare as one document behind all others
NO_ID = LAST - 2**20
RESULT = ("n_words", "n_removed", "kept")
# columns of this module's own, beside those of the documents
ID, GROUP = "substring dedup id", "substring dedup group"

_WORD, _PHRASE = Rolling(101), Rolling(102)
_WORD2, _SPAN, _SPAN2 = Rolling(103), Rolling(104), Rolling(105)
_TEXT = U64(0x7E4C0B3F1D5A9286)


class Level:
    """The symbols of a block on one level: names, lengths in words, documents; and for
    every window the range [low, high) of symbols that its surroundings cannot change."""

    def __init__(self, names, sizes, docs, low, high):
        self.names, self.sizes, self.docs, self.low, self.high = names, sizes, docs, low, high

    def runs(self) -> Level:
        """Runs named; the first and last run of a window may reach out of it."""
        names, n = self.names, len(self.names)
        starts = np.ones(n, bool)
        starts[1:] = (names[1:] != names[:-1]) | (self.docs[1:] != self.docs[:-1])
        at = np.flatnonzero(starts)
        count = np.diff(np.append(at, n))
        index = np.cumsum(starts) - 1
        some = self.low < self.high
        low = index[np.where(some, self.low, 0)] + 1
        high = np.where(some, index[np.where(some, self.high, 1) - 1], 0)
        new = names[at]
        many = count > 1
        new[many] = mix(new[many] * U64(0x9E3779B97F4A7C15) + count[many].astype(U64))
        return Level(new, np.add.reduceat(self.sizes, at), self.docs[at], low, high)

    def pairs(self, salt: int) -> Level:
        """Left-right pairs named; half a pair at a window's edge is dropped."""
        names = self.names
        left = (mix(names + U64(salt)) >> U64(63)).astype(bool)
        opens = np.zeros(len(names), bool)
        opens[:-1] = left[:-1] & ~left[1:] & (self.docs[1:] == self.docs[:-1])
        keep = np.ones(len(names), bool)
        keep[1:] = ~opens[:-1]
        at, index = np.flatnonzero(keep), np.cumsum(keep) - 1
        some = self.low < self.high
        low = np.where(some, self.low, 0)
        high = np.where(some, self.high, 1)
        low, high = low + ~left[low], high - left[high - 1]
        some &= low < high
        low = np.where(some, index[np.minimum(low, len(names) - 1)], 1)
        high = np.where(some, index[np.maximum(high - 1, 0)] + 1, 0)
        new, sizes = names[at], self.sizes[at]
        paired = np.flatnonzero(opens[at])
        a = at[paired]
        new[paired] = mix(names[a] * U64(0xD6E8FEB86659FD93) + mix(names[a + 1]))
        sizes[paired] += self.sizes[a + 1]
        return Level(new, sizes, self.docs[at], low, high)

    def choose(self, best: np.ndarray, open_: np.ndarray) -> None:
        """Write the smallest phrase name of every window in ``open_`` that has a phrase
        on this level, and close it."""
        ahead = np.concatenate([[0], np.cumsum(self.sizes)])
        n = len(self.names)
        ends = np.searchsorted(ahead, ahead[:-1] + PHRASE)  # n + 1 where the block ends before
        tables = [_PHRASE.slices(self.names, np.arange(n), np.minimum(ends, n))]
        for step in (1, 2, 4):
            wider = tables[-1].copy()
            wider[:-step] = np.minimum(wider[:-step], tables[-1][step:])
            tables.append(wider)
        some = open_ & (self.low < self.high)
        last = np.searchsorted(ends, np.where(some, self.high, 0), "right") - 1
        i = np.flatnonzero(some & (last >= self.low))
        low, last = self.low[i], last[i]
        power = np.frexp((last - low + 1).astype(np.float64))[1] - 1  # of two: 0 to 3
        flat = np.concatenate(tables)
        best[i] = np.minimum(flat[power * n + low], flat[power * n + last + 1 - (1 << power)])
        open_[i] = False


def phrase_names(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of a block: its start word, document and phrase name."""
    start, doc = windows(first, WIDTH)
    best, open_ = np.zeros(len(start), U64), np.ones(len(start), bool)
    if len(start):
        docs = np.repeat(np.arange(len(first) - 1), np.diff(first))
        levels = [Level(names, np.ones(len(names), np.int64), docs, start, start + WIDTH)]
        for r in range(rounds):
            levels.append(levels[-1].runs().pairs(r * 77 + 13))
        for level in levels[::-1]:
            level.choose(best, open_)
    return start, doc, best


def text_names(names: np.ndarray, names2: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each whole text."""
    a, b = first[:-1], first[1:]
    return mix(_SPAN.slices(names, a, b) + _TEXT), mix(_SPAN2.slices(names2, a, b) + _TEXT)


def window_names(names: np.ndarray, names2: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _SPAN.slices(names, start, start + WIDTH), _SPAN2.slices(names2, start, start + WIDTH)


def _word_names(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = words(block)
    return _WORD.of_bytes(block.data, starts, ends), _WORD2.of_bytes(block.data, starts, ends), first


NAMES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("own", pa.int64())])
NAMES_DDL = "h1 long, h2 long, own long"


def _sorted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The rows in the order of the first two columns. The list is emptied, and a column goes once
    it is copied."""
    by = np.lexsort((columns[1], columns[0]))
    return [columns.pop(0)[by] for _ in range(len(columns))]


def _reported(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """Distinct names with ``own``: twice the smallest document, plus 1 if others share it."""
    if not found:
        return NAMES.empty_table()
    rows = [np.concatenate(x) for x in zip(*found, strict=True)]
    found.clear()
    if not len(rows[0]):
        return NAMES.empty_table()
    h1, h2, ids = _sorted(rows)
    at = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    low, high = np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at)
    return pa.table([signed(h1[at]), signed(h2[at]), 2 * low + (low != high)], schema=NAMES)


class Known:
    """The names sent back to a group of documents, with the smallest document of each."""

    def __init__(self, rows: pa.Table):
        h1, h2 = (np.asarray(rows[c].combine_chunks()).view(U64) for c in ("h1", "h2"))
        by = np.argsort(h1, kind="stable")
        self.h1, self.h2 = h1[by], h2[by]
        self.least = np.asarray(rows["least"].combine_chunks())[by]

    def least_of(self, h1: np.ndarray, h2: np.ndarray | int) -> np.ndarray:
        """The smallest document with each name; LAST where it was not sent back."""
        if not len(self.h1) or not len(h1):
            return np.full(len(h1), LAST)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        same = (self.h1[at] == h1) & (self.h2[at] == h2)
        return np.where(same, self.least[at], LAST)


def _place(ids: np.ndarray) -> np.ndarray:
    """The documents' order: rows without an id are one, the last."""
    return np.minimum(ids, NO_ID)


def _with_phrases(docs: pa.Table) -> pa.Table:
    """Phrase names (second half 0) and names of whole texts."""
    found = []
    for block in blocks(docs.to_batches(), ID, "text"):
        names, names2, first = _word_names(block)
        _, doc, best = phrase_names(names, first)
        new = np.ones(len(best), bool)
        new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
        found.append((best[new], np.zeros(int(new.sum()), U64), block.ids[doc[new]]))
        long_enough = np.diff(first) >= WIDTH
        h1, h2 = text_names(names, names2, first)
        found.append((h1[long_enough], h2[long_enough], block.ids[long_enough]))
    return _reported(found)


def _with_windows(docs: pa.Table, sent: pa.Table) -> pa.Table:
    """Names of the windows under shared phrases, but for texts that are copies of a whole
    smaller document."""
    known, found = Known(sent), []
    for block in blocks(docs.to_batches(), ID, "text"):
        names, names2, first = _word_names(block)
        copied = known.least_of(*text_names(names, names2, first)) < _place(block.ids)
        start, doc, best = phrase_names(names, first)
        shared = (known.least_of(best, 0) < LAST) & ~copied[doc]
        found.append((*window_names(names, names2, start[shared]), block.ids[doc[shared]]))
    return _reported(found)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition of names: a row goes back where its name is a shared phrase, or where
    a document behind it is larger than the smallest that has the name."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = [np.concatenate([np.asarray(b.column(k)) for b in held]) for k in range(3)]
    held.clear()
    h1, h2, own = _sorted(rows)
    at = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h1))))
    least, most = np.minimum.reduceat(own >> 1, at), np.maximum.reduceat(own >> 1, at)
    several = (np.maximum.reduceat(own & 1, at) > 0) | (least != most)
    back = np.where(h2 == 0, several[of], (own & 1 > 0) | (own >> 1 > least[of]))
    for a in range(0, len(h1), 100_000):
        rows = np.flatnonzero(back[a:a + 100_000]) + a
        yield pa.record_batch({"own": own[rows], "h1": h1[rows], "h2": h2[rows], "least": least[of[rows]]})
    del h1, h2, own, at, of, least, most, several, back
    give_back()


def _without(text: bytes, starts: np.ndarray, dropped: np.ndarray) -> bytes:
    """``text`` without its dropped words, each with the white space behind it."""
    ends = np.append(starts[1:], len(text))
    parts, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], dropped.astype(np.int8), [0]])))
    for first, behind in zip(edges[::2], edges[1::2], strict=True):
        parts.append(text[at:starts[first]])
        at = int(ends[behind - 1])
    return b"".join([*parts, text[at:]])


def _shorten(docs: pa.Table, sent: pa.Table, names_out: list[str], layout: bool) -> pa.Table:
    known, made = Known(sent), []
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
    schema = pa.schema([(n, kinds[n] if n in kinds else docs.schema.field(n).type) for n in names_out])
    for block in blocks(docs.to_batches(), ID, "text"):
        names, names2, first = _word_names(block)
        size = np.diff(first)
        drop = np.zeros(len(names) + 1, np.int64)
        start, doc = windows(first, WIDTH)
        gone = known.least_of(*window_names(names, names2, start)) < _place(block.ids)[doc]
        np.add.at(drop, start[gone], 1)
        np.add.at(drop, start[gone] + WIDTH, -1)
        dropped = np.cumsum(drop)[:-1] > 0
        copied = (known.least_of(*text_names(names, names2, first)) < _place(block.ids)) & (size >= WIDTH)
        dropped |= np.repeat(copied, size)
        kept = []
        starts = words(block)[0] if layout else None
        for i in range(len(block)):
            mask = dropped[first[i]:first[i + 1]]
            if layout:
                text = block.text(i)
                kept.append(_without(text, starts[first[i]:first[i + 1]] - block.offsets[i], mask) if mask.any() else text)
                continue
            own = block.text(i).split()  # bytes split at the same six separators
            kept.append(b" ".join(compress(own, ~mask) if mask.any() else own))
        ahead = np.concatenate([[0], np.cumsum(dropped)])
        results = {
            "n_words": pa.array(size.astype(np.int64)),
            "n_removed": pa.array(ahead[first[1:]] - ahead[first[:-1]]),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
        columns = [results.get(n) if n in RESULT else block.rows.column(n) for n in names_out]
        made.append(pa.record_batch(columns, schema=schema))
    return pa.Table.from_batches(made, schema)


def _group(own_id: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(own_id), F.lit(groups))


def dedup(docs: DataFrame, layout: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed and kept: the words left, joined by one space, or with
    ``layout`` the text as it was, but for the words that went and the white space behind them."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    groups = max(GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    passed = [c for c in docs.columns if c not in RESULT]
    unnamed = F.lit(NO_ID) + F.pmod(F.xxhash64("text"), F.lit(LAST - NO_ID))
    held = docs.select(
        *[F.col(c).cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in passed],
        F.coalesce(F.col("doc_id").cast("long"), unnamed).alias(ID),
    )
    # one exchange of the texts serves all three passes
    held = held.withColumn(GROUP, _group(F.col(ID), groups)).repartition(GROUP)

    def sent_back(names: DataFrame) -> DataFrame:
        found = names.repartition("h1").mapInArrow(_resolve, "own long, h1 long, h2 long, least long")
        own = F.shiftright("own", 1)
        return found.select(_group(own, groups).alias(GROUP), "h1", "h2", "least")

    def phrases(rows: pa.Table) -> pa.Table:
        return _with_phrases(rows)

    def under_shared(rows: pa.Table, sent: pa.Table) -> pa.Table:
        return _with_windows(rows, sent)

    shared = sent_back(held.groupBy(GROUP).applyInArrow(phrases, NAMES_DDL))
    by_group = held.groupBy(GROUP)
    found = by_group.cogroup(shared.groupBy(GROUP)).applyInArrow(under_shared, NAMES_DDL)
    repeated = sent_back(found).unionByName(shared.filter(F.col("h2") != 0))

    names_out = [*passed, *RESULT]
    kinds = [held.schema[c] for c in passed]
    result = StructType([
        *kinds, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType()),
    ])

    def shorten(rows: pa.Table, sent: pa.Table) -> pa.Table:
        return _shorten(rows, sent, names_out, layout)

    return by_group.cogroup(repeated.groupBy(GROUP)).applyInArrow(shorten, result)
