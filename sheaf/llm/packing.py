"""Packing by cutting-stock column generation.

Documents become ids, then pieces of at most one sequence; only the pieces' numbers move
on. Pieces of up to ``SHORT`` ids are first put end to end in bundles, as rounding would cost
them most. The lengths of these items are counted in classes of ``CLASS`` tokens (rounded
up), a table of fixed size. The driver solves the cutting-stock linear program over it: a knapsack dynamic
program prices new patterns (multisets of classes that fit a sequence) until none is worth
adding. Patterns are used a whole number of times; what rounding down leaves is packed
first fit decreasing. Every pattern then owns a range of ranks in each of its classes, so
an item finds its sequence from its class and its rank there alone.

Cases: a null or empty text has the end id only; null doc_ids and repeated rows are
packed like any other; an empty table gives none; extra columns are not read. A class with
a third of all items is ranked in as many parts as there are shuffle partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.arrays import Block, blocks, give_back
from sheaf.llm.bpe import byte_letters
from sheaf.session import cut_lineage

SEQUENCE = 4096
CLASS = 16
# Fixed values of the format: the id behind each document, the tokenizer's separator.
END_ID = 2
SEPARATOR = "<|startoftext|>"
# Latin-1 letters; ASCII punctuation but for quotes, < > | and backslash.
LETTERS = "[A-Za-zªµºÀ-ÖØ-öø-ÿ]+"
MARKS = r"""[!"#$%&()*+,./:;=?@^`{}~\[\]-]{0,3}"""
BLOCK = 2 << 20
REMEMBERED_BYTES = 64 << 20
ENTRY_BYTES = 240  # of a piece in a dict, besides its text and its ids

# pieces of up to SHORT ids share an item until it has BUNDLE ids
SHORT = 256
BUNDLE = 512

PIECE = [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ahead")]
ITEMS = (
    "length long, parts array<struct<doc_id:long,start:long,length:long,ids_crc32:long,doc_tokens:long,ahead:long>>"
)


class Remembered:
    """Ids (as bytes) by text, ``limit`` bytes of them at most (about): the newest, and from
    the ones before them those that were asked for again."""

    def __init__(self, limit: int = REMEMBERED_BYTES):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def all(self, texts: list[str], learn: Callable[[list[str]], None]) -> list[bytes]:
        """The ids of every text; ``learn`` puts those that are not held into ``new``."""
        if self.size > self.limit // 2:
            self.old, self.new, self.size = self.new, {}, 0
        missing = set(texts).difference(self.new)
        # three bytes a letter: the text and its ids
        self.size += ENTRY_BYTES * len(missing) + 3 * sum(map(len, missing))
        again = missing.intersection(self.old)
        self.new.update(zip(again, map(self.old.__getitem__, again), strict=True))
        learn(list(missing - again))
        return list(map(self.new.__getitem__, texts))


@dataclass
class Ids:
    """Rows of ids: one after another, and where each row starts (one more at the end)."""

    flat: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, rows: list[bytes]) -> Ids:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        return cls(np.frombuffer(b"".join(rows), "<u4"), np.concatenate([[0], np.cumsum(sizes)]))

    def take(self, rows: np.ndarray) -> Ids:
        sizes = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(sizes)])
        kind = np.int32 if max(len(self.flat), first[-1]) < 1 << 31 else np.int64
        at = np.repeat((self.first[rows] - first[:-1]).astype(kind), sizes)
        at += np.arange(len(at), dtype=kind)
        return Ids(self.flat[at], first)

    def joined(self, first: np.ndarray) -> Ids:
        """Rows first[i] to first[i + 1] as row i."""
        return Ids(self.flat, self.first[first])


class WordIds:
    """Ids of texts under a tokenizer that drops white space and never joins over it.

    Arrow splits a block's texts at spaces and line ends and numbers the different pieces.
    Pieces of Latin-1 letters, perhaps with punctuation behind them, are words in lower case and
    marks, which never merge with each other; a word folds letter by letter and is not cut before its
    merges, so the model alone encodes it. Other pieces go through the whole tokenizer, all new
    ones in one call with a special token between them. Both are remembered up to a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.merge = self.tokenizer.model.tokenize
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(True) + 1)]
        # bytes that a byte-level vocabulary does not write as the Latin-1 letter of their value
        self.letters = {b: c for b, c in enumerate(byte_letters()) if ord(c) != b}
        self.words, self.others = Remembered(), Remembered(REMEMBERED_BYTES // 4)

    def forget(self) -> None:
        self.words.forget()
        self.others.forget()

    def _learn_words(self, words: list[str]) -> None:
        new, raw, merge, letters = self.words.new, self.raw, self.merge, self.letters
        for word in words:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
            new[word] = b"".join([raw[t.id] for t in merge(shown)])

    def _learn_others(self, pieces: list[str]) -> None:
        new = self.others.new
        for a in range(0, len(pieces), 20_000):
            part = pieces[a:a + 20_000]
            for p in part:
                if "<|" in p or not p:  # may hold the separator
                    new[p] = self._encoded(p).tobytes()
            plain = [p for p in part if "<|" not in p and p]
            ids = self._encoded(SEPARATOR.join(plain))
            cut = (4 * np.flatnonzero(ids == self.separator)).tolist()
            raw = ids.tobytes()
            for p, x, y in zip(plain, [0, *[x + 4 for x in cut]], [*cut, len(raw)], strict=bool(plain)):
                new[p] = raw[x:y]

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _of_pieces(self, pieces: pa.Array) -> Ids:
        """The ids of different pieces: of each a word (or another piece) and its marks."""
        is_word = pc.match_substring_regex(pieces, f"^{LETTERS}{MARKS}$")
        found = pieces.filter(is_word)
        marks = pc.replace_substring_regex(found, f"^{LETTERS}", "").dictionary_encode()
        words = pc.utf8_lower(pc.replace_substring_regex(found, f"{MARKS}$", "", max_replacements=1)).dictionary_encode()
        others = pieces.filter(pc.invert(is_word)).to_pylist() + marks.dictionary.to_pylist()
        ids = Ids.of(self.words.all(words.dictionary.to_pylist(), self._learn_words) + self.others.all(others, self._learn_others))
        n_words, n_marks = len(words.dictionary), len(marks.dictionary)
        rows = np.full((len(pieces), 2), len(ids.first) - 1)  # a row behind the last, which is empty
        at = np.asarray(is_word)
        rows[at, 0], rows[at, 1] = np.asarray(words.indices), np.asarray(marks.indices) + len(ids.first) - 1 - n_marks
        rows[~at, 0] = n_words + np.arange(len(others) - n_marks)
        both = Ids(ids.flat, np.append(ids.first, ids.first[-1])).take(rows.ravel())
        return both.joined(np.arange(0, len(both.first), 2))

    def encode(self, block: Block) -> Ids:
        """The ids of every document of the block."""
        data = block.data.copy()
        data[data == 0x0A] = 0x20
        texts = pa.LargeStringArray.from_buffers(len(block), pa.py_buffer(block.offsets.astype(np.int64)), pa.py_buffer(data))
        split = pc.split_pattern(texts, " ")
        pieces = split.values.dictionary_encode()
        of_pieces = self._of_pieces(pieces.dictionary)
        return of_pieces.take(np.asarray(pieces.indices)).joined(np.asarray(split.offsets))


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def items(docs: DataFrame, path: str, label: str | None = None) -> DataFrame:
    """Each document's ids and end id, cut every ``SEQUENCE`` ids: ITEMS of one piece or of
    some short ones, each with the length ``ahead`` of it in the item. Pieces carry their
    document's ``label``, a column of texts, if one is named."""
    piece_type = pa.struct([*PIECE, *([(label, pa.string())] if label else [])])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = word_ids(path), END_ID.to_bytes(4, "little")
        short: list[dict] = []
        for block in blocks(batches, "doc_id", "text", BLOCK):
            made: list[list[dict]] = []
            ids = tok.encode(block)
            labels = block.rows.column(label).to_pylist() if label else [None] * len(block)
            ends = ids.first[1:].tolist()
            for key, own, a, b in zip(block.key.to_pylist(), labels, ids.first[:-1].tolist(), ends, strict=True):
                raw = ids.flat[a:b].tobytes() + end
                n = len(raw) // 4
                for a in range(0, n, SEQUENCE):
                    b = min(a + SEQUENCE, n)
                    piece = {
                        "doc_id": key, "start": a, "length": b - a, "ids_crc32": zlib.crc32(raw[4 * a:4 * b]),
                        "doc_tokens": n, "ahead": 0,
                    }
                    if label:
                        piece[label] = own
                    if b - a > SHORT:
                        made.append([piece])
                        continue
                    piece["ahead"] = short[-1]["ahead"] + short[-1]["length"] if short else 0
                    short.append(piece)
                    if piece["ahead"] + piece["length"] >= BUNDLE:
                        made.append(short)
                        short = []
            yield _item_batch(made, piece_type)
        if short:
            yield _item_batch([short], piece_type)
        # workers are used again, by other stages too
        tok.forget()
        give_back()

    kinds = {"doc_id": "long", "text": "string"} | ({label: "string"} if label else {})
    rows = docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])
    return rows.mapInArrow(task, ITEMS.replace("ahead:long", f"ahead:long,{label}:string") if label else ITEMS)


def _item_batch(made: list[list[dict]], piece_type: pa.DataType) -> pa.RecordBatch:
    length = [parts[-1]["ahead"] + parts[-1]["length"] for parts in made]
    return pa.record_batch({
        "length": pa.array(length, pa.int64()), "parts": pa.array(made, pa.list_(piece_type)),
    })


def best_pattern(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within ``room`` of most worth, by dynamic programming."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fits = np.flatnonzero(sizes <= r)
        value[r], last[r] = value[r - 1], -1
        if len(fits):
            got = value[r - sizes[fits]] + worth[fits]
            k = int(got.argmax())
            if got[k] > value[r] + 1e-12:
                value[r], last[r] = got[k], fits[k]
    counts, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            counts[last[r]] += 1
            r -= sizes[last[r]]
    return float(value[room]), counts


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, most: int = 3000) -> list[tuple[int, np.ndarray]]:
    """(times, pattern) that cover ``demand`` exactly. Columns are generated until the
    reduced cost is within 1e-6 or after ``most`` steps; any basis on the way is a cover."""
    m = len(sizes)
    columns = np.diag(np.minimum(room // sizes, np.maximum(demand, 1))).astype(float)
    for _ in range(most):
        worth = np.linalg.solve(columns.T, np.ones(m))
        value, pattern = best_pattern(sizes, np.maximum(worth, 0), room)
        if value <= 1 + 1e-6:
            break
        used = np.linalg.solve(columns, demand.astype(float))
        way = np.linalg.solve(columns, pattern.astype(float))
        up = np.flatnonzero(way > 1e-9)
        leaving = up[np.argmin(np.maximum(used[up], 0) / way[up])]
        columns[:, leaving] = pattern
    times = np.floor(np.maximum(np.linalg.solve(columns, demand.astype(float)), 0) + 1e-7).astype(np.int64)
    found, left = [], demand.copy()
    for k in np.argsort(-times):
        column = np.rint(columns[:, k]).astype(np.int64)
        n = min(int(times[k]), *(left[column > 0] // column[column > 0]).tolist()) if column.any() else 0
        if n > 0:
            found.append((n, column))
            left = left - n * column
    while left.any():  # first fit decreasing of the few that are left
        pattern, free = np.zeros(m, np.int64), room
        for i in np.argsort(-sizes):
            n = min(int(left[i]), free // int(sizes[i]))
            pattern[i] += n
            free -= n * int(sizes[i])
        n = int((left[pattern > 0] // pattern[pattern > 0]).min())
        found.append((n, pattern))
        left = left - n * pattern
    return found


def plan(spark: SparkSession, counts: dict[int, int], room: int) -> DataFrame:
    """Ranges of ranks: (class, first, until, each, sequence): the pieces of a class ranked
    first..until go ``each`` to a sequence, from ``sequence`` on."""
    sizes = np.array(sorted(counts), np.int64)
    rows, sequence = [], 0
    taken = dict.fromkeys(counts, 0)
    if len(sizes):
        for n, pattern in solve(sizes, np.array([counts[int(s)] for s in sizes], np.int64), room):
            for s, each in zip(sizes.tolist(), pattern.tolist(), strict=True):
                if each:
                    rows.append((s, taken[s], taken[s] + n * each, each, sequence))
                    taken[s] += n * each
            sequence += n
    return spark.createDataFrame(rows, "class long, first long, until long, each long, sequence long")


def ranked(items: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """``items`` with ``rank``: its number, from 0, among those of its class. A class is
    numbered in ``parts`` parts, each behind the parts before it."""
    part = F.pmod(F.xxhash64(*order), F.lit(parts))
    own = items.withColumn("_part", part).withColumn(
        "_in_part", F.row_number().over(Window.partitionBy("class", "_part").orderBy(*order)) - 1
    )
    sizes = items.withColumn("_part", part).groupBy("class", "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.withColumn("_ahead", F.coalesce(ahead, F.lit(0))).drop("_n")
    joined = own.join(before, ["class", "_part"])
    return joined.withColumn("rank", F.col("_in_part") + F.col("_ahead")).drop("_part", "_in_part", "_ahead")


def pack(cut: DataFrame, room: int = SEQUENCE, width: int = CLASS) -> DataFrame:
    """The pieces of ITEMS with sequence_id and offset, and their label last. ``cut`` is kept in the checkpoint
    folder, as its counts and its ranks must come from the same rows."""
    spark = cut.sparkSession
    held = cut_lineage(cut.withColumn("class", F.ceil(F.col("length") / width)))
    counts = {r["class"]: r["count"] for r in held.groupBy("class").count().collect()}  # room / width rows at most
    ranges = F.broadcast(plan(spark, counts, room // width))  # a few thousand rows at most
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("parts")[0][c] for c in ("doc_id", "start", "ids_crc32")] + [F.col("length")]
    placed = ranked(held, order, parts).join(ranges, "class").filter(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until"))
    )
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.expr("(rank - first) div each"))
    row = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.sum("length").over(row), F.lit(0)))
    pieces = placed.select("sequence_id", "at", F.explode("parts").alias("p"))
    fields = cut.schema["parts"].dataType.elementType.names
    return pieces.select(
        "p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens", "sequence_id",
        (F.col("at") + F.col("p.ahead")).alias("offset"), *[f"p.{c}" for c in fields[len(PIECE):]],
    )
