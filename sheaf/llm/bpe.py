"""Byte-level BPE encoding by a pair occurrence index, and decoding.

A task takes the distinct pre-tokens of a block of texts, indexes every adjacent pair of
symbols by its merge rank (rank -> all its positions), and applies the ranks that occur in
ascending order, all positions of one rank at once; each merge files its new neighbours
under their own ranks. Merges of a learned vocabulary only use symbols made by earlier
merges, so a rank never comes up again once it has been passed. Encoded pre-tokens are
remembered up to a bound.

Cases: a null text counts as empty and has no ids; null ids of documents stay; every row
gives one row; an empty table gives none; extra columns are not read. Whole texts of any
length are encoded; a block is a few megabytes of text or one longer text.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.arrays import blocks

# How byte-level vocabularies split texts before the merges.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 8 << 20
REMEMBERED = 600_000


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Merges by rank, the bytes of every id, and the added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        vocab = parts["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.of_byte = np.array([vocab[c] for c in letters], np.int32)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in parts["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.size = max(max(vocab.values()), *(x["id"] for x in parts["added_tokens"]), 0) + 1
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.added = {x["content"]: x["id"] for x in parts["added_tokens"]}
        self.bytes = [b""] * self.size
        for word, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in word) if all(c in byte_of for c in word) else word.encode()
        for word, i in self.added.items():
            self.bytes[i] = word.encode()
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _chains(pos: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions whose pairs may overlap (equal symbols), every other one of a chain."""
    linked = np.zeros(len(pos), bool)
    linked[1:] = following[pos[:-1]] == pos[1:]
    first = np.maximum.accumulate(np.where(linked, 0, np.arange(len(pos))))
    return pos[(np.arange(len(pos)) - first) % 2 == 0]


def merge_all(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, and where each word's ids end."""
    sizes = np.array([len(w) for w in words])
    n = int(sizes.sum())
    symbol = np.append(vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)], -1)
    ends = np.cumsum(sizes)
    # neighbours by position; n stands for "none"
    following = np.arange(1, n + 2)
    before = np.arange(-1, n)
    following[ends[sizes > 0] - 1] = n
    following[n] = n
    starts = ends - sizes
    before[starts[sizes > 0]] = n
    before = np.append(before, n)
    alive = np.ones(n + 1, bool)
    alive[n] = False
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def file(pos: np.ndarray) -> None:
        rank = vocab.ranks(symbol[pos], symbol[following[pos]])
        known = rank >= 0
        pos, rank = pos[known], rank[known]
        if not len(pos):
            return
        by = np.argsort(rank, kind="stable")
        pos, rank = pos[by], rank[by]
        cut = np.flatnonzero(np.diff(rank)) + 1
        for part, r in zip(np.split(pos, cut), rank[np.append(0, cut)].tolist(), strict=True):
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(part)

    file(np.flatnonzero(following[:n] != n))
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        pos = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        a, b = vocab.left[r], vocab.right[r]
        pos = pos[alive[pos] & (symbol[pos] == a) & (symbol[following[pos]] == b)]
        if a == b and len(pos) > 1:
            pos = _chains(np.sort(pos), following)
        if not len(pos):
            continue
        gone = following[pos]
        after = following[gone]
        symbol[pos] = vocab.made[r]
        alive[gone] = False
        following[pos] = after
        before[after] = pos
        before[n] = n
        touched = np.concatenate([before[pos], pos])
        touched = touched[alive[touched]]
        file(np.unique(touched[following[touched] != n]))
    kept = alive[:n]
    return symbol[:n][kept], np.concatenate([[0], np.cumsum(kept)])[ends]


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, remembering pre-tokens and the pieces
    between single spaces."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pattern = regex.compile(PRE_TOKENS)
        self.two_spaces = regex.compile(r"\s\s|[^\S \n]|^\s|\s$")
        self.tokens: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def _learn(self, words: Iterable[str]) -> None:
        new = [w for w in words if w not in self.tokens]
        if not new:
            return
        ids, ends = merge_all(self.vocab, [w.encode() for w in new])
        raw, a = ids.astype("<i4").tobytes(), 0
        for w, b in zip(new, (4 * ends).tolist(), strict=True):
            self.tokens[w] = raw[a:b]
            a = b

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.tokens) + len(self.spaced) + len(self.plain) > REMEMBERED:
            self.tokens, self.spaced, self.plain = {}, {}, {}
        # a text is lines of pieces between single spaces, or else its list of pre-tokens
        parts: list[list] = []
        spaced, plain, words = set(), set(), set()
        for text in texts:
            own: list = []
            for segment in self.vocab.splitter.split(text) if self.vocab.splitter else [text]:
                if segment in self.vocab.added:
                    own.append(self.vocab.added[segment].to_bytes(4, "little"))
                elif self.two_spaces.search(segment):
                    found = self.pattern.findall(segment)
                    words.update(found)
                    own.append(found)
                elif segment:
                    lines = [line.split(" ") for line in segment.split("\n")]
                    for line in lines:
                        plain.add(line[0])
                        spaced.update(line[1:])
                    own.append(lines)
            parts.append(own)
        known = {}
        for pieces, held, lead in ((spaced, self.spaced, " "), (plain, self.plain, "")):
            for p in pieces:
                if p not in held:
                    found = self.pattern.findall(lead + p)
                    known[lead, p] = found
                    words.update(found)
        words.add("\n")
        self._learn(words)
        tokens = self.tokens
        for (lead, p), found in known.items():
            (self.spaced if lead else self.plain)[p] = b"".join([tokens[w] for w in found])
        line_end = tokens["\n"]
        out = []
        for own in parts:
            ids = []
            for part in own:
                if isinstance(part, bytes):
                    ids.append(part)
                elif isinstance(part[0], str):
                    ids += [tokens[w] for w in part]
                else:
                    for k, line in enumerate(part):
                        if k:
                            ids.append(line_end)
                        ids.append(self.plain[line[0]])
                        ids += map(self.spaced.__getitem__, line[1:])
            out.append(b"".join(ids))
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(vocab.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``ids`` of the whole text under the tokenizer file ``path`` (there on every
    executor), and ``decoded``, the text of those ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, enc = vocabulary(path), encoder(path)
        for block in blocks(batches, "doc_id", "text", BLOCK):
            raw = enc.encode([block.text(i).decode() for i in range(len(block))])
            flat = np.frombuffer(b"".join(raw), "<i4")
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])])
            decoded = [decode_ids(vocab, flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch({
                "doc_id": block.key,
                "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                "decoded": pa.array(decoded, pa.string()),
            })

    return _texts(docs).mapInArrow(task, "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """The number of ids and the digests of the ids and of the decoded text."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
