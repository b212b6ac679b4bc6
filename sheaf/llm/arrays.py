"""Words of Arrow text columns as numpy arrays, without a Python object per word.

Tasks walk their Arrow batches in blocks of half a megabyte of text (``blocks``), as their arrays of
64-bit words take many times that, so a task's memory is bounded by its batch and the block
size or its longest single document. Hashes are
64-bit polynomials over random byte values; callers that decide by hash alone combine two
independent ones (``seed``) into 128 bits.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
U64 = np.uint64

# The separators of the word pattern [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IN_WORD = np.ones(256, bool)
IN_WORD[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Block:
    """Some consecutive documents: ids (as they came, and as integers with -1 for null),
    the joined UTF-8 bytes, the byte offset of each document (one more at the end), which
    texts are null, and the rows of the batch they stand for."""

    key: pa.Array
    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray
    rows: pa.RecordBatch

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of about ``limit`` text bytes (one document at least). A null text has no bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(text_col).cast(pa.large_string())
        null = np.asarray(text.is_null())
        if null.any():
            text = text.fill_null("")
        n = len(text)
        _, off_buf, data_buf = text.buffers()
        offsets = np.frombuffer(off_buf, np.int64)[text.offset:text.offset + n + 1]
        data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
        ids = np.asarray(batch.column(id_col).cast(pa.int64()).fill_null(-1))
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
            key = batch.column(id_col).slice(a, b - a)
            rows = batch.slice(a, b - a)
            yield Block(key, ids[a:b], data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], null[a:b], rows)
            a = b
    give_back()


_given = [0.0]


def give_back() -> None:
    """Return freed memory to the system, once in a while: a worker is used again by later
    stages, and what an earlier one has freed would stay with it beside their own."""
    if time.monotonic() - _given[0] < 1:
        return
    POWERS.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    _given[0] = time.monotonic()


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that do not cross a document border."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge[:n] | ~before))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the index of each document's first word
    (one more at the end)."""
    starts, ends = spans(IN_WORD[block.data], block.offsets)
    return starts, ends, np.searchsorted(starts, block.offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """The powers of one odd number modulo 2**64 and their inverses, for slices of any length;
    every ``Rolling`` uses them, as they are as long as the longest block."""

    def __init__(self):
        self.base = 0x9E3779B97F4A7C15 | 1
        self.forget()

    def forget(self) -> None:
        self.powers = self.inverses = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) <= n:
            n = max(n + 1, 2 * len(self.powers))
            self.powers, self.inverses = (self._of(x, n) for x in (self.base, pow(self.base, -1, 1 << 64)))
        return self.powers, self.inverses

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, U64)
        out[0] = 1
        return np.multiply.accumulate(out, out=out)


POWERS = Powers()


class Rolling:
    """Hashes of many slices of one array from prefix sums modulo 2**64: value * P**index
    summed, then moved to index 0 by the inverse power. Each has byte values of its own, so
    two hashes of bytes are independent; of one array of symbols all are the same hash."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
        # symbols are multiplied by a number of this hash's own before they are summed
        self.spread = (int(rng.integers(1 << 61, 1 << 62)) << 1) | 1

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of values[s:e] for every (s, e)."""
        powers, inverses = POWERS.upto(len(values))
        prefix = np.zeros(len(values) + 1, U64)
        np.multiply(values, powers[:len(values)], out=prefix[1:])
        np.cumsum(prefix, out=prefix)
        h = (prefix[ends] - prefix[starts]) * inverses[starts]
        return mix(h * U64(self.spread) + (ends - starts).astype(U64))

    def of_bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.slices(self.table[data], starts, ends)


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word of every ``width``-word window inside one document, and its document."""
    count = np.maximum(np.diff(first) - width + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    ahead = np.cumsum(count) - count
    return np.arange(len(doc)) - ahead[doc] + first[:-1][doc], doc


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
