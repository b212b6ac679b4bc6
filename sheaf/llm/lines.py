"""Line dedup: two Bloom filters leave only suspected repeats to shuffle.

A line's key is the line stripped of ASCII white space, with A-Z lower-cased. A first pass
sends each task's distinct 64-bit hashes of long keys (twice at most) to the owner of their
page of the hash space. The owner puts every hash into its page's once-seen filter; one that
was in there already goes into the page's twice-seen filter as well. A second pass probes
the twice-seen filters and sends on only suspected repeats, as 128-bit hashes with their
document; those are counted exactly, the keeper is the largest doc_id, and every other
document gets the list of keys it loses. Texts are cut by a third pass.

Sizes: a page takes ``PAGE_KEYS`` hashes, so an owner's memory is fixed and the pages grow
with the lines. The twice-seen filters travel to every task and are bounded together by
``MOST_BITS``: up to about 50 million hashes in them (``TWICE_BITS`` 4 a hash sent) wrong suspicions
stay rare; beyond, more lines travel to the exact count. Rows never depend on it.

Cases: a null or empty text is one empty line; keys shorter than ``least`` code points always
stay. Rows of one doc_id are one document, rows without an id are one that comes before all
others. Repeated lines of the keeper all stay. Every row gives one row, repeated ones too; an
empty table none. Only doc_id and text are read, so extra columns cannot clash. A hot line
sends two hashes a task to its owner; suspects are counted after a split by document and
meet the confirmed keys under ``SALTS`` salts. Long texts cost time and memory linear in their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.arrays import IN_WORD, LOWER, Block, Rolling, blocks, mix, signed
from sheaf.session import stored

LEAST = 40
DOCUMENTS = 5
PAGE_KEYS = 1 << 17
ONCE_BITS = 10
TWICE_BITS = 4
MOST_BITS = 1 << 28
PROBES = 4
SALTS = 16
SENT = 1 << 16
U64 = np.uint64


def split_lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the lines, and the index of each document's first line (one
    more at the end). A document has one line more than line feeds."""
    feeds = np.flatnonzero(block.data == 0x0A)
    doc = np.searchsorted(block.offsets, feeds, "right") - 1
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(block)) + 1)])
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    starts[first[:-1]], ends[first[1:] - 1] = block.offsets[:-1], block.offsets[1:]
    at = np.arange(len(feeds)) + doc
    ends[at], starts[at + 1] = feeds, feeds + 1
    return starts, ends, first


def long_keys(block: Block, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines whose key has ``least`` code points or more, and the keys' byte bounds."""
    solid = np.flatnonzero(IN_WORD[block.data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    lines = np.flatnonzero(b > a)
    a, b = solid[a[lines]], solid[b[lines] - 1] + 1
    points = np.concatenate([[0], np.cumsum(block.data & 0xC0 != 0x80)])
    enough = points[b] - points[a] >= least
    return lines[enough], a[enough], b[enough]


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int):
        self.on = np.zeros(bits, bool)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([self.on[p] for p in probes(hashes, len(self.on))])

    def add(self, hashes: np.ndarray) -> None:
        for p in probes(hashes, len(self.on)):
            self.on[p] = True


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    a, step = mix(hashes ^ U64(0x5851F42D4C957F2D)), mix(hashes ^ U64(0x14057B7EF767814F)) | U64(1)
    return [((a + U64(i) * step) % U64(bits)).astype(np.int64) for i in range(PROBES)]


def page_of(hashes: np.ndarray, pages: int) -> np.ndarray:
    return (mix(hashes) % U64(pages)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))


def _hashes(docs: DataFrame, least: int) -> DataFrame:
    """hash, again: the long keys of every task, each with whether two rows of one block
    hold it. A hash sent as held twice is not sent again while it is remembered."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, sent = Rolling(11), np.zeros(0, U64)
        for block in blocks(batches, "doc_id", "text"):
            starts, ends, first = split_lines(block)
            lines, a, b = long_keys(block, starts, ends, least)
            h = rolling.of_bytes(LOWER[block.data], a, b)
            doc = np.searchsorted(first, lines, "right") - 1
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, n = np.unique(h[new], return_counts=True)
            unsent = ~np.isin(h, sent)
            h, again = h[unsent], n[unsent] > 1
            sent = np.concatenate([sent, h[again]])[-SENT:]
            yield pa.record_batch({"hash": signed(h), "again": again})

    return docs.mapInArrow(task, "hash long, again boolean")


def twice_seen(docs: DataFrame, least: int = LEAST) -> np.ndarray:
    """The twice-seen filters, one row of packed bits a page: every key held by two rows is
    in its page's filter, and seldom another."""
    sent = stored(_hashes(docs, least))
    count = sent.count()
    pages = max(1, -(-count // PAGE_KEYS))
    keys = -(-count // pages)
    once_bits = 64 + ONCE_BITS * keys
    twice_bits = 8 * max(1, min(64 + TWICE_BITS * keys, MOST_BITS // pages) // 8)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, once, twice = -1, Filter(1), Filter(1)
        for batch in batches:
            of = np.asarray(batch.column("page"))
            hashes = np.asarray(batch.column("hash")).view(U64)
            again = np.asarray(batch.column("again"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if of[i] != page:
                    if twice.on.any():
                        yield _packed(page, twice)
                    page, once, twice = int(of[i]), Filter(once_bits), Filter(twice_bits)
                h, at, n = np.unique(hashes[i:j], return_inverse=True, return_counts=True)
                flagged = np.zeros(len(h), bool)
                flagged[at[again[i:j]]] = True
                twice.add(h[flagged | (n > 1) | once.holds(h)])
                once.add(h)
        if twice.on.any():
            yield _packed(page, twice)

    def to_page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = page_of(np.asarray(batch.column("hash")).view(U64), pages)
            yield pa.record_batch({"page": of, "hash": batch.column("hash"), "again": batch.column("again")})

    dealt = sent.mapInArrow(to_page, "page long, hash long, again boolean").repartition("page")
    rows = dealt.sortWithinPartitions("page").mapInArrow(task, "page long, bits binary").collect()  # MOST_BITS at most
    out = np.zeros((pages, twice_bits // 8), np.uint8)
    for row in rows:
        out[row.page] = np.frombuffer(row.bits, np.uint8)
    return out


def _packed(page: int, twice: Filter) -> pa.RecordBatch:
    return pa.record_batch({"page": pa.array([page], pa.int64()), "bits": pa.array([np.packbits(twice.on).tobytes()], pa.binary())})


def _suspected(hashes: np.ndarray, filters: np.ndarray) -> np.ndarray:
    page = page_of(hashes, len(filters))
    found = np.ones(len(hashes), bool)
    for p in probes(hashes, filters.shape[1] * 8):
        found &= filters[page, p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1 > 0
    return found


def _suspects(docs: DataFrame, filters: np.ndarray, least: int) -> DataFrame:
    """doc_id, text_hash, h1, h2: once for each row and suspected key in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_hash, second_hash = Rolling(11), Rolling(12)
        for block in blocks(batches, "doc_id", "text"):
            starts, ends, first = split_lines(block)
            lines, a, b = long_keys(block, starts, ends, least)
            lowered = LOWER[block.data]
            h1 = first_hash.of_bytes(lowered, a, b)
            at = np.flatnonzero(_suspected(h1, filters))
            if not len(at):
                continue
            h1, h2 = h1[at], second_hash.of_bytes(lowered, a[at], b[at])
            doc = np.searchsorted(first, lines[at], "right") - 1
            order = np.lexsort((h2, h1, doc))
            h1, h2, doc = h1[order], h2[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            rows = pa.array(doc[new])
            yield pa.record_batch({
                "doc_id": block.key.take(rows),
                "text_hash": block.rows.column("text_hash").take(rows),
                "h1": signed(h1[new]),
                "h2": signed(h2[new]),
            })

    return docs.mapInArrow(task, "doc_id long, text_hash long, h1 long, h2 long")


def _losses(suspects: DataFrame, documents: int) -> DataFrame:
    """doc_id, text_hash and ``gone``, the keys that rows lose."""
    held = suspects.select("h1", "h2", "doc_id").distinct()
    confirmed = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.max("doc_id").alias("_keeper"))
    confirmed = confirmed.filter(F.col("_n") >= documents).select(
        "h1", "h2", "_keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    salted = suspects.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int"))
    lost = salted.join(confirmed, ["h1", "h2", "_salt"])
    lost = lost.filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("_keeper")))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))


RESULT = "doc_id long, n_lines long, n_dropped long, kept string"


def _cut(rows: DataFrame, least: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_hash, second_hash = Rolling(11), Rolling(12)
        for block in blocks(batches, "doc_id", "text"):
            starts, ends, first = split_lines(block)
            counts = np.diff(first)
            gone = block.rows.column("gone")
            changed = np.flatnonzero(np.asarray(gone.is_valid()))
            dropped = np.zeros(len(starts), bool)
            texts = block.rows.column("text").cast(pa.string()).fill_null("")
            if len(changed):
                lines, a, b = long_keys(block, starts, ends, least)
                lowered = LOWER[block.data]
                keys = np.rec.fromarrays([
                    np.searchsorted(first, lines, "right") - 1,
                    signed(first_hash.of_bytes(lowered, a, b)),
                    signed(second_hash.of_bytes(lowered, a, b)),
                ])
                pairs = gone.flatten()
                listed = np.rec.fromarrays([
                    np.repeat(changed, np.asarray(gone.value_lengths().drop_null())),
                    np.asarray(pairs.field("h1")),
                    np.asarray(pairs.field("h2")),
                ])
                dropped[lines[np.isin(keys, listed)]] = True
                out, done = [], 0
                for d in changed:
                    stay = np.flatnonzero(~dropped[first[d]:first[d + 1]]) + first[d]
                    text = b"\n".join(block.data[starts[i]:ends[i]].tobytes() for i in stay)
                    out += [texts.slice(done, d - done), pa.array([text.decode()], pa.string())]
                    done = d + 1
                texts = pa.concat_arrays([*out, texts.slice(done)])
            yield pa.record_batch({
                "doc_id": block.key,
                "n_lines": counts,
                "n_dropped": np.add.reduceat(dropped.astype(np.int64), first[:-1]),
                "kept": texts,
            })

    return rows.mapInArrow(task, RESULT)


def dedup(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: the text without the lines whose key has ``least``
    code points and is held by ``documents`` documents, other than in the last of them."""
    docs = _texts(docs)
    suspects = stored(_suspects(docs, twice_seen(docs, least), least))
    lost = stored(_losses(suspects, documents)).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "gone"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    return _cut(docs.join(lost, same, "left").select("doc_id", "text", "gone"), least)
