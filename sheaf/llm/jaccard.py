"""N-gram Jaccard self-join with prefix filters under several token orders.

A document is the set of its shingles (five lower-cased words); documents link at a
Jaccard similarity of 0.8. Under any one order of all shingles, two linked sets share a
shingle among the first n - ceil(0.8 n) + 1 of each, so a candidate pair must share one
under every order used. The orders put frequent shingles last (those that make up
more than FREQUENT of all are counted first), and are otherwise two different hashes.

1. Each document gets its set's size and 128-bit fingerprint; documents with equal sets
   are one class, named by its smallest document.
2. Prefix shingles are grouped. A group is cut where sizes are too far apart, and a pair
   is left out where its positions in the order leave too few shingles to share. Small
   groups give all pairs; large ones give the pairs with a hub, the member whose prefix
   starts with shared shingles.
3. Pairs found under all orders are verified on the whole sets and joined to components.
4. Large groups whose members are not yet all connected give every pair between different
   components, again under all orders, so no link is lost; these are verified as well.

``join`` gives components, for which a hub's pairs do; ``links`` gives every link between
different sets: large groups give all pairs there, dealt by token and salt. ``link_counts`` has
a row a document, with its class and its number of links.

Cases: a null text or one without words has no shingles and links with nothing; under five
words the whole sequence is the one shingle; a null doc_id is reported with its size and a
null component and links with nothing; rows that share a doc_id count as one document;
ties and repeated rows need no rule beyond that; an empty table gives none; extra columns
are not read. Texts of any length are read whole. Groups are read in the order of a sort:
a task holds one batch and a group of up to SMALL_GROUP rows. Shingles of more than
2**(HOT_LEVEL - 1) documents are dealt over SALTS; of others the frequent table misses
one document a counting window at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.arrays import IN_WORD, LOWER, U64, Block, Rolling, blocks, mix, signed, spans
from sheaf.llm.graph import components, few
from sheaf.session import stored

WORDS = 5
ORDERS = 2
# share of all shingles from which one is counted as frequent: at most 1 / FREQUENT are,
# which bounds their table to 9 bytes times that. Tasks report what recurs LOCAL_LEAST
# times among COUNTED shingles. Any table gives right results; a good one small groups.
FREQUENT = 2.5e-7
LOCAL_LEAST = 2
COUNTED = 4_000_000
SMALL_GROUP = 32
# members of a large group that one task pairs with all of it
SALT_ROWS = 256
# level (logarithm of the count) from which a shingle's rows are dealt over several tasks
HOT_LEVEL = 12
SALTS = 64
# sets that a task remembers to leave out repeated rows
MET = 1 << 18

_WORD, _WORD2, _SPAN, _SPAN2 = (Rolling(s) for s in (201, 202, 203, 204))
_SALT = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]


def required(a, b):
    """The least number of shared shingles of linked sets of ``a`` and ``b``:
    100 i >= 80 (a + b - i)."""
    return (4 * (a + b) + 8) // 9


def prefix_length(n):
    """First shingles of which linked sets share one: all but ceil(0.8 n) - 1."""
    return n - (4 * n + 4) // 5 + 1


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of a block by document (sorted by name there), their second
    names, and the index of each document's first (one more at the end)."""
    data = LOWER[block.data]
    starts, ends = spans(IN_WORD[data], block.offsets)
    first = np.searchsorted(starts, block.offsets)
    size = np.diff(first)
    count = np.where(size >= WORDS, size - WORDS + 1, np.minimum(size, 1))
    doc = np.repeat(np.arange(len(block)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
    until = at + np.minimum(WORDS, size[doc])
    h1 = _SPAN.slices(_WORD.of_bytes(data, starts, ends), at, until)
    h2 = _SPAN2.slices(_WORD2.of_bytes(data, starts, ends), at, until)
    by = np.lexsort((h1, doc))
    h1, h2, doc = h1[by], h2[by], doc[by]
    new = np.ones(len(doc), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (doc[1:] != doc[:-1])
    h1, h2, doc = h1[new], h2[new], doc[new]
    return h1, h2, np.searchsorted(doc, np.arange(len(block) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])[first])


def _fingerprints(h1: np.ndarray, h2: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever its order."""
    return mix(_sums(mix(h1 + _SALT[2]), first)), mix(_sums(mix(h2 + _SALT[1]), first))


def _recurring(names: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``names``, which are sorted in place, that come ``least`` times, and how often."""
    names.sort()  # np.unique would hold several copies
    new = np.append(True, names[1:] != names[:-1])[:max(len(names) - least + 1, 0)]
    at = np.flatnonzero(new & (names[:len(new)] == names[least - 1:]))
    often = names[at]
    return often, np.searchsorted(names, often, "right") - at


def profiles(docs: DataFrame) -> DataFrame:
    """A row (kind 0) for each document: id, n and fingerprint; and rows (kind 1) for
    shingles that recur in a task: their name in k1 and in n how many documents had it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(COUNTED, U64), 0  # memory only as far as it is filled

        def frequent():
            names, count = _recurring(held[:size], max(LOCAL_LEAST, int(np.ceil(FREQUENT * size))))
            zero = np.zeros(len(names), np.int64)
            return pa.record_batch({
                "kind": np.ones(len(names), np.int32), "id": zero, "n": count, "k1": signed(names), "k2": zero,
            })

        for block in blocks(batches, "doc_id", "text"):
            h1, h2, first = shingles(block)
            k1, k2 = _fingerprints(h1, h2, first)
            yield pa.record_batch({
                "kind": np.zeros(len(block), np.int32), "id": block.key, "n": np.diff(first).astype(np.int64),
                "k1": signed(k1), "k2": signed(k2),
            })
            if size + len(h1) > len(held):
                held.resize(size + len(h1), refcheck=False)
            held[size:size + len(h1)] = h1
            size += len(h1)
            if size >= COUNTED:
                yield frequent()
                held, size = np.empty(COUNTED, U64), 0
        if size:
            yield frequent()

    return docs.mapInArrow(task, "kind int, id long, n long, k1 long, k2 long")


def frequent_shingles(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Names, sorted, of the shingles that make up FREQUENT of all (so at most 1 / FREQUENT
    of them), and the logarithm of their counts."""
    total = found.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    counts = found.filter("kind = 1").groupBy("k1").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= max(2, FREQUENT * total)).toArrow()
    names = np.asarray(rows["k1"].combine_chunks()).view(U64)
    level = np.ceil(np.log2(np.maximum(np.asarray(rows["n"].combine_chunks()), 2))).astype(np.uint8)
    by = np.argsort(names)
    return names[by], level[by]


def _ordered(h1: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], order: int) -> np.ndarray:
    """Sort keys under an order: frequent shingles last by their level, else by hash."""
    names, level = frequent
    key = mix(h1 ^ _SALT[order]) >> U64(6)
    if len(names) and len(h1):
        at = np.minimum(np.searchsorted(names, h1), len(names) - 1)
        key |= np.where(names[at] == h1, level[at], 0).astype(U64) << U64(58)
    return key


TOKENS = "token long, id long, place long, salt long"


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], orders: int = ORDERS) -> DataFrame:
    """token (a shingle under one order: its lowest bit or bits name the order), id, place
    (size * 2**32 + position) of every prefix shingle, and salt: 0, or 1 to SALTS where the
    shingle is hot. Sets that a task has met before are left out; the class is found by its
    first document there."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    hot, salts = U64(HOT_LEVEL), U64(SALTS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for block in blocks(batches, "doc_id", "text"):
            h1, h2, first = shingles(block)
            k1, k2 = _fingerprints(h1, h2, first)
            new = np.zeros(len(block), bool)
            if len(met) > MET:
                met.clear()  # what comes again is named like its class later
            for i, key in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                if key not in met:
                    met.add(key)
                    new[i] = True
            size = np.diff(first)
            doc = np.repeat(np.arange(len(block)), size)
            take = np.where(new, prefix_length(size), 0)
            for order in range(orders):
                key = _ordered(h1, shared.value, order)
                by = np.lexsort((key, doc))
                place = np.arange(len(doc)) - first[:-1][doc]
                kept = place < take[doc]
                rows, own, place = by[kept], doc[kept], place[kept]
                token = (mix(h1[rows] + _SALT[order]) & ~U64(3)) | U64(order)
                dealt = mix(block.ids[own].view(U64)) % salts + U64(1)
                yield pa.record_batch({
                    "token": signed(token), "id": block.ids[own], "place": (size[own] << 32) + place,
                    "salt": np.where(key[rows] >> U64(58) >= hot, signed(dealt), 0),
                })

    return docs.mapInArrow(task, TOKENS)


FOUND = "a long, b long, orders int, token long, place long"


def _pairs_of(ids: np.ndarray, n: np.ndarray, pos: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether members i and j can be linked, this being their first shared shingle."""
    need = required(n[i], n[j])
    return (ids[i] != ids[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix shingles in the order of token and place: candidate pairs (a < b, with the bit
    of their order) of small groups, and the members of large or hot ones (id in a, b null).
    A new group begins with a token, or where the smaller sets before are too small."""
    held = [np.zeros(0, np.int64)] * 4  # the last group, while it may still grow
    going = None  # token and size of the last row, where its large group may go on
    for batch in chain(batches, [None]):
        more = [np.asarray(batch.column(k)) for k in range(4)] if batch is not None else [held[0][:0]] * 4
        token, ids, place, salt = rows = [np.concatenate(x) for x in zip(held, more, strict=True)]
        if not len(token):
            continue
        n, pos = place >> 32, place & 0xFFFFFFFF
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (5 * n[:-1] < 4 * n[1:])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(token)))
        of = np.cumsum(new) - 1
        large = (size > SMALL_GROUP) | (salt[at] > 0)
        large[0] |= going is not None and going[0] == token[0] and 5 * going[1] >= 4 * n[0]
        going = (token[-1], n[-1]) if large[-1] else None
        until = len(token) if large[-1] or batch is None else at[-1]
        held = [x[until:] for x in rows]
        # all pairs of small groups: each member with the one k further on
        one = np.flatnonzero((~large & (size > 1))[of[:until]])
        left = size[of[one]] - 1 - (one - at[of[one]])
        pairs = []
        while len(one := one[left > len(pairs)]):
            left = left[left > len(pairs)]
            pairs.append((one, one + len(pairs) + 1))
        if pairs:
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            ok = _pairs_of(ids, n, pos, i, j)
            i, j = i[ok], j[ok]
            a, b, order = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), token[i] & 3
            by = np.lexsort((order, b, a))
            a, b, order = a[by], b[by], order[by]
            once = np.ones(len(a), bool)
            once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (order[1:] != order[:-1])
            a, b, order = a[once], b[once], order[once]
            none = pa.nulls(len(a), pa.int64())
            yield pa.record_batch({
                "a": pa.array(a), "b": pa.array(b), "orders": pa.array((1 << order).astype(np.int32)), "token": none, "place": none,
            })
        members = np.flatnonzero(large[of[:until]])
        if len(members):
            yield pa.record_batch({
                "a": pa.array(ids[members]), "b": pa.nulls(len(members), pa.int64()),
                "orders": pa.array((1 << (token[members] & 3)).astype(np.int32)),
                "token": pa.array(token[members]), "place": pa.array(place[members]),
            })


def _with_hubs(members: DataFrame) -> DataFrame:
    """Members of large groups (token, orders, place, id) as token (a group's own number),
    orders, id, n, left (shingles from its position on), and the hub of the group with its
    n and left: the member whose shared shingles come first, so has fewest of its own.
    Members that no other's size allows a link with have a false ``able``."""
    n, pos = F.shiftright("place", 32), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    rows = members.select("token", "orders", "id", n.alias("n"), pos.alias("pos"), (n - pos).alias("left"))
    # each task passes on one row a token and size; groups are cut where sizes are too far apart
    reach = F.floor((9 * F.col("left") - 4 * F.col("n")) / 4)
    sizes = rows.groupBy("token", "n").agg(F.min(F.struct("pos", "id", "n", "left")).alias("lead"), F.max(reach).alias("reach"))
    by_size = Window.partitionBy("token").orderBy("n")
    far = F.coalesce(5 * F.lag("n").over(by_size) < 4 * F.col("n"), F.lit(False))
    cut = sizes.withColumn("far", far.cast("int")).withColumn("part", F.sum("far").over(by_size))
    group = Window.partitionBy("token", "part")
    hubs = stored(cut.select(
        "token", "n", "part", F.min("lead").over(group).alias("hub"), F.min("n").over(group).alias("least"), F.max("reach").over(group).alias("most")
    ))
    return rows.join(few(hubs), ["token", "n"]).select(
        F.xxhash64("token", "part").alias("token"), "orders", "id", "n", "left",
        F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.left").alias("hub_left"),
        ((reach >= F.col("least")) & (F.col("n") <= F.col("most"))).alias("able"),
    )


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and its shingles (array of longs) of the ``wanted`` documents (id)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "doc_id", "text"):
            h1, _, first = shingles(block)
            values = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(signed(h1)))
            yield pa.record_batch({"id": block.key, "shingles": values})

    own = docs.join(wanted, F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text")
    return own.mapInArrow(task, "id long, shingles array<long>")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked."""
    ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    found = sets(docs, few(ids))
    one = found.select(F.col("id").alias("a"), F.col("shingles").alias("_sa"))
    two = found.select(F.col("id").alias("b"), F.col("shingles").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    linked = 100 * both >= 80 * (F.size("_sa") + F.size("_sb") - both)
    return pairs.join(one, "a").join(two, "b").filter(linked).select("a", "b").distinct()


def _under_all(pairs: DataFrame, orders: int) -> DataFrame:
    met = pairs.groupBy("a", "b").agg(F.bit_or("orders").alias("_met"))
    return met.filter(F.col("_met") == (1 << orders) - 1).select("a", "b")


@dataclass
class _Found:
    """What one pass over the documents gives: a profile a row, each document's classes by
    their smallest document, the documents that prefixes came from, the pairs of small groups and
    of hubs, and the members of large groups."""

    own: DataFrame  # id, n, k1, k2
    member: DataFrame  # id, rep
    told: DataFrame  # doc_id, text
    pairs: DataFrame  # a, b, orders
    large: DataFrame  # token, orders, id, n, left


def _find(docs: DataFrame, orders: int) -> _Found:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(profiles(docs))
    frequent = frequent_shingles(found)
    own = found.filter("kind = 0").drop("kind")
    some = own.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = some.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"))
    member = stored(some.join(classes, ["n", "k1", "k2"]).select("id", "rep").distinct())

    # copies of a class need no prefixes of their own
    told = docs.filter(F.col("doc_id").isNotNull())
    named = F.max((F.col("rep") == F.col("id")).cast("int"))
    copies = stored(member.groupBy("id").agg(named.alias("_named")).filter("_named = 0").select("id"))
    told = told.join(few(copies), F.col("doc_id") == F.col("id"), "left_anti")
    tokens = prefixes(told, frequent, orders).repartition("token", "salt").sortWithinPartitions("token", "place", "id")
    grouped = stored(tokens.mapInArrow(_grouped, FOUND))
    large = stored(_with_hubs(grouped.filter(F.col("b").isNull()).select("token", "orders", "place", F.col("a").alias("id"))))
    need = F.floor((4 * (F.col("n") + F.col("hub_n")) + 8) / 9)
    led = large.filter((F.col("id") != F.col("hub")) & (F.least("left", "hub_left") >= need)).select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), "orders"
    )
    pairs = grouped.filter(F.col("b").isNotNull()).select("a", "b", "orders").union(led)
    return _Found(own, member, told, pairs, large.filter("able").select("token", "orders", "id", "n", "left"))


def _by_class(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs of documents as pairs of their classes' smallest documents."""
    one = member.select(F.col("id").alias("a"), F.col("rep").alias("_a"))
    two = member.select(F.col("id").alias("b"), F.col("rep").alias("_b"))
    named = pairs.join(one, "a").join(two, "b").filter(F.col("_a") != F.col("_b"))
    return named.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "orders")


def _met(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pairs of members of one group (token) that their positions allow a link: ``columns`` of
    the one, and of the other with an underscore. A group's members are dealt by salt, and each
    salt meets all members, so a large group is spread over many tasks."""
    sizes = stored(rows.groupBy("token").agg(F.floor(F.count("*") / SALT_ROWS).cast("int").alias("_salts")).filter("_salts > 0"))
    rows = rows.join(few(sizes), "token", "left").withColumn("_salts", F.coalesce("_salts", F.lit(0)))
    one = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("_salts") + 1).cast("int")).drop("_salts")
    two = rows.select(
        "token", *[F.col(c).alias(f"_{c}") for c in columns], F.explode(F.sequence(F.lit(0), "_salts")).alias("salt")
    )
    need = F.floor((4 * (F.col("n") + F.col("_n")) + 8) / 9)
    return one.join(two, ["token", "salt"]).filter(F.least("left", "_left") >= need)


def links(docs: DataFrame, orders: int = ORDERS) -> DataFrame:
    """a, b (a < b) of every link between different sets of ``docs`` (doc_id, text), each
    named by its class's smallest document. A family of near copies gives all its pairs, so
    rows may grow with the square of its different texts; copies add none."""
    return _links(_find(docs, orders), orders)


def _links(found: _Found, orders: int) -> DataFrame:
    named = found.large.join(found.member, "id").groupBy("token", "orders", F.col("rep").alias("id"), "n").agg(F.max("left").alias("left"))
    named = stored(named)
    met = _met(named, ("id", "n", "left")).filter(F.col("id") < F.col("_id"))
    pairs = met.select(F.col("id").alias("a"), F.col("_id").alias("b"), "orders")
    return verified(found.told, stored(_under_all(pairs.union(_by_class(found.pairs, found.member)), orders)))


def link_counts(docs: DataFrame, orders: int = ORDERS) -> DataFrame:
    """doc_id, class_id (the smallest document with an equal set) and n_links (how many other
    documents it links with, copies included): one row for each document, and for each of its
    sets where rows with one doc_id differ. Documents without shingles are a class of their
    own without links; rows without an id are left out. With ``links`` between classes and this
    membership every link between documents is told, in rows that copies do not multiply."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _find(docs, orders)
    between = stored(_links(found, orders))
    size = stored(found.member.groupBy(F.col("rep").alias("class_id")).agg(F.count(F.lit(1)).alias("_size")))
    ends = between.select(F.col("a").alias("class_id"), F.col("b").alias("_other")).union(between.select("b", "a"))
    sizes = size.select(F.col("class_id").alias("_other"), F.col("_size").alias("_more"))
    beyond = ends.join(sizes, "_other").groupBy("class_id").agg(F.sum("_more").alias("_beyond"))
    counted = size.join(beyond, "class_id", "left").select(
        "class_id", (F.col("_size") - 1 + F.coalesce("_beyond", F.lit(0))).alias("n_links")
    )
    named = found.member.select(F.col("id").alias("doc_id"), F.col("rep").alias("class_id")).join(counted, "class_id")
    empty = found.own.filter(F.col("id").isNotNull() & (F.col("n") == 0)).select(F.col("id").alias("doc_id")).distinct()
    alone = empty.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return named.select("doc_id", "class_id", "n_links").union(alone)


def join(docs: DataFrame, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    found = _find(docs, orders)
    own, member, told = found.own, found.member, found.told

    # documents with equal sets are linked without a look at the texts
    same = member.filter(F.col("id") != F.col("rep")).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    near = stored(_under_all(_by_class(found.pairs, member), orders))
    edges = stored(verified(told, near).union(same))
    label = components(edges)

    # what large groups leave open: every pair of members in different components
    placed = found.large.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    kinds = placed.groupBy("token").agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    unsettled = stored(placed.join(kinds.filter("_least < _most").select("token"), "token", "left_semi"))
    if not unsettled.isEmpty():
        columns = ("id", "component", "n", "left")
        met = _met(unsettled.select("token", "orders", *columns), columns).filter(F.col("component") < F.col("_component"))
        pairs = met.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"), "orders")
        # a pair may share its shingles under one order in a large group, under the other in a small one
        pairs = _by_class(pairs.union(found.pairs), member)
        more = stored(_under_all(pairs, orders).join(near, ["a", "b"], "left_anti"))
        if not more.isEmpty():
            edges = stored(edges.union(verified(told, more)))
            label = components(edges)
    ids = label.select(F.col("id").alias("_id"), "component")
    return own.join(ids, F.col("id") == F.col("_id"), "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
