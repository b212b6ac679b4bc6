"""Spelling variant groups: words one edit apart, found in frequency-vector tries.

A word's vector counts its letters in ``GROUPS`` groups (code point modulo ``GROUPS``). One
inserted letter adds one to a group, one deleted takes one away, one replaced does either
both or neither, so words one edit apart differ by a surplus and a deficit of one each at
most. A trie holds the words by the counts of one group after another, the groups that
split the vocabulary most evenly first.

Spark cuts the trie at nodes of ``NODE`` words at most: group after group it counts the words
below the open nodes, and only larger nodes are opened further; one that stays large at full
depth (words of equal counts) is dealt over salts. Each word goes to its own node, and as a
visitor along the cut trie, within the budget, to the nodes behind it in node order; a pair
meets once, in the later node. There the pairs of trie nodes are searched depth first: a stack
holds blocks of node pairs with what is left of their budget, each is opened by one group, and
pairs that overspend go. Pairs that have come down to single words are compared over the
rest of their vectors, and what is left is verified letter by letter.

Cases: null texts have no words; a null doc_id counts as an empty one in the deletion rule;
repeated rows count again; an empty table gives no rows; extra columns are not read. Words of
any length are exact: those beyond ``WIDE`` letters are verified one by one. Counts run per task
before they are shuffled, so a word that makes up a third of a corpus is a row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.session import stored

# The runs that count as words, and the letters that are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETE_EVERY = 97
SHORTEST = 5
OCCURRENCES = 3

GROUPS = 26
NODE = 1 << 15
BLOCK = 1 << 16
WIDE = 32
MOST = 200  # a count in a path; larger ones count as this


# ---- words ---------------------------------------------------------------------------

def counted_words(docs: DataFrame, least: int = OCCURRENCES, shortest: int = SHORTEST) -> DataFrame:
    """word and n: the runs of whole texts with A-Z lower-cased, a letter deleted where the
    hash of document and run says so."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("_run"),
    )
    # a shorter run cannot give a word
    long_enough = runs.select("_id", F.translate("_run", UPPER, LOWER).alias("_run")).filter(F.length("_run") >= shortest)
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    hashed = long_enough.select("_run", h.alias("_h"), F.length("_run").alias("_size"))
    at = F.pmod("_h", "_size").cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.col("_size")))
    word = F.when(F.pmod("_h", F.lit(DELETE_EVERY)) == 0, cut).otherwise(F.col("_run"))
    words = hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.filter((F.col("n") >= least) & (F.length("word") >= shortest))


# ---- vectors and paths ----------------------------------------------------------------

def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row, and where each word starts (one more at the end)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


def vectors(points: np.ndarray, first: np.ndarray, order: list[int]) -> np.ndarray:
    """Letter counts per group, one row a word; column i holds group ``order[i]``."""
    place = np.empty(GROUPS, np.int64)
    place[order] = np.arange(GROUPS)
    n = len(first) - 1
    word = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(word * GROUPS + place[points % GROUPS], minlength=n * GROUPS)
    return counts.astype(np.int32).reshape(n, GROUPS)


def _even_order(words: DataFrame) -> list[int]:
    """The groups, those first that about half of the words have. One number a group is read."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = vectors(*letters(batch.column("word").to_pylist()), list(range(GROUPS)))
            yield pa.record_batch({"group": np.arange(GROUPS), "having": (v > 0).sum(0), "words": np.full(GROUPS, len(v))})

    shares = words.select("word").mapInArrow(task, "group long, having long, words long").groupBy("group").agg(
        (F.sum("having") / F.sum("words")).alias("share")
    )
    return [r.group for r in sorted(shares.collect(), key=lambda r: (abs(r.share - 0.5), r.group))]


def _with_paths(words: DataFrame, order: list[int]) -> DataFrame:
    """word, n, path: the counts down the trie, one character each."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.minimum(vectors(*letters(batch.column("word").to_pylist()), order), MOST)
            text = (v + ord("0")).astype("<u4").tobytes().decode("utf-32-le")
            paths = [text[i:i + GROUPS] for i in range(0, len(text), GROUPS)]
            yield pa.record_batch({"word": batch.column("word"), "n": batch.column("n"), "path": pa.array(paths, pa.string())})

    return words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(task, "word string, n long, path string")


# ---- cutting the trie over tasks --------------------------------------------------------

def _prefix(depth: int) -> Column:
    return F.substring("path", 1, depth)


def _cut(paths: DataFrame, most: int) -> list[DataFrame]:
    """For each depth from the root on, the nodes below the open ones of the depth before:
    node and size. Nodes of more than ``most`` words are open."""
    levels = [stored(paths.agg(F.count(F.lit(1)).alias("size")).select(F.lit("").alias("node"), "size"))]
    for depth in range(1, GROUPS + 1):
        opened = levels[-1].filter(F.col("size") > most)
        if opened.isEmpty():
            break
        below = paths.select(_prefix(depth - 1).alias("node"), _prefix(depth).alias("_next")).join(opened, "node", "left_semi")
        levels.append(stored(below.groupBy(F.col("_next").alias("node")).agg(F.count(F.lit(1)).alias("size"))))
    return levels


def _visits(paths: DataFrame, levels: list[DataFrame], most: int) -> DataFrame:
    """word, n, node, salt, home: each word at its own node, and at the nodes behind it that
    the budget reaches."""
    at = paths.withColumns({"node": F.lit(""), "surplus": F.lit(1), "deficit": F.lit(1)})
    done = []
    for depth, nodes in enumerate(levels):
        at = at.join(nodes, "node")
        leaf = depth + 1 == len(levels)
        # the last depth has no open nodes, unless it is the full one
        done.append(at if leaf else at.filter(F.col("size") <= most))
        if leaf:
            break
        own = F.ascii(F.substring("path", depth + 1, 1))
        # a node with ``step`` letters more than the word in this group, fewer if negative
        opened = at.filter(F.col("size") > most).drop("size").withColumn("step", F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1)])))
        opened = opened.filter((F.col("step") <= F.col("surplus")) & (-F.col("step") <= F.col("deficit")))
        opened = opened.filter(own + F.col("step") >= ord("0"))
        # nodes are ordered by path: a node before the word's own path is left to the other word
        child = F.concat("node", F.char(own + F.col("step")))
        opened = opened.withColumns({
            "node": child,
            "surplus": F.col("surplus") - F.greatest("step", F.lit(0)),
            "deficit": F.col("deficit") + F.least("step", F.lit(0)),
        }).drop("step")
        at = opened.filter(F.col("node") >= _prefix(depth + 1))
    all_done = done[0]
    for d in done[1:]:
        all_done = all_done.unionByName(d)
    salts = F.ceil(F.col("size") / F.lit(most)).cast("int")
    own_salt = F.pmod(F.xxhash64("word"), salts).cast("int")
    home = F.col("node") == F.substring("path", F.lit(1), F.length("node"))
    first_salt = F.when(home, own_salt).otherwise(F.lit(0))
    dealt = all_done.withColumns({"home_node": home, "own_salt": own_salt, "salt": F.explode(F.sequence(first_salt, salts - 1))})
    return dealt.select("word", "n", "node", "salt", (F.col("home_node") & (F.col("salt") == F.col("own_salt"))).alias("home"))


# ---- the search in one node ---------------------------------------------------------------

class Trie:
    """Sorted vectors; for every depth the first row of each node, the number of its first
    child and the count that leads to it."""

    def __init__(self, v: np.ndarray):
        self.order = np.lexsort(v.T[::-1])
        self.v = v = v[self.order]
        n, width = v.shape
        differs = np.ones((n, width + 1), bool)
        differs[1:, :width] = v[1:] != v[:-1]
        where = differs.argmax(1)  # the first group in which a row differs from the one before
        where[0] = -1
        self.start, self.child, self.count = [], [], []
        for depth in range(width + 1):
            start = np.flatnonzero(where < depth)
            self.count.append(v[start, depth - 1] if depth else np.zeros(1, v.dtype))
            if depth:
                self.child.append(np.searchsorted(start, self.start[-1]))
            self.start.append(np.append(start, n))

    def size(self, depth: int, nodes: np.ndarray) -> np.ndarray:
        return self.start[depth][nodes + 1] - self.start[depth][nodes]


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers first[i] .. first[i] + count[i] - 1, with their i."""
    of = np.repeat(np.arange(len(count)), count)
    ahead = np.cumsum(count) - count
    return first[of] + np.arange(len(of)) - ahead[of], of


def _crossed(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a row of node x[k] and one of node y[k], in blocks; a node starts at a[x]."""
    some, other = a[x + 1] - a[x], b[y + 1] - b[y]
    ends = np.cumsum(some * other)
    k = 0
    while k < len(x):
        done = ends[k - 1] if k else 0
        last = max(k + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        # nodes that are too large for a block give some of their rows at a time
        step = max(1, BLOCK // int(other[k])) if last == k + 1 else int(some[k:last].max())
        for at in range(0, int(some[k:last].max()), step):
            i, of = _spread(a[x[k:last]] + at, np.clip(some[k:last] - at, 0, step))
            j, of = _spread(b[y[k:last]][of], other[k:last][of])
            yield i[of], j
        k = last


def candidates(a: Trie, b: Trie, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of rows of ``a`` and of ``b`` whose vectors keep the budget; with ``same`` (one
    trie) each pair once."""
    width = a.v.shape[1]
    one = np.zeros(1, np.int64)
    stack = [(0, one, one, one + 1, one + 1)]
    while stack:
        depth, x, y, surplus, deficit = stack.pop()
        if len(x) > BLOCK:
            half = len(x) // 2
            stack += [(depth, x[s], y[s], surplus[s], deficit[s]) for s in (slice(half), slice(half, None))]
            continue
        if depth == width:
            for i, j in _crossed(a.start[width], x, b.start[width], y):
                keep = i < j if same else slice(None)
                yield i[keep], j[keep]
            continue
        single = (a.size(depth, x) == 1) & (b.size(depth, y) == 1)
        if single.any():
            i, j = a.start[depth][x[single]], b.start[depth][y[single]]
            gap = a.v[i, depth:] - b.v[j, depth:]
            fits = (np.maximum(gap, 0).sum(1) <= surplus[single]) & (np.maximum(-gap, 0).sum(1) <= deficit[single])
            if same:
                fits &= i < j
            yield i[fits], j[fits]
            x, y, surplus, deficit = (z[~single] for z in (x, y, surplus, deficit))
        if not len(x):
            continue
        nx = a.child[depth][x + 1] - a.child[depth][x]
        x2, of = _spread(a.child[depth][x], nx)
        y, surplus, deficit = y[of], surplus[of], deficit[of]
        ny = b.child[depth][y + 1] - b.child[depth][y]
        y2, of = _spread(b.child[depth][y], ny)
        x2, surplus, deficit = x2[of], surplus[of], deficit[of]
        step = a.count[depth + 1][x2] - b.count[depth + 1][y2]
        fits = (step <= surplus) & (-step <= deficit)
        if same:
            fits &= x2 <= y2
        step = step[fits]
        stack.append((depth + 1, x2[fits], y2[fits], surplus[fits] - np.maximum(step, 0), deficit[fits] - np.maximum(-step, 0)))


class Letters:
    """Words as code points in rows of WIDE, from the left and from the right."""

    def __init__(self, words: list[str], points: np.ndarray, first: np.ndarray):
        self.words = words
        self.size = np.diff(first)
        n = len(words)
        self.left = np.zeros((n, WIDE), np.uint32)
        self.right = np.zeros((n, WIDE), np.uint32)
        row = np.repeat(np.arange(n), self.size)
        at = np.arange(len(points)) - first[:-1][row]
        back = self.size[row] - 1 - at
        self.left[row[at < WIDE], at[at < WIDE]] = points[at < WIDE]
        self.right[row[back < WIDE], back[back < WIDE]] = points[back < WIDE]


def near(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one inserted, deleted or replaced code point: apart from
    it they share all letters before and after."""
    small = np.minimum(a.size[i], b.size[j])
    gap = np.abs(a.size[i] - b.size[j])
    padded = np.zeros((len(i), 1), bool)
    head = np.argmin(np.concatenate([a.left[i] == b.left[j], padded], 1), 1)
    tail = np.argmin(np.concatenate([a.right[i] == b.right[j], padded], 1), 1)
    head, tail = np.minimum(head, small), np.minimum(tail, small)
    found = np.where(gap == 1, head + tail >= small, (gap == 0) & (head < small) & (head + tail == small - 1))
    for k in np.flatnonzero((np.maximum(a.size[i], b.size[j]) > WIDE) & (gap <= 1)):
        found[k] = one_edit(a.words[i[k]], b.words[j[k]])
    return found


def one_edit(v: str, w: str) -> bool:
    if len(v) > len(w):
        v, w = w, v
    if len(w) - len(v) > 1 or v == w:
        return False
    head = next((k for k in range(len(v)) if v[k] != w[k]), len(v))
    return v[head + 1:] == w[head + 1:] if len(v) == len(w) else v[head:] == w[head + 1:]


FOUND = "word string, n_near long, best_n long, best_word string"


def _search(order: list[int]):
    def node(rows: pa.Table) -> pa.Table:
        home = np.asarray(rows["home"].combine_chunks())
        kinds = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best_word", pa.string())])
        if not home.any():
            return kinds.empty_table()
        words = rows["word"].to_pylist()
        n = np.asarray(rows["n"].combine_chunks())
        # the words in code-point order: numbers then compare as the words do
        ranked = sorted(range(len(words)), key=words.__getitem__)
        words, n, home = [words[k] for k in ranked], n[ranked], home[ranked]
        points, first = letters(words)
        v = vectors(points, first, order)
        every = Letters(words, points, first)
        at_home, visiting = np.flatnonzero(home), np.flatnonzero(~home)
        own = Trie(v[at_home])
        count = np.zeros(len(words), np.int64)
        best = np.full(len(words), -1, np.int64)
        # larger n first, then the smaller word
        merit = np.empty(len(words), np.int64)
        merit[np.lexsort((-np.arange(len(words)), n))] = np.arange(len(words))
        by_merit = np.argsort(merit)

        def take(i: np.ndarray, j: np.ndarray) -> None:
            hit = near(every, i, every, j)
            i, j = i[hit], j[hit]
            for x, y in ((i, j), (j, i)):
                np.add.at(count, x, 1)
                np.maximum.at(best, x, merit[y])

        for i, j in candidates(own, own, same=True):
            take(at_home[own.order[i]], at_home[own.order[j]])
        if len(visiting):
            others = Trie(v[visiting])
            for i, j in candidates(others, own, same=False):
                take(visiting[others.order[i]], at_home[own.order[j]])
        seen = np.flatnonzero(count)
        to = by_merit[best[seen]]
        return pa.table(
            [[words[k] for k in seen], count[seen], n[to], [words[k] for k in to]], schema=kinds
        )

    return node


def nearest(words: DataFrame, most: int = NODE) -> DataFrame:
    """word, n_near, best_n, best_word of the words (word, n) that have near words: their
    number, and the one with the largest n (ties: the smallest word)."""
    order = _even_order(words)
    if not order:
        return words.sparkSession.createDataFrame([], FOUND)
    paths = stored(_with_paths(words, order))
    visits = _visits(paths, _cut(paths, most), most)
    parts = visits.groupBy("node", "salt").applyInArrow(_search(order), FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best_word").alias("w")))
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("_best"))
    return found.select("word", "n_near", (-F.col("_best.m")).alias("best_n"), F.col("_best.w").alias("best_word"))


# ---- forms -----------------------------------------------------------------------------------

def _roots(forms: DataFrame) -> DataFrame:
    """word and root for words with a form (word, form): each round a word takes the place
    that its own place has got to, so chains halve. A form is at least twice as frequent, so
    there are no circles and few rounds."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(at.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                                F.col("_next").isNotNull().alias("_moved")))
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(words: DataFrame, times: int = 2, most: int = NODE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (word, n): the form is the most
    frequent near word if it is ``times`` as frequent."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")))
    joined = words.join(nearest(words, most), "word", "left")
    has_form = F.col("best_n") >= times * F.col("n")
    held = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("best_word")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"),
    ))
    rooted = held.join(_roots(held.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
