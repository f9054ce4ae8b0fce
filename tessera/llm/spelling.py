"""Spelling variant grouping (operator 12): a frequency-vector trie.

1. Tasks count the lower-cased letter runs of their documents; counts are summed
   per word before and after the shuffle, so a frequent word is one row a task.
2. A word's vector is its length, then how many of its letters fall into each
   of ``GROUPS`` letter groups.  One inserted, deleted or replaced letter moves
   at most one count up and at most one down.
3. The vectors form a trie, one level per count.  Its top is Spark's
   partitioning: words are stored at the node of their first ``TOP`` counts, and
   every word asks at each node that its budget of one surplus and one deficit
   still reaches (the longer word asks; of equally long ones that with the
   smaller vector).  A node with more than ``NODE_WORDS`` words or
   ``NODE_BYTES`` letters is opened by ``TOP`` more counts, and a full vector
   that is still too big by the words' halves, one of which an edit leaves
   as it is.
4. Below such a node a task searches depth first: it carries all asking words
   that still have budget from count to count and compares whole words at the
   leaves.  Every pair of near words is found exactly once.
5. A word's form is its near word of largest count, if that is ``DOMINANCE``
   times its own; counts rise along forms, so pointer doubling finds the last
   one in about log2(log10(largest count)) joins.

Letters are ``A-Z a-z`` and U+00C0 to U+00FF, all of which are one byte of
Latin-1; only A-Z are lower-cased.

Defined results: null or letterless text has no words; a null doc_id counts as
empty text in the drop rule; repeated rows count again; ties of the form go to
the smallest word in code-point order; very long texts are read in pieces that
end between runs; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package

MIN_LETTERS = 7
MIN_COUNT = 2
DROP_ONE_IN = 31
DOMINANCE = 10
GROUPS = 13
TOP = 3
NODE_WORDS = 20_000
NODE_BYTES = 16 << 20
#: Stored times asking words up to which a trie node is compared at once.
BUNDLE = 1 << 17
_PIECE = 1 << 20
_HELD = 200_000
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_GROUP = (np.arange(256) - 97) % GROUPS
_CLAMP = 4095  # a count in a node's number; larger ones share a node


def _pieces(text: str):
    """The text in pieces that end between letter runs."""
    at = 0
    while len(text) - at > _PIECE:
        found = _BREAK.search(text, at + _PIECE)
        if found is None:
            break
        yield text[at: found.start()]
        at = found.start()
    yield text[at:] if at else text


def _count_task(batches):
    counts: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for key, text in zip(batch.column("key"), batch.column("text")):
            prefix = zlib.crc32(key.as_py().encode() + b":")
            # bytes.lower() touches A-Z alone
            for piece in _pieces(text.as_py()):
                for run, n in Counter(_RUN.findall(piece.encode().lower().decode())).items():
                    h = zlib.crc32(run.encode(), prefix)
                    if h % DROP_ONE_IN == 0:
                        k = h % len(run)
                        run = run[:k] + run[k + 1:]
                        if len(run) < MIN_LETTERS:
                            continue
                    counts[run] += n
            if len(counts) > _HELD:
                yield rows()
    if counts:
        yield rows()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_COUNT) -> DataFrame:
    """(word, n): all words of at least ``least`` occurrences."""
    ship_package(docs.sparkSession)
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_count_task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


class Words:
    """Words as Latin-1 bytes: word r is ``flat[offsets[r]:offsets[r + 1]]``."""

    def __init__(self, words: list[str]):
        self.flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])

    def vectors(self) -> np.ndarray:
        """Length, then the letters of each group, per word."""
        n = len(self.lengths)
        cell = np.repeat(np.arange(n) * GROUPS, self.lengths) + _GROUP[self.flat]
        counts = np.bincount(cell, minlength=n * GROUPS).reshape(n, GROUPS)
        return np.concatenate([self.lengths[:, None], counts], axis=1)

    def odd(self) -> np.ndarray:
        """Per word, the letters (as bits) that it holds an odd number of times."""
        n = len(self.lengths)
        cell = np.repeat(np.arange(n) * 64, self.lengths) + (self.flat & 63)
        bits = (np.bincount(cell, minlength=n * 64) & 1).astype(np.uint8).reshape(n, 64)
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """The given words, all of one length, one a row."""
        return self.flat[self.offsets[rows][:, None] + np.arange(self.lengths[rows[0]])]

    def half(self, rows: np.ndarray, short: int, left: bool) -> np.ndarray:
        """Hash of the half of words that pairs with shorter length ``short`` share."""
        h = short // 2
        at = self.offsets[rows] if left else self.offsets[rows + 1] - (short - h)
        size = h if left else short - h
        out = np.full(len(rows), 1469598103934665603, np.uint64)
        for i in range(size):
            out = (out ^ self.flat[at + i].astype(np.uint64)) * np.uint64(1099511628211)
            out ^= out >> np.uint64(29)
        return out


def _node_numbers(counts: np.ndarray, depth: int) -> np.ndarray:
    """One number for the first ``depth`` counts of each row (hash beyond five)."""
    out = np.zeros(len(counts), np.uint64)
    for i in range(depth):
        out = out * np.uint64(4096 if depth <= 5 else 0x9E3779B97F4A7C15) + np.minimum(counts[:, i], _CLAMP).astype(np.uint64)
        if depth > 5:
            out ^= out >> np.uint64(31)
    return out.view(np.int64)


def _moves(depth: int):
    """(letters less, (count, change) ...): what the shorter or later word's first
    counts may differ in, seen from the asking word."""
    yield 1, ()
    yield 0, ()
    for i in range(depth):
        yield 1, ((i, -1),)
        yield 0, ((i, 1),)
        for j in range(i + 1, depth):
            yield 0, ((i, 1), (j, -1))


def _route_task(depth: int, parent: int = 0, halves: bool = False, asking: bool = True):
    """Rows (length, node, parent, side, asks, word, n): every word where it is
    stored (asks = 0) and, unless left out, wherever it asks (asks = 1)."""
    names = [part.split()[0] for part in _ROUTED.split(", ")]

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 8192):
                batch = whole.slice(i, 8192)
                words = Words(batch.column("word").to_pylist())
                vectors = words.vectors()
                every = np.arange(batch.num_rows)

                def rows(at, less, counts, asks):
                    length = words.lengths[at] - less
                    node, above = _node_numbers(counts, depth), _node_numbers(counts, parent)
                    sides = [np.zeros(len(at), np.int64)]
                    nodes = [node]
                    if halves:
                        sides, nodes = [], []
                        for side in (1, 2):
                            key = np.zeros(len(at), np.uint64)
                            for short in np.unique(length):
                                some = np.flatnonzero(length == short)
                                key[some] = words.half(at[some], int(short), side == 1)
                            sides.append(np.full(len(at), side))
                            nodes.append((key ^ (node.view(np.uint64) * np.uint64(31))).view(np.int64))
                    for side, numbers in zip(sides, nodes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(length), pa.array(numbers), pa.array(above), pa.array(side.astype(np.int32)),
                             pa.array(np.full(len(at), asks, np.int32)),
                             batch.column("word").take(pa.array(at)), batch.column("n").take(pa.array(at))], names=names)

                yield from rows(every, 0, vectors[:, 1:], 0)
                for less, changes in _moves(depth) if asking else ():
                    counts = vectors[:, 1:].copy()
                    for level, change in changes:
                        counts[:, level] += change
                    at = np.flatnonzero((counts >= 0).all(axis=1) & (words.lengths - less >= 1))
                    if len(at):
                        yield from rows(at, less, counts[at], 1)

    return run


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` become those of ``b`` by one deletion (one column
    more) or one replacement (as many columns)."""
    n = b.shape[1]
    if a.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    same = np.logical_and.accumulate(a[:, :n] == b, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return same + back >= n


def _candidates(stored: np.ndarray, asking: np.ndarray, stored_odd: np.ndarray, asking_odd: np.ndarray):
    """Depth-first search: (asking rows, stored rows) of pairs that keep the
    budget on the way to a leaf, or to a node small enough to be compared at
    once, where at most two letters' parities may differ.  ``stored`` is sorted."""
    width = stored.shape[1]
    stack = []
    values, starts = np.unique(stored[:, 0], return_index=True)
    ends = np.append(starts[1:], len(stored))
    for value, lo, hi in zip(values, starts, ends):
        for less in (0, 1):
            alive = np.flatnonzero(asking[:, 0] - value == less)
            if len(alive):
                zero = np.zeros(len(alive), np.int8)
                # a surplus may be spent once; a deficit only if lengths are equal, and first
                stack.append((lo, hi, 1, less, alive, zero, zero))
    while stack:
        lo, hi, level, less, alive, surplus, deficit = stack.pop()
        if level < width and (hi - lo) * len(alive) > BUNDLE:
            values, starts = np.unique(stored[lo:hi, level], return_index=True)
            ends = np.append(starts[1:], hi - lo)
            want = asking[alive, level]
            for value, a, b in zip(values, starts, ends):
                change = want - value
                up, down = change == 1, change == -1
                free = (surplus == 0) & (deficit == 1 - less)
                ok = (change == 0) | (up & free)
                if not less:
                    ok |= down & (deficit == 0)
                if ok.any():
                    stack.append((lo + a, lo + b, level + 1, less, alive[ok], surplus[ok] + up[ok], deficit[ok] + down[ok]))
            continue
        step = max(1, BUNDLE // (hi - lo))
        for i in range(0, len(alive), step):
            part = alive[i: i + step]
            differ = np.bitwise_count(asking_odd[part, None] ^ stored_odd[None, lo:hi])
            q, s = np.nonzero(differ <= 2)
            yield part[q], lo + s


def near_in_node(stored: list[str], asking: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
    """(asking, stored) positions of all near pairs of one node."""
    one, two = Words(asking), Words(stored)
    vectors = two.vectors()
    order = np.lexsort(vectors.T[::-1])
    sorted_vectors, asking_vectors = vectors[order], one.vectors()
    out: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def verify():
        q, s = (np.concatenate(x) for x in zip(*held))
        held.clear()
        sizes = one.lengths[q] * 2 + two.lengths[s] - one.lengths[q]
        for size in np.unique(sizes):
            some = np.flatnonzero(sizes == size)
            step = max(1, (1 << 22) // int(size))
            for i in range(0, len(some), step):
                x, y = q[some[i: i + step]], s[some[i: i + step]]
                a, b = one.matrix(x), two.matrix(y)
                near = one_edit(a, b)
                if a.shape[1] == b.shape[1]:
                    # both words ask: the pair counts where the stored one's vector,
                    # then its letter, is the greater one
                    first = (np.arange(len(x)), np.argmax(a != b, axis=1))
                    mine, its = a[first], b[first]
                    near &= (_GROUP[its] < _GROUP[mine]) | ((_GROUP[its] == _GROUP[mine]) & (mine < its))
                if side == 2:  # pairs with equal left halves come from side 1
                    h = b.shape[1] // 2
                    near &= (a[:, :h] != b[:, :h]).any(axis=1)
                out.append((x[near], y[near]))

    size = 0
    for q, s in _candidates(sorted_vectors, asking_vectors, two.odd()[order], one.odd()):
        held.append((q, order[s]))
        size += len(q)
        if size > 1 << 16:
            verify()
            size = 0
    if held:
        verify()
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def _search_task(batches):
    """Nodes come one after another, stored words first."""
    node, held = None, []

    def pairs():
        rows = pa.Table.from_batches(held)
        first = int(np.searchsorted(rows.column("asks").to_numpy(), 1))
        if first in (0, rows.num_rows):
            return
        word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        stored = word.slice(0, first).to_pylist()
        for i in range(first, rows.num_rows, 1 << 16):
            q, s = near_in_node(stored, word.slice(i, 1 << 16).to_pylist(), node[2])
            if len(q):
                q, s = pa.array(q + i), pa.array(s)
                yield pa.RecordBatch.from_arrays([word.take(q), n.take(q), word.take(s), n.take(s)],
                                                 names=["word", "n", "near", "near_n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in _KEY])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if node is not None and node != tuple(key[:, lo]):
                yield from pairs()
                held = []
            node = tuple(key[:, lo])
            held.append(batch.slice(lo, hi - lo).select(["asks", "word", "n"]))
    if held:
        yield from pairs()


_KEY = ["length", "node", "side"]
_ROUTED = "length bigint, node bigint, parent bigint, side int, asks int, word string, n bigint"


def near_pairs(words: DataFrame, top: int = TOP, node_words: int = NODE_WORDS, node_bytes: int = NODE_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, once."""
    ship_package(words.sparkSession)
    above, depth, parent, halves, found = None, top, 0, False, []
    while True:
        def routed(asking: bool) -> DataFrame:
            rows = words.mapInArrow(_route_task(depth, parent, halves, asking), _ROUTED)
            return rows if above is None else rows.join(above, ["length", "parent"], "left_semi").select(*rows.columns)

        rows, big = routed(True), None
        if not halves:
            size = routed(False).groupBy("length", "node").agg(
                F.count(F.lit(1)).alias("size"), F.sum(F.length("word")).alias("letters"))
            big = land(size.where((F.col("size") > node_words) | (F.col("letters") > node_bytes)).select("length", "node"),
                       "big-nodes")
            big = None if big.isEmpty() else big
        here = rows if big is None else rows.join(big, ["length", "node"], "left_anti")
        dealt = here.select(*_KEY, "asks", "word", "n").repartition(*_KEY).sortWithinPartitions(*_KEY, "asks")
        found.append(dealt.mapInArrow(_search_task, "word string, n bigint, near string, near_n bigint"))
        if big is None:
            return reduce(DataFrame.union, found)
        # only the words that a big node stores or is asked by go on
        words = land(rows.join(big, ["length", "node"], "left_semi").select("word", "n").distinct(), "big-node-words")
        above = big.withColumnRenamed("node", "parent")
        halves, parent, depth = depth >= GROUPS, depth, min(depth + top, GROUPS)


def forms(words: DataFrame, pairs: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """Per word: n, n_near, form and form_n (null where no near word is
    ``dominance`` times as frequent)."""
    none = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                        F.col("n").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("best")
    found = none.union(pairs.select("word", "n", "near", "near_n")).union(back).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    takes = -F.col("best.less") >= dominance * F.col("n")
    return found.select("word", "n", "n_near", F.when(takes, F.col("best.near")).alias("form"),
                        F.when(takes, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of their forms."""
    hops = land(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = land(hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("moved")), "roots")
        if longer.where("moved").isEmpty():
            return hops
        hops = longer.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs``."""
    words = land(word_counts(docs, id_col, text_col), "words")
    formed = land(forms(words, near_pairs(words)), "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
