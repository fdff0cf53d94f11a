"""Spelling variant grouping: words one edit apart, and the common form of each rare variant.

Words are maximal runs of ``A-Za-z`` and U+00C0-U+00FF, A-Z lower-cased; a deterministic rule
(``EVERY``) makes misspellings by deleting one letter. Words of at least ``min_length`` letters that occur
``min_count`` times are kept. Two words are near if one inserted, deleted or replaced letter turns
one into the other. A word's form is its near word of largest count (ties: the smallest) if that is
``factor`` times its own; its root is where the forms end.

Method: K-d trees over letter-count vectors. One edit changes a word's letter counts by two at
most in L1 (one letter up, one down; an insertion by one). A vector is kept in unary: a bit for "at
least k of this letter" (``LEVELS`` of each a-z, ``MORE_LEVELS`` of each of ``MORE`` groups of the other
letters), so the L1 distance of two vectors is the number of differing bits, and saturated counts and
grouped letters make it smaller, never greater: nothing near is lost. The box of a node is the pair (bits that all its
words have, bits that any has); a query's distance to it is the bits missing from the first and
beyond the second. A node splits at the bit that halves it best, i.e. at "count of a letter >= k".
For each length pair (L, L) and (L, L + 1) a search goes down the tree with all its
queries at once, drops those whose box distance passes the radius (2, or 1 between lengths),
and checks the letter order of what is left by common prefix and suffix.

Spread over tasks: a length of more than ``LEAF`` words has a top tree of that many words a leaf, its splits chosen on
a bounded sample (``SAMPLE`` words a length; the choice changes no result, every word is in a leaf). A word goes to its
own leaf, as a query to the later leaves within reach of its length, and to those of the next length;
a task builds the tree of its leaf and answers. Every pair is met once and counted on both
sides; sums over leaves give the neighbours.

Defined cases: null text has no words; a null id is empty in the rule's key; equal words of
repeated rows all count; ties by code-point order; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptally.llm import base as B

RUN = r"(?<![A-Za-zÀ-ÿ])[A-Za-zÀ-ÿ]{%d,}+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = 31
LEVELS, MORE, MORE_LEVELS = 3, 25, 2  # 26 * 3 + 25 * 2 = 128 bits
WORDS64 = 2  # of a vector
LEAF, SAMPLE, NODE = 32_768, 32_768, 24
CHECKS = 1 << 22  # letters compared at a time
ROUTED = "cell long, home boolean, word string, n long"
FOUND = "word string, n long, near long, best_n long, best string"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
          min_count: int = 2) -> DataFrame:
    """word, n: the kept words. Stored."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(B.text_of(text_col), F.lit(RUN % min_length), F.lit(0))).alias("run"))
    runs = runs.select("id", F.when(F.rlike("run", F.lit("[A-Z]")), F.translate("run", UPPER, LOWER)).otherwise(
        F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))

    def misspelt(run: Column) -> Column:
        at = (h % F.length(run)).cast("int")
        return F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    made = runs.select(F.when(h % EVERY == 0, misspelt(F.col("run"))).otherwise(F.col("run")).alias("word"))
    return B.materialise(made.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
                         .where(F.col("n") >= min_count), "words")


def letters(some: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of letters (one byte each: no letter is beyond U+00FF)."""
    return np.frombuffer("".join(some).encode("latin-1"), np.uint8).reshape(len(some), length)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Unary letter counts of words, as WORDS64 64-bit words each."""
    bits = np.zeros((len(rows), WORDS64 * 64), bool)
    for i in range(26):
        n = (rows == 97 + i).sum(axis=1)
        for k in range(LEVELS):
            bits[:, i * LEVELS + k] = n > k
    group = np.where(rows >= 0xC0, (rows.astype(np.int16) - 0xC0) % MORE, -1)
    if (group >= 0).any():
        for i in range(MORE):
            n = (group == i).sum(axis=1)
            for k in range(MORE_LEVELS):
                bits[:, 26 * LEVELS + i * MORE_LEVELS + k] = n > k
    return np.packbits(bits, axis=1).view(np.uint64)


def _bits(v: np.ndarray) -> np.ndarray:
    return np.unpackbits(v.view(np.uint8), axis=1)


def _split(v: np.ndarray) -> int | None:
    """The bit that halves the vectors best; None if they are all alike."""
    ones = _bits(v).sum(axis=0, dtype=np.int64)
    at = int(np.argmin(np.abs(ones - len(v) / 2)))
    return at if 0 < ones[at] < len(v) else None


def has(v: np.ndarray, bit: int) -> np.ndarray:
    return (v.view(np.uint8)[:, bit // 8] >> (7 - bit % 8)) & 1 == 1


class TopTree:
    """The leaves of one length: a binary tree of bits, leaves numbered from ``first``."""

    def __init__(self, v: np.ndarray, leaves: int, first: int):
        self.first, self.n = first, 0
        self.root = self._grow(v, leaves)

    def _grow(self, v, leaves):
        bit = _split(v) if leaves > 1 and len(v) > 1 else None
        if bit is None:
            self.n += 1
            return self.first + self.n - 1
        on = has(v, bit)
        return bit, self._grow(v[~on], leaves // 2), self._grow(v[on], leaves - leaves // 2)

    def home(self, v: np.ndarray) -> np.ndarray:
        out = np.empty(len(v), np.int64)

        def down(node, at):
            if isinstance(node, tuple):
                on = has(v[at], node[0])
                down(node[1], at[~on])
                down(node[2], at[on])
            else:
                out[at] = node
        down(self.root, np.arange(len(v)))
        return out

    def reached(self, v: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows within the radius of its half-spaces): a bit on the way that differs is a distance of one."""
        def down(node, at, off):
            if not len(at):
                return
            if not isinstance(node, tuple):
                yield node, at
                return
            on = has(v[at], node[0])
            for child, far in ((node[1], on), (node[2], ~on)):
                d = off + far
                near = d <= radius
                yield from down(child, at[near], d[near])
        yield from down(self.root, np.arange(len(v)), np.zeros(len(v), np.int64))


def top_trees(known: DataFrame) -> dict[int, TopTree]:
    """A tree for every length of more than LEAF words (at most one row in LEAF comes to the driver),
    split on about SAMPLE words of it."""
    by = known.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    many = {r.length: r.n for r in by.where(F.col("n") > LEAF).collect()}
    trees, first = {}, 0
    for length, n in sorted(many.items()):
        share = min(1.0, SAMPLE / n)
        some = known.where((F.length("word") == length) & (
            F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))).select("word").collect()
        v = vectors(letters(sorted(r.word for r in some), length)) if some else np.zeros((0, WORDS64), np.uint64)
        trees[length] = TopTree(v, -(-n // LEAF), first)
        first += trees[length].n
    return trees


def cell_of(length: int) -> int:
    """The one cell of a length without a top tree."""
    return -1 - length


def router(trees: dict[int, TopTree]):
    """A mapInArrow function: (word, n) to the leaves it is data or a query of."""
    def run(batches):
        for b in batches:
            word, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            size = np.array([len(w) for w in word])
            for length in np.unique(size).tolist():
                at = np.flatnonzero(size == length)
                own = [word[i] for i in at]
                v = vectors(letters(own, length)) if length in trees or length + 1 in trees else None
                home = trees[length].home(v) if length in trees else np.full(len(at), cell_of(length))
                to = [(home, np.arange(len(at)), True)]
                if length in trees:  # a pair of equal length is met in the later leaf
                    to += [(np.full(len(q), leaf), q, False) for leaf, q0 in trees[length].reached(v, 2)
                           for q in [q0[home[q0] < leaf]]]
                if length + 1 in trees:
                    to += [(np.full(len(q), leaf), q, False) for leaf, q in trees[length + 1].reached(v, 1)]
                else:
                    to.append((np.full(len(at), cell_of(length + 1)), np.arange(len(at)), False))
                cell, rows = np.concatenate([c for c, _, _ in to]), np.concatenate([q for _, q, _ in to])
                is_home = np.concatenate([np.full(len(q), h) for _, q, h in to])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(is_home), pa.array(own, pa.string()).take(pa.array(rows)),
                     pa.array(n[at][rows])], names=["cell", "home", "word", "n"])
    return run


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Row by row: do words of equal length, or of lengths that differ by one, differ by one edit?"""
    n = short.shape[1]
    if n == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    head = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def search(data: np.ndarray, queries: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, data rows) one edit apart. ``data`` and ``queries`` are letter rows of one length each;
    ``same``: the queries are the data, each pair is given once."""
    if not len(data) or not len(queries):
        return
    dv, qv = vectors(data), vectors(queries)
    radius = 2 if data.shape[1] == queries.shape[1] else 1
    count = np.bitwise_count
    room = max(1, CHECKS // data.shape[1])

    def verified(q, d):
        for i in range(0, len(q), room):
            a, b = q[i:i + room], d[i:i + room]
            ok = one_edit(queries[a], data[b])
            if ok.any():
                yield a[ok], b[ok]

    def down(d, q):
        box = dv[d]
        low, high = np.bitwise_and.reduce(box), np.bitwise_or.reduce(box)
        v = qv[q]
        far = (count(v & ~high) + count(low & ~v)).sum(axis=1, dtype=np.int64)
        q = q[far <= radius]
        if not len(q):
            return
        bit = _split(box) if len(d) > NODE else None
        if bit is not None:
            on = has(box, bit)
            yield from down(d[~on], q)
            yield from down(d[on], q)
            return
        step = max(1, room * 8 // len(d))
        for i in range(0, len(q), step):
            v = qv[q[i:i + step]]
            close = np.zeros((len(v), len(d)), np.uint8)
            for k in range(WORDS64):
                close += count(v[:, k, None] ^ box[None, :, k])
            a, b = np.nonzero(close <= radius)
            a, b = q[i + a], d[b]
            if same:
                a, b = a[a < b], b[a < b]
            yield from verified(a, b)
    yield from down(np.arange(len(data)), np.arange(len(queries)))


def answer(cell: pa.Table) -> pa.Table:
    """One leaf: its words and the queries sent to it; near, best_n and best of each, as far as found here."""
    table = cell.sort_by([("word", "ascending")])
    word, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    home, size = table.column("home").to_numpy(zero_copy_only=False), np.array([len(w) for w in word])
    near, best_n, best = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), np.full(len(word), len(word))

    def met(a, b):  # rows are in code-point order, so the smaller row is the smaller word
        near[:] += np.bincount(a, minlength=len(word))
        order = np.lexsort((b, -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        a, b = a[first], b[first]
        better = (n[b] > best_n[a]) | ((n[b] == best_n[a]) & (b < best[a]))
        best_n[a[better]], best[a[better]] = n[b[better]], b[better]
    data = np.flatnonzero(home)
    if len(data):
        length = int(size[data[0]])
        rows = letters([word[i] for i in data], length)
        for part in (length, length - 1):
            others = np.flatnonzero(~home & (size == part))
            if part == length:
                for a, b in search(rows, rows, True):
                    met(data[a], data[b])
                    met(data[b], data[a])
            if len(others):
                for a, b in search(rows, letters([word[i] for i in others], part), False):
                    met(others[a], data[b])
                    met(data[b], others[a])
    out = np.flatnonzero(home | (near > 0))
    names = pa.array([*word, None], pa.string())
    return pa.table({"word": names.take(pa.array(out)), "n": pa.array(n[out]), "near": pa.array(near[out]),
                     "best_n": pa.array(best_n[out], mask=near[out] == 0), "best": names.take(pa.array(best[out]))})


def neighbours(known: DataFrame) -> DataFrame:
    """word, n, near (number of near words), best_n and best (the near word of largest count)."""
    cells = known.mapInArrow(router(top_trees(known)), ROUTED).groupBy("cell").applyInArrow(answer, FOUND)
    top = F.min(F.when(F.col("near") > 0, F.struct((-F.col("best_n")).alias("n"), "best"))).alias("top")
    return cells.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("near"), top).select(
        "word", "n", "near", (-F.col("top.n")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): every round doubles the way gone, until no word moves.

    Counts grow by ``factor`` at each form, so there is no circle and a few rounds are enough."""
    at = B.materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not on.join(at, "root", "left_semi").take(1):
            return at
        at = B.materialise(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
             min_count: int = 2, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    B.prepare(docs.sparkSession)
    found = neighbours(words(docs, id_col, text_col, min_length, min_count))
    common = F.col("best_n") >= factor * F.col("n")
    found = B.materialise(found.select("word", F.when(common, F.col("best")).alias("form"), "n", F.col("near").alias(
        "n_near"), F.when(common, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                   "n_near", "form_n")
