"""Benchmark decontamination: size-partitioned MinHash containment search, exact check.

A document is contaminated by an item if it holds at least ``threshold`` of the item's
different ``shingle``-word shingles. Items are short and documents long, so the search is for
containment and not for similarity, with sketches by item size:

Items are partitioned into size classes (powers of two of the number of shingles). An item
of n shingles may miss at most floor((1 - threshold) n) of them in a contaminated document,
so any floor((1 - threshold) n) + 1 of its shingles include one that the document holds.
The sketch of an item is that many of its smallest MinHash values (the number of its class's
upper size, at most n): a document without any sketch value cannot hold the item, whatever
the document's length, and no contaminated document is missed. Documents are searched through
all their shingle hashes with a table of the sketch values; only items hit this way are
checked, by counting their very shingles (as text) in the document.

The benchmark is the stated query set. It is taken in blocks of at most ``block_chars``
characters, each broadcast to one pass over the documents, so the broadcast is bounded
whatever the benchmark's size.

Words are parted by ASCII white space, A-Z in lower case. Defined cases: null text is empty; a
text with fewer words than a shingle is one shingle of all its words; an item of fewer words is contained
where its words stand one after another, also in a longer document; an item without words is
in no document; repeated items count each; repeated rows are judged alike; a null item id is
kept; other columns pass through, one named as the result column is replaced; empty tables
give no hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import arrow as A

HIT = ["item_id", "shared", "size"]
FILTER_BITS = 22
MEMO = 300_000


def shingles_of(raw: bytes, k: int) -> set[bytes]:
    words = raw.lower().split()
    if not words:
        return set()
    return {b" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))}


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 1)
        return h


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], dtype=np.uint64)


def shingle_hashes(words: list[bytes], k: int, memo: WordHashes) -> np.ndarray:
    """A 64-bit hash of each shingle (the MinHash order), from the words' hashes."""
    h = np.array([memo[w] for w in words], dtype=np.uint64)
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ (h[i:i + n] * _ODD[i % 5])) * _ODD[(i + 1) % 5]
        out ^= out >> np.uint64(29)
    return out


def sketch_size(n: int, threshold: float) -> int:
    """Sketch values of an item of n shingles: enough for the largest size of its class."""
    upper = 1 << (n - 1).bit_length()
    return min(n, int((1 - threshold) * upper + 1e-9) + 1)


def kind(item_id: T.DataType) -> T.StructType:
    """The type of the result, with item ids as the benchmark has them."""
    hit = T.StructType([T.StructField("item_id", item_id), *[T.StructField(c, T.IntegerType()) for c in HIT[1:]]])
    return T.StructType([T.StructField("hits", T.ArrayType(hit))])


def indexes(items: list[tuple], k: int, threshold: float) -> list[Index]:
    """One index of the items of ``k`` words or more, and one for each smaller number of words present: such an
    item is a single shingle of all its words, looked for among a document's windows of that length."""
    by: dict[int, list] = defaultdict(list)
    for item in items:
        by[min(len(item[1].split()), k)].append(item)
    return [Index(some, n, threshold) for n, some in sorted(by.items()) if n]


class Index:
    """The sketches of a block of items; a task's searcher."""

    def __init__(self, items: list[tuple], k: int, threshold: float):
        self.k, self.threshold = k, threshold
        self.memo = WordHashes()
        self.items: list[tuple] = []  # id, number of shingles
        self.where: dict[bytes, list[int]] = defaultdict(list)  # shingle -> items
        at: dict[int, list[int]] = defaultdict(list)  # sketch value -> items
        for ident, raw in items:
            found = sorted(shingles_of(raw, k))
            if not found:
                continue
            no = len(self.items)
            self.items.append((ident, len(found)))
            values = []
            for s in found:
                self.where[s].append(no)
                values.append(int(shingle_hashes(s.split(), k, self.memo)[0]))
            for v in sorted(values)[:sketch_size(len(found), threshold)]:
                at[v].append(no)
        self.values = np.array(sorted(at), dtype=np.uint64)
        self.owners = [at[int(v)] for v in self.values]
        self.shift = np.uint64(64 - FILTER_BITS)
        self.table = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.table[self.values >> self.shift] = True

    def search(self, raw: bytes) -> list[tuple]:
        """(item id, shared shingles, item's shingles) of the items that the text holds."""
        words = raw.lower().split()
        if not words or not len(self.values):
            return []
        h = shingle_hashes(words, self.k, self.memo)
        h = np.unique(h[self.table[h >> self.shift]])
        if not len(h):
            return []
        place = np.minimum(np.searchsorted(self.values, h), len(self.values) - 1)
        candidates = {no for p in place[self.values[place] == h] for no in self.owners[p]}
        if not candidates:
            return []
        shared: dict[int, int] = defaultdict(int)
        n = max(len(words) - self.k + 1, 1)
        for s in {b" ".join(words[i:i + self.k]) for i in range(n)}:
            for no in self.where.get(s, ()):
                if no in candidates:
                    shared[no] += 1
        return [(*self.items[no][:1], c, self.items[no][1]) for no, c in sorted(shared.items())
                if c >= self.threshold * self.items[no][1] - 1e-9]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks, one in the driver at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col), F.col(text_col).cast("string")).toLocalIterator():
        raw = (r[1] or "").encode()
        if block and size + len(raw) > block_chars:
            yield block
            block, size = [], 0
        block.append((r[0], raw))
        size += len(raw)
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "contamination",
                       item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5,
                       threshold: float = 0.8, block_chars: int = 8_000_000) -> DataFrame:
    """docs with ``out``: struct<hits: array<struct<item_id, shared, size>>> by item id."""
    sc = docs.sparkSession.sparkContext
    form = kind(benchmark.schema[item_id_col].dataType)
    none = F.struct(F.array().cast(form["hits"].dataType).alias("hits"))
    d = docs.withColumn(out, none)
    for n, block in enumerate(blocks(benchmark, item_id_col, item_text_col, block_chars)):
        sent = sc.broadcast(block)
        d = A.with_result(d, text_col, f"{out}__{n}", form, _searcher(sent, shingle, threshold))
        d = d.withColumn(out, F.struct(F.concat(f"{out}.hits", f"{out}__{n}.hits").alias("hits"))).drop(f"{out}__{n}")
    return d.withColumn(out, F.struct(F.array_sort(f"{out}.hits").alias("hits")))


def _searcher(sent, shingle: int, threshold: float):
    made: list[list[Index]] = []

    def per_text(texts):
        if not made:
            made.append(indexes(sent.value, shingle, threshold))
        return [{"hits": [dict(zip(HIT, h, strict=True)) for index in made[0] for h in index.search(raw)]} for raw in texts]
    return per_text


def keep_clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    return find_contamination(docs, benchmark, out="__found", **params).where(
        F.size("__found.hits") == 0).select(*docs.columns)


def digest(found: DataFrame, id_col: str = "doc_id", out: str = "contamination") -> DataFrame:
    """One row per document: its items (ids, comma-joined) and the greatest containment."""
    hits = F.col(f"{out}.hits")
    return found.select(
        F.col(id_col).alias("doc_id"), (F.size(hits) > 0).alias("contaminated"), F.size(hits).cast("long").alias("n_items"),
        F.array_join(F.transform(hits, lambda h: h["item_id"].cast("string")), ",").alias("item_ids"),
        F.coalesce(F.array_max(F.transform(hits, lambda h: h["shared"] / h["size"])), F.lit(0.0)).alias("containment"))


# The same rule by plain joins: every document shingle against every item shingle.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
           FROM documents),
b AS (SELECT item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
      FROM benchmark),
ds AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest([array_to_string(w[i:i + 4], ' ')
       for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS s FROM d WHERE len(w) > 0
       UNION ALL SELECT doc_id, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)])
       FROM d JOIN (SELECT DISTINCT len(w) AS m FROM b WHERE len(w) BETWEEN 1 AND 4) ON len(w) >= m)),
bs AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest([array_to_string(w[i:i + 4], ' ')
       for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS s FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS size FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id),
ok AS (SELECT doc_id, item_id, shared::DOUBLE / size AS c FROM hit JOIN n USING (item_id) WHERE shared * 5 >= size * 4),
per AS (SELECT doc_id, count(*) AS k, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS ids, max(c) AS c
        FROM ok GROUP BY doc_id)
SELECT doc_id, k IS NOT NULL AS contaminated, coalesce(k, 0)::BIGINT AS n_items, coalesce(ids, '') AS item_ids,
       coalesce(c, 0.0)::DOUBLE AS containment FROM documents LEFT JOIN per USING (doc_id)
"""
