"""SimHash near-duplicates: segment-popcount embedding, grid range join, exact check.

Fingerprint: 64 bits over the word shingles' XXH64 values, repeats included; a bit is 1 if
it is set in more than half of them. Equal fingerprints are one node, so exact copies never
meet again after one pre-aggregated count.

Two fingerprints within ``max_bits`` differ by at most that in Manhattan distance between
their vectors of per-segment bit counts (32 segments of 2 bits): a bit that differs changes
one count by at most one. The segments are put in ``max_bits + 3`` groups; at most
``max_bits`` of them can differ, so some three groups have equal counts. The grid has one
cell per choice of three groups and their counts (for 3 bits: 6 groups, 20 choices, each
fixing 16 counts). Fingerprints that share a cell are checked: Manhattan distance of the
whole vectors first, Hamming distance then.

A cell over ``block`` fingerprints is cut into blocks by hash and checked pair of blocks by
pair of blocks, so no task holds more than two blocks of it; nothing is dropped. A pair of
blocks sends on a forest of its links (each fingerprint to the smallest of its class there),
not its pairs. Classes are joined by large-star and small-star steps on tables of links,
with a reliable checkpoint at each step.

Defined cases: null text is empty; a text without words has fingerprint 0 and is linked like
any other; fewer words than a shingle make one shingle of all of them; repeated rows keep
their own rows; a null id gets the class's smallest id (null if all are null); other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import arrow as A
from snaptally.llm import base as B
from snaptally.session import shared_dir

SEED = 42
SEGMENT_BITS = 2
PAIR_LOW = np.uint64(0x5555555555555555)


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    words = raw.lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    n = max(len(words) - shingle + 1, 1)
    v = np.array([h(b" ".join(words[i:i + shingle]), SEED) for i in range(n)], dtype="<u8")
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65_536):  # bounded memory for huge texts
        bits += np.unpackbits(v[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits((2 * bits > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id, text_hash, fp (the 64 bits as a signed long)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    at = T.StructType([*d.schema.fields[:1], T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])
    d = d.withColumn("text_hash", F.xxhash64(B.text_of("text")))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in A.texts(b, "text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp)], names=["id", "text_hash", "fp"])
    return d.mapInArrow(run, at)


def cells(fps: DataFrame, max_bits: int) -> DataFrame:
    """key, fp: the grid cells of each fingerprint.

    A group's segments are neighbours; the counts of all segments are two bits wide, so
    the counts of a choice of groups are the masked word of counts."""
    x = F.col("fp")
    low = F.lit(int(PAIR_LOW))
    # bit counts of the 2-bit segments, side by side in one word
    a, b = x.bitwiseAND(low), F.shiftrightunsigned(x, 1).bitwiseAND(low)
    counts = a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))
    n_groups, n_segments = max_bits + 3, 64 // SEGMENT_BITS
    edges = [round(i * n_segments / n_groups) for i in range(n_groups + 1)]
    masks = []
    for chosen in combinations(range(n_groups), 3):
        m = 0
        for g in chosen:
            for s in range(edges[g], edges[g + 1]):
                m |= 3 << (SEGMENT_BITS * s)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    each = F.array(*[F.xxhash64(F.lit(i), F.col("counts").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])
    return fps.withColumn("counts", counts).select("fp", F.explode(each).alias("key"))


def segment_counts(v: np.ndarray) -> np.ndarray:
    """The embedding: bit counts of the 32 two-bit segments, one row per fingerprint."""
    pairs = (v & PAIR_LOW) + ((v >> np.uint64(1)) & PAIR_LOW)
    shifts = np.arange(0, 64, SEGMENT_BITS, dtype=np.uint64)
    return ((pairs[:, None] >> shifts) & np.uint64(3)).astype(np.int8)


def links(v: np.ndarray, max_bits: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of fingerprints within ``max_bits``: Manhattan bound, then exact."""
    n, e = len(v), segment_counts(v)
    total = e.sum(axis=1, dtype=np.int32)
    left, right = [], []
    for at in range(0, n, rows):
        # the coarsest segment (all 64 bits) first, then all segments of what is left, then the bits
        near = np.abs(total[at:at + rows, None] - total[None, :]) <= max_bits
        i, j = np.nonzero(near & (np.arange(n)[None, :] > np.arange(at, min(at + rows, n))[:, None]))
        i += at
        for k in range(0, len(i), 1 << 18):
            a, z = i[k:k + (1 << 18)], j[k:k + (1 << 18)]
            ok = np.abs(e[a] - e[z]).sum(axis=1, dtype=np.int32) <= max_bits
            a, z = a[ok], z[ok]
            ok = np.bitwise_count(v[a] ^ v[z]) <= max_bits
            left.append(a[ok])
            right.append(z[ok])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(v: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest fingerprint of its class) for the linked fingerprints of v."""
    i, j = links(v, max_bits)
    if not len(i):
        return []
    label = np.arange(len(v))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(v)))
    return [(int(a), int(b)) for a, b in zip(v[moved].view(np.int64), v[label[moved]].view(np.int64), strict=True)]


def linked(fps: DataFrame, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """a, b: links between different fingerprints whose classes are those of all links."""
    grid = cells(fps, max_bits)
    full = grid.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    full = full.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    at = F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("blocks")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, "at").alias("lo"), F.greatest(o, "at").alias("hi")))
    dealt = (grid.join(full, "key").withColumn("at", at)
             .select("key", "fp", F.explode(both).alias("p")).select("key", "fp", "p.lo", "p.hi"))
    pairs = dealt.groupBy("key", "lo", "hi").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches):
        for b in batches:
            col = b.column(0)
            flat, ends = col.flatten().to_numpy(zero_copy_only=False), np.asarray(col.offsets)
            ends = ends - ends[0]
            flat = flat.view(np.uint64)
            out: list[tuple[int, int]] = []
            sizes = np.diff(ends)
            two = np.flatnonzero(sizes == 2)  # most cells: all at once
            if len(two):
                x, y = flat[ends[two]], flat[ends[two] + 1]
                ok = np.abs(segment_counts(x) - segment_counts(y)).sum(axis=1, dtype=np.int32) <= max_bits
                ok &= np.bitwise_count(x ^ y) <= max_bits
                out += zip(x[ok].view(np.int64).tolist(), y[ok].view(np.int64).tolist(), strict=True)
            for k in np.flatnonzero(sizes > 2):
                out += forest(np.sort(flat[ends[k]:ends[k + 1]]), max_bits)
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["a", "b"], dtype="int64"))
    return pairs.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node of its class) for every node of the links.

    Alternates large-star and small-star (Kiveris et al.) until the links are stars.
    Neighbour minima are aggregates and are joined back, so a node with very many
    links is split like any skewed join key."""
    shared_dir(edges.sparkSession)  # sets the checkpoint folder
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct().checkpoint()

    def star(pairs, larger: bool):
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        j = pairs.join(low, "u")
        new = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if larger else \
            j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return new.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        new = star(star(both, True), False).checkpoint()
        # stars stay as they are under both steps
        a_, b_ = (x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (e, new))
        e = new
        if tuple(a_) == tuple(b_):
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """id, text_hash, fp, component_id (the smallest id reachable), class (any member's fingerprint root)."""
    d = B.materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = B.materialise(d.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    found = components(linked(nodes.select("fp"), max_bits))
    at = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("class"))
    ids = at.groupBy("class").agg(F.min("least").alias("component_id"))
    at = at.select("fp", "class").join(ids, "class")
    return d.join(at, "fp").select("id", "text_hash", "fp", "component_id", "class")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One document of each class: its smallest id (repeated rows of one document once)."""
    found = near_duplicates(docs, id_col, text_col, **params)
    best = found.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k"))
    best = best.select("k.id", "k.text_hash")
    d = docs.withColumn("__h", F.xxhash64(B.text_of(text_col)))
    on = d[id_col].eqNullSafe(best["id"]) & (d["__h"] == best["text_hash"])
    return d.join(best, on, "left_semi").dropDuplicates([id_col, "__h"]).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from near_duplicates()."""
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
