"""Source divergence audit: how far each source's word use is from its language's other sources.

Terms are runs of ASCII letters and of characters beyond ASCII, only A-Z lower-cased. A language
keeps the V terms that at least ``min_docs`` of its documents hold. Every (language, source) group
and every language gives a kept term of count c the weight p = 1 + floor(10^9 (c + 1) / (N + V)),
and two weights differ by f(p, q) = floor((p - q)^2 / q): all integers, so results are exact and the
same in any order. ``pair`` sums f over all kept terms for each two sources of a language; ``term``
gives each group's most over-used terms against the language.

Method: f depends on a term only through its count levels in the two groups. So a block of kept
terms becomes a one-hot matrix X with a row for each (group, level) and a column for each term,
and X times its transpose counts, for all groups at once, the terms at each two levels: every joint
table of two sources, and on the diagonal every level's number of terms. Blocks are of ``BLOCK`` terms
of alike frequency and products of ``TILE`` rows, in float32, exact as no sum passes 2^24. Level 0 needs no
row: with z the weight of level 0,

    sum f(p, q) = sum over joint of f(p, q) - f(p, zq) - f(zp, q) + f(zp, zq)
                  + sum over own levels of f(p, zq) - f(zp, zq)
                  + sum over the other's levels of f(zp, q) - f(zp, zq) + V f(zp, zq)

so a joint table costs its non-empty cells, not V, and is priced by Spark expressions.

Plan: terms are counted in each task (a bounded table, given out when full), then summed by
(language, source, term), then gathered by (language, term), one entry a source. The joint
tables are summed over blocks with partial aggregates. A group with a third of all documents is
spread by its terms; of a group's terms each task sends on its ``top`` first ones only (Spark cuts
ranks up to 1,000 below the exchange).

Defined cases: null text, language and source are ''; a group without terms has N = 0 and is
compared all the same; without kept terms (V = 0) every pair has value 0; repeated rows are
separate documents; ids and other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptally.llm import base as B

# every ASCII character that is no letter separates; A-Z become a-z; UTF-8 bytes beyond ASCII stay
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
SLICE = 1 << 20  # bytes of a text that are split at a time
HELD = 400_000  # counts a task holds before it gives them out
BLOCK, TILE, CELLS = 1024, 2048, 1_000_000
SCALE = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"
JOINT = "lang string, s1 string, n1 long, s2 string, n2 long, terms long"


def terms_of(text: bytes):
    """Lists of the terms of a text, slice by slice."""
    plain = text.translate(LETTERS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _rows(counts: dict, docs: dict):
    for (lang, source), own in counts.items():
        held, names = docs[lang, source], list(own)
        for i in range(0, len(names), 65_536):
            some = names[i:i + 65_536]
            yield pa.RecordBatch.from_arrays([
                pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                pa.array(map(own.__getitem__, some), pa.int64()), pa.array(map(held.__getitem__, some), pa.int64())],
                names=["lang", "source", "term", "n", "docs"])


def _count(batches):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for b in batches:
        langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, b.column(2).cast(pa.binary()).to_pylist(), strict=True):
            own, held = counts[lang, source], set()
            for words in terms_of(text):
                own.update(words)
                held.update(words)
            docs[lang, source].update(held)
        if sum(map(len, counts.values())) > HELD:
            yield from _rows(counts, docs)
            counts.clear()
            docs.clear()
    yield from _rows(counts, docs)


def kept_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = 3) -> DataFrame:
    """lang, term, n (in the language), groups: array<struct<source, n>> with n > 0. Stored."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    d = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), B.text_of(text_col).alias("text"))
    counts = d.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"),
                                               F.collect_list(F.struct("source", "n")).alias("groups"))
    return B.materialise(terms.where(F.col("docs") >= min_docs).select("lang", "term", "n", "groups"), "kept-terms")


def group_totals(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, total (N), v (V), lang_total: a row for every occurring group. Stored."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source")).distinct()
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    own = kept.select("lang", F.explode("groups").alias("g")).groupBy("lang", F.col("g.source").alias("source")).agg(
        F.sum("g.n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return B.materialise(groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", zero("total"), zero("v"), zero("lang_total")), "group-totals")


def _product(row: np.ndarray, term: np.ndarray, n_rows: int, n_terms: int):
    """(i, j, terms) with i <= j: the non-empty cells of X X^T, X one-hot with X[row, term] = 1."""
    order = np.argsort(row, kind="stable")
    row, term = row[order], term[order]
    cut = np.searchsorted(row, np.arange(0, n_rows + TILE, TILE))

    def tile(k):
        x = np.zeros((min(TILE, n_rows - k * TILE), n_terms), np.float32)
        at = slice(cut[k], cut[k + 1])
        x[row[at] - k * TILE, term[at]] = 1
        return x
    tiles = range(-(-n_rows // TILE))
    for a in tiles:
        xa = tile(a)
        for b in tiles[a:]:
            p = xa @ (xa if a == b else tile(b)).T
            i, j = np.nonzero(np.triu(p) if a == b else p)
            yield i + a * TILE, j + b * TILE, p[i, j].astype(np.int64)


def _joint(batches):
    ids: dict = {}  # (lang, source, level) -> number in this task
    keys, sums, size = [], [], 0

    def merged():
        k, at = np.unique(np.concatenate(keys), return_inverse=True)
        return k, np.bincount(at, np.concatenate(sums), len(k)).astype(np.int64)

    def out(k, n):
        lang, source, level = (list(x) for x in zip(*ids, strict=True))
        place = {x: i for i, x in enumerate(sorted(set(source)))}
        order = np.array([place[x] for x in source])
        lang, source, level = pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(level, pa.int64())
        for i in range(0, len(k), 65_536):
            a, b = k[i:i + 65_536] >> 32, k[i:i + 65_536] & 0xFFFFFFFF
            a, b = np.where(order[a] <= order[b], a, b), np.where(order[a] <= order[b], b, a)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(a)), source.take(pa.array(a)), level.take(pa.array(a)), source.take(pa.array(b)),
                 level.take(pa.array(b)), pa.array(n[i:i + 65_536], pa.int64())],
                names=["lang", "s1", "n1", "s2", "n2", "terms"])

    def blocks():
        """(lang, [groups of a term, ...]) of at most BLOCK terms of one language."""
        lang, held = None, []
        for b in batches:
            for one, groups in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held and (one != lang or len(held) == BLOCK):
                    yield lang, held
                    held = []
                lang = one
                held.append(groups)
        if held:
            yield lang, held

    for lang, held in blocks():
        known: dict = {}
        row = np.array([known.setdefault((g["source"], g["n"]), len(known)) for t in held for g in t], np.int64)
        term = np.repeat(np.arange(len(held)), [len(t) for t in held])
        number = np.array([ids.setdefault((lang, *x), len(ids)) for x in known], np.int64)
        for i, j, n in _product(row, term, len(known), len(held)):
            a, b = number[i], number[j]
            keys.append(np.minimum(a, b) << 32 | np.maximum(a, b))
            sums.append(n)
            size += len(n)
        if size > CELLS:
            k, n = merged()
            if len(k) > CELLS // 2:
                yield from out(k, n)
                ids, keys, sums, size = {}, [], [], 0
            else:
                keys, sums, size = [k], [n], len(k)
    if keys:
        yield from out(*merged())


def joint_tables(kept: DataFrame) -> DataFrame:
    """lang, s1, n1, s2, n2, terms: the kept terms at level n1 in source s1 and n2 in s2, both over 0
    (s1 < s2); rows with s1 = s2 give the terms at each level of a source. Stored."""
    near = kept.sortWithinPartitions("lang", "n").select("lang", "groups")
    parts = near.mapInArrow(_joint, JOINT)
    return B.materialise(parts.groupBy("lang", "s1", "n1", "s2", "n2").agg(F.sum("terms").alias("terms")), "joint")


def weight(n: Column, total: Column, v: Column) -> Column:
    """p of a count; the product passes a bigint for counts over 9 * 10^9."""
    return F.lit(1) + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                                      (total + v).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_values(groups: DataFrame, joint: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language."""
    own = groups.select("lang", "source", "total", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    pairs = own.join(other, "lang").where("source != item")
    zero = F.lit(0)
    z, zi = weight(zero, F.col("total"), F.col("v")), weight(zero, F.col("item_total"), F.col("v"))
    exact = lambda terms, x: terms.cast("decimal(19,0)") * x.cast("decimal(19,0)")
    some = pairs.where("v > 0")

    # own: weights at the joint level; z..: at level 0
    cells = joint.where("s1 < s2").select("lang", F.col("s1").alias("source"), F.col("s2").alias("item"), "n1", "n2", "terms")
    cells = cells.join(some, ["lang", "source", "item"]).select(
        "lang", "source", "item", "terms", weight(F.col("n1"), F.col("total"), F.col("v")).alias("p"),
        weight(F.col("n2"), F.col("item_total"), F.col("v")).alias("q"), z.alias("zp"), zi.alias("zq"))

    def beyond(p, q, zp, zq):
        p, q, zp, zq = map(F.col, (p, q, zp, zq))
        return exact(F.col("terms"), gap(p, q) - gap(p, zq) - gap(zp, q) + gap(zp, zq))
    cells = cells.groupBy("lang", "source", "item").agg(F.sum(beyond("p", "q", "zp", "zq")).alias("to"),
                                                        F.sum(beyond("q", "p", "zq", "zp")).alias("back"))
    levels = joint.where("s1 = s2").select("lang", F.col("s1").alias("source"), F.col("n1").alias("n"), "terms")
    levels = levels.join(some, ["lang", "source"]).select(
        "lang", "source", "item", "terms", weight(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        z.alias("zp"), zi.alias("zq"))
    levels = levels.groupBy("lang", "source", "item").agg(
        F.sum(exact(F.col("terms"), gap(F.col("p"), F.col("zq")) - gap(F.col("zp"), F.col("zq")))).alias("to"),
        F.sum(exact(F.col("terms"), gap(F.col("zq"), F.col("p")) - gap(F.col("zq"), F.col("zp")))).alias("back"))
    none = F.lit(0).cast("decimal(38,0)")
    base = pairs.select("lang", "source", "item", F.when(F.col("v") > 0, exact(F.col("v"), gap(z, zi))).otherwise(none)
                        .alias("to"), none.alias("back"))
    parts = base.unionByName(cells).unionByName(levels).select("lang", F.inline(F.array(
        F.struct("source", "item", F.col("to").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def term_values(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms each group uses more than its language."""
    rows = kept.select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.explode("groups").alias("g"))
    rows = rows.select("lang", F.col("g.source").alias("source"), "item", F.col("g.n").alias("n"), "lang_n")
    rows = rows.join(groups, ["lang", "source"]).select(
        "lang", "source", "item", weight(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        weight(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")).where("p > q")
    return rows.select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part ("pair" or "term"), item, value, rank."""
    B.prepare(docs.sparkSession)
    kept = kept_terms(docs, text_col, lang_col, source_col, min_docs)
    groups = group_totals(docs, kept, lang_col, source_col)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")

    def part(rows, name):
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank)
    return part(pair_values(groups, joint_tables(kept)), "pair").unionByName(
        part(term_values(groups, kept), "term").where(F.col("rank") <= top))


ORACLE_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
tok as (
  select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
c as (
  select lang, source, term, count(*) as n, count(distinct r) as docs from tok group by lang, source, term),
l as (
  select lang, term, sum(n) as ln from c group by lang, term having sum(docs) >= 3),
g as (select distinct lang, source from d),
k as (
  select g.lang, g.source, l.term, coalesce(c.n, 0) as n, l.ln
  from g join l on g.lang = l.lang left join c on c.lang = g.lang and c.source = g.source and c.term = l.term),
tot as (
  select lang, source, count(*) as v, sum(n) as total, sum(ln) as lang_total from k group by lang, source),
w as (
  select k.lang, k.source, k.term, k.n, 1 + (1000000000::hugeint * (k.n + 1)) // (total + v) as p,
    1 + (1000000000::hugeint * (k.ln + 1)) // (lang_total + v) as q
  from k join tot on k.lang = tot.lang and k.source = tot.source),
pair as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from w a join w b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pair.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
    left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from w where n > 0 and p > q)
select lang, source, part, item, value,
  (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from every qualify part = 'pair' or rank <= 200
"""
