"""Mixing sources to target weights: temperature, then budgeted block permutations.

With p the sources' token shares, the weights are w ~ p^a. The exponent a in [0, 1] is
bisected to the greatest value at which the weights' entropy is at least
``entropy_target`` times ln(number of sources) and, if given, raised to the smallest value
at which no source is repeated more than ``max_repeats`` times (a = 1 is the corpus as it
is, a = 0 equal weights). Several bisection steps are answered by one aggregate over the
source totals, so the sources never come to the driver.

A source's quota is its weight times the token budget. Documents of a source are dealt to
blocks by a seeded hash of their key, blocks and the documents in them are permuted by the
same hash, and an epoch takes the blocks in order. Every document is drawn
floor(quota / source tokens) times, and once more if the tokens before it in the
permutation are under what is left of the quota. Token sums run inside blocks and over
block totals, so a source with a third of all rows is many small windows.

Defined cases: a null text has no tokens; a null source is a source of its own; a source
without tokens has weight 0 and no draws; documents with equal keys share a place in the
order and are drawn alike (repeated rows stay repeated); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptally.llm import base as B

STEPS = 5  # bisection steps answered by one aggregate
ROUNDS = 8


def source_totals(docs: DataFrame) -> DataFrame:
    """source, tokens, n_docs."""
    return docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))


def _bisect(totals: DataFrame, total: float, good) -> float | None:
    """The greatest exponent in [0, 1] with good(z, zlogp, peak) on a falling predicate, or None.

    For exponent a: z = sum p^a, zlogp = sum p^a ln p, peak = greatest p^(a-1). One
    aggregate evaluates the 2^STEPS - 1 inner points that STEPS bisections could visit."""
    p = F.col("tokens") / F.lit(total)

    def measure(points):
        row = totals.where(F.col("tokens") > 0).agg(*[x for i, a in enumerate(points) for x in (
            F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{i}"),
            F.max(F.pow(p, F.lit(a - 1.0))).alias(f"m{i}"))]).first()
        return [good(a, row[f"z{i}"], row[f"l{i}"], row[f"m{i}"]) for i, a in enumerate(points)]
    at_zero, at_one = measure([0.0, 1.0])
    if at_one:
        return 1.0
    if not at_zero:
        return None
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * k / 2 ** STEPS for k in range(1, 2 ** STEPS)]
        ok = measure(points)
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            at = min(range(len(points)), key=lambda i: abs(points[i] - mid))
            lo, hi = (mid, hi) if ok[at] else (lo, mid)
    return lo


def temperature(totals: DataFrame, budget: float, entropy_target: float = 0.95,
                max_repeats: float | None = 4.0) -> float:
    """The exponent: the entropy target, then the repetition limit, which wins."""
    row = totals.agg(F.sum("tokens").alias("t"), F.count(F.when(F.col("tokens") > 0, 1)).alias("n")).first()
    total, n = float(row["t"] or 0), row["n"]
    if n < 2:
        return 1.0
    # H = ln z - a zlogp / z
    entropy = _bisect(totals, total, lambda a, z, zl, m: math.log(z) - a * zl / z >= entropy_target * math.log(n))
    a = 0.0 if entropy is None else entropy
    if max_repeats is None:
        return a
    # repeats of a source: p^a / z * budget / (p * total), most for the smallest source; falls as a rises
    repeats = _bisect_up(totals, total, lambda x, z, zl, m: m / z * budget / total <= max_repeats)
    return max(a, repeats)


def _bisect_up(totals: DataFrame, total: float, good) -> float:
    """The smallest exponent with good(...) on a rising predicate; 1 if there is none."""
    first_bad = _bisect(totals, total, lambda *x: not good(*x))
    return 0.0 if first_bad is None else first_bad


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        budget: float | None = None, entropy_target: float = 0.95, max_repeats: float | None = 4.0,
        seed: int = 17, block_docs: int = 2048) -> DataFrame:
    """id, text_hash, source, n_tokens, weight, copies, block, place.

    ``budget``: tokens to draw, by default as many as the corpus has. ``copies``: times
    the document is drawn (0: not in this mixture). ``block`` and ``place`` (tokens
    before it) give the order of drawing inside the source."""
    words = F.size(F.filter(F.split(B.text_of(text_col), B.SPACE), lambda w: w != "")).cast("long")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(B.text_of(text_col)).alias("text_hash"),
                    F.col(source_col).alias("source"), words.alias("n_tokens"))
    d = B.materialise(d, "mix-documents")
    totals = B.materialise(source_totals(d), "mix-sources")
    total = float(totals.agg(F.sum("tokens")).first()[0] or 0)
    want = total if budget is None else float(budget)
    a = temperature(totals, want, entropy_target, max_repeats)
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(max(total, 1.0)), F.lit(a))).otherwise(0.0)
    z = float(totals.agg(F.sum(share)).first()[0] or 1.0)
    plan = B.materialise(totals.select(
        "source", "tokens", (share / F.lit(z)).alias("weight"),
        F.ceil(F.col("n_docs") / block_docs).alias("n_blocks")), "mix-plan")

    # the plan's rows are sources: joined by source, skewed sources are split by AQE
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    key = F.xxhash64(F.lit(seed), "id", "text_hash")
    dealt = d.alias("d").join(plan.alias("p"), same).select(
        "d.*", "weight", "tokens", key.alias("key"), F.pmod(F.xxhash64(F.lit(seed + 1), "id", "text_hash"),
                                                          F.col("n_blocks")).alias("block"))
    sums = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    ahead = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "block", F.coalesce(F.sum("block_tokens").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy("d.source", "d.block").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    tied = Window.partitionBy("d.source", "d.block", "key")
    on = (F.col("d.source").eqNullSafe(F.col("s.source"))) & (F.col("d.block") == F.col("s.block"))
    placed = dealt.alias("d").join(starts.alias("s"), on).select(
        "d.*", (F.col("start") + F.sum("n_tokens").over(inside) - F.sum("n_tokens").over(tied)).alias("place"))
    quota = F.col("weight") * F.lit(want)
    epochs = F.floor(quota / F.col("tokens"))
    rest = quota - epochs * F.col("tokens")
    copies = F.when(F.col("tokens") > 0, epochs + F.when(F.col("place") < rest, 1).otherwise(0)).otherwise(0)
    return placed.select("id", "text_hash", "source", "n_tokens", "weight", copies.cast("long").alias("copies"),
                         "block", "place")


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The drawn documents (copies >= 1) with all their columns and ``copies``; repeated rows once each."""
    m = mix(docs, id_col=id_col, text_col=text_col, **params).where("copies > 0")
    m = m.groupBy("id", "text_hash").agg(F.max("copies").alias("copies"))
    d = docs.drop("copies").withColumn("__h", F.xxhash64(B.text_of(text_col)))
    on = d[id_col].eqNullSafe(m["id"]) & (d["__h"] == m["text_hash"])
    return d.join(m, on).select(*[d[c] for c in docs.columns if c != "copies"], m["copies"])


def report(m: DataFrame) -> DataFrame:
    """The query's columns from mix()."""
    return m.select(F.col("id").alias("doc_id"), "source", "n_tokens", "weight", "copies", "block", "place")
