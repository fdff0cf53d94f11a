"""Deltas of cumulative counters between consecutive snapshots of an entity.

``counter_delta`` is ``c - LAG(c) OVER (PARTITION BY keys ORDER BY order,
tiebreak)`` for every counter, plus the previous ``order`` value. LAG runs
over the entity's own previous row, so gaps between snapshots are bridged.

Skew: the plain window sends every row of an entity to one task. An entity
may hold a large share of the table (e.g. rows without a real id merged into
one pseudo-entity), so ``skew="auto"`` first finds such hot keys and
computes their deltas in bounded blocks instead:

* hot keys are those with more than ``max(hot_min_rows, total / hot_max_keys)``
  rows, estimated on a ``hot_sample`` fraction of the key columns. At most
  ``2 * hot_max_keys`` keys can pass, so the list has a proven size. One
  small job finds them (it reads only the key columns and shuffles only the
  sample); when there are none, the plan is the plain window with nothing
  added, otherwise the list splits the input with an ``IN`` filter, without
  a join or shuffle;
* a hot entity's rows are cut into blocks ``(keys, order, tiebreak >> bits)``.
  ``(order, tiebreak)`` is unique (the table key), so a block holds at most
  ``2**bits`` rows. LAG runs inside each block; the first row of a block takes
  the last row of the entity's previous block, found by a window over the
  per-block summary (one row per block, partially aggregated).

Both paths give the same rows; tests check that on a forced split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], max_keys: int | None = 1000,
             min_rows: int = 1_000_000, fraction: float = 0.01, seed: int = 17) -> DataFrame:
    """Keys holding more than ``max(min_rows, total/max_keys)`` rows, found on
    a ``fraction`` Bernoulli sample of the key columns (lazy).

    Only the key columns are read and only the sample is shuffled. A key
    passes when its sample count exceeds half its expected threshold, so a
    key at the threshold is missed with negligible probability once the
    sample holds thousands of its rows; a missed key only costs speed (both
    delta paths are exact). At most ``2 * max_keys`` keys can pass whatever
    the data, so the result may be broadcast or collected. ``max_keys=None`` leaves out the
    share of the total: all keys with ``min_rows``, of any number.
    """
    keys = list(keys)
    s = df.select(*keys)
    if fraction < 1.0:
        s = s.sample(fraction=fraction, seed=seed)
    counts = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = F.col("_n") * F.lit(2.0) > F.lit(min_rows * fraction)
    if max_keys is not None:
        found = found & (F.col("_n") * F.lit(2 * max_keys) > s.select(F.count(F.lit(1))).scalar())
    return counts.filter(found).select(*keys)


def hot_list(df: DataFrame, keys: Sequence[str], hot_max_keys: int = 1000, hot_min_rows: int = 1_000_000,
             hot_sample: float = 0.01, **_) -> list[tuple]:
    """The hot keys, collected (at most ``2 * hot_max_keys``). ``df`` is run once if no key has
    ``hot_min_rows``, as is usual; only else are the rows counted that a share is taken of."""
    if hot_keys(df, keys, None, hot_min_rows, hot_sample).isEmpty():
        return []
    return [tuple(r) for r in hot_keys(df, keys, hot_max_keys, hot_min_rows, hot_sample).collect()]


def in_list(keys: Sequence[str], values: list[tuple]) -> Column:
    """``keys IN (values)`` for a short, bounded list of key tuples; a NULL
    key value matches NULL (a hot group may be the NULL key)."""
    cond = None
    for v in values:
        c = None
        for k, x in zip(keys, v):
            e = F.col(k).isNull() if x is None else (F.col(k) == F.lit(x))
            c = e if c is None else c & e
        cond = c if cond is None else cond | c
    if len(keys) == 1 and all(v[0] is not None for v in values):
        return F.col(keys[0]).isin([v[0] for v in values])
    return F.coalesce(cond, F.lit(False))


def _plain(df: DataFrame, keys, order, counters, tiebreak, prev_col, suffix) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order, *tiebreak)
    return df.select(
        "*",
        *[(F.col(c) - F.lag(c).over(w)).alias(c + suffix) for c in counters],
        F.lag(order).over(w).alias(prev_col),
    )


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _blocked(df: DataFrame, keys, order, counters, tiebreak, prev_col, suffix,
             bits: int) -> DataFrame:
    cols = df.columns
    # blocks of at most 2**bits rows need an integral tiebreak; otherwise a
    # block is one (key, order) group
    integral = bool(tiebreak) and dict(df.dtypes).get(tiebreak[0]) in _INTEGRAL
    blk = F.shiftright(F.col(tiebreak[0]), bits) if integral else F.lit(0)
    d = df.withColumn("_blk", blk)
    part = [*keys, order, "_blk"]
    w_in = Window.partitionBy(*part).orderBy(*(tiebreak or [order]))
    rows = d.select(
        "*",
        F.row_number().over(w_in).alias("_pos"),
        *[F.lag(c).over(w_in).alias("_in_" + c) for c in counters],
    )
    ordering = F.struct(*tiebreak) if tiebreak else F.lit(0)
    last = d.groupBy(*part).agg(F.max_by(F.struct(*counters), ordering).alias("_last"))
    w_b = Window.partitionBy(*keys).orderBy(order, "_blk")
    prev = last.select(*[F.col(c).alias(f"_j{i}") for i, c in enumerate(part)],
                       F.lag("_last").over(w_b).alias("_prev_last"),
                       F.lag(order).over(w_b).alias("_prev_order"))
    cond = None
    for i, c in enumerate(part):  # null-safe: a NULL key is a group too
        e = F.col(c).eqNullSafe(F.col(f"_j{i}"))
        cond = e if cond is None else cond & e
    j = rows.join(prev, cond, "left")
    first = F.col("_pos") == 1
    return j.select(
        *cols,
        *[(F.col(c) - F.when(first, F.col("_prev_last").getField(c))
           .otherwise(F.col("_in_" + c))).alias(c + suffix) for c in counters],
        F.when(first, F.col("_prev_order")).otherwise(F.col(order)).alias(prev_col),
    )


def counter_delta(df: DataFrame, keys: Sequence[str], order: str,
                  counters: Sequence[str], tiebreak: Sequence[str] = (),
                  prev_col: str | None = None, suffix: str = "_delta",
                  skew: str = "auto", hot_max_keys: int = 1000,
                  hot_min_rows: int = 1_000_000, block_bits: int = 20,
                  hot_sample: float = 0.01, hot_from: DataFrame | None = None) -> DataFrame:
    """Add ``<counter><suffix>`` for each counter and ``prev_<order>``.

    ``tiebreak`` orders rows sharing ``(keys, order)``; give an integer
    column that makes ``(order, tiebreak)`` unique for deterministic results.
    ``skew`` is ``"auto"`` (find hot keys with one small job, split them, see
    module doc), ``"off"`` (plain window) or ``"force"`` (blocked path for every
    key; for tests). ``hot_from`` may give rows that hold the keys at least as often as ``df``
    does but are read at less cost: hot keys are then looked for there.
    """
    keys, counters, tiebreak = list(keys), list(counters), list(tiebreak)
    prev_col = prev_col or f"prev_{order}"
    args = (keys, order, counters, tiebreak, prev_col, suffix)
    if skew == "off":
        return _plain(df, *args)
    if skew == "force":
        return _blocked(df, *args, bits=block_bits)
    if skew != "auto":
        raise ValueError(f"unknown skew mode {skew!r}")
    found = hot_list(df if hot_from is None else hot_from, keys, hot_max_keys, hot_min_rows, hot_sample)
    if not found:
        return _plain(df, *args)
    is_hot = in_list(keys, found)
    return (_plain(df.filter(~is_hot | is_hot.isNull()), *args)
            .unionByName(_blocked(df.filter(is_hot), *args, bits=block_bits)))
