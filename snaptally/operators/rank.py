"""Competition ranking, top-k with ties and ordered first-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def competition_rank(df: DataFrame, measure: str, partition: Sequence[str] = (),
                     rank_col: str = "rank", where: Column | None = None,
                     max_rank: int | None = None, method: str = "histogram") -> DataFrame:
    """``RANK() OVER ([PARTITION BY partition] ORDER BY measure DESC)``.

    Ties share a rank and leave gaps. The result is a ``bigint``.

    ``method="histogram"`` (default) never moves the ranked rows into one
    task: it counts rows per distinct ``(partition, measure)``, runs the
    window over that small histogram (rank = 1 + rows with a greater
    measure) and joins the rank back. The histogram has one row per
    distinct measure value; for positive integer counts summing to P that
    is at most sqrt(2P) rows. ``max_rank`` cuts at the k-th value: of the histogram at most
    ``max_rank`` rows per partition are left, which the optimizer broadcasts by their real size, so
    neither the rows below the cut nor those tied at it are moved. ``method="window"`` is
    the plain ``rank()``, whose unpartitioned form runs in a single task.
    """
    part = list(partition)
    if where is not None:
        df = df.filter(where)
    if method == "window":
        w = Window.partitionBy(*part).orderBy(F.col(measure).desc_nulls_last())
        out = df.withColumn(rank_col, F.rank().over(w).cast("long"))
        return out.filter(F.col(rank_col) <= max_rank) if max_rank is not None else out
    if method != "histogram":
        raise ValueError(f"unknown method {method!r}")
    hist = df.groupBy(*part, measure).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*part).orderBy(F.col(measure).desc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, -1))
    hist = hist.select(
        *[F.col(p).alias(f"_p{i}") for i, p in enumerate(part)],
        F.col(measure).alias("_m"),
        (F.lit(1) + F.coalesce(F.sum("_n").over(w), F.lit(0))).cast("long").alias(rank_col),
    )
    if max_rank is not None:
        hist = hist.filter(F.col(rank_col) <= max_rank)
    cond = F.col(measure).eqNullSafe(F.col("_m"))
    for i, p in enumerate(part):
        cond = cond & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return df.join(hist, cond, "inner").drop("_m", *[f"_p{i}" for i in range(len(part))])


def top_k(df: DataFrame, k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``<= k``; all rows tied at the cut are kept."""
    return df.filter(F.col(rank_col) <= k)


def first_n(df: DataFrame, n: int, order: Sequence, tiebreak: Sequence = ()) -> DataFrame:
    """``ORDER BY order, tiebreak LIMIT n`` (planned as TakeOrderedAndProject).

    Give a ``tiebreak`` that makes the order total, so the cut is stable.
    """
    return df.orderBy(*order, *tiebreak).limit(n)


def order_by_rank(df: DataFrame, rank_col: str = "rank", tiebreak: Sequence = ()) -> DataFrame:
    """``ORDER BY rank [, tiebreak]`` of a whole report (range-partitioned
    sort; no single task). For the first rows only use ``first_n``."""
    return df.orderBy(F.col(rank_col), *tiebreak)
