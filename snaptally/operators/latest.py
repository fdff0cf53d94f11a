"""Latest state per entity (SCD type 1 dimension)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              tiebreak: Sequence[str] = (), columns: Sequence[str] | None = None,
              method: str = "window") -> DataFrame:
    """One row per ``keys``: the row with the greatest ``(order, tiebreak)``.

    ``method="window"`` (default) is ``row_number() = 1``: Catalyst plans a
    partial ``WindowGroupLimit`` before the shuffle, so each map task sends
    at most one row per key and a key holding a large share of all rows
    never lands whole in one task. ``method="aggregate"`` is
    ``max_by(struct(row), struct(order))`` per key, partially aggregated the
    same way (a sort-based aggregate, as the buffer is a struct).
    """
    keys, order, tiebreak = list(keys), list(order), list(tiebreak)
    cols = [c for c in (columns or df.columns) if c not in keys]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order + tiebreak])
        return (df.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") == 1).select(*keys, *cols))
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    latest = F.max_by(F.struct(*cols), F.struct(*order, *tiebreak)).alias("_latest")
    return (df.groupBy(*keys).agg(latest)
            .select(*keys, *[F.col("_latest").getField(c).alias(c) for c in cols]))
