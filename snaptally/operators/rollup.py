"""Positive-delta roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import else_count, positive, positive_weighted


def positive_rollup(df: DataFrame, keys: Sequence[str], delta: str,
                    weight: str | None = None, plays: str = "plays",
                    minutes: str = "minutes_x", else_rows: str | None = "n_else",
                    distinct: str | None = None, distinct_name: str = "unique_tracks") -> DataFrame:
    """Per group: sum of positive deltas (bigint) and, with ``weight``, the
    exact decimal sum of ``delta * weight`` over positive deltas.

    ``else_rows`` counts rows taking the zero branch, which tells a NULL
    weighted sum (only NULL-weight plays) from a zero one after roll-up.
    Partial aggregation runs before the shuffle, so a hot group is cheap.
    """
    aggs = [F.sum(positive(delta)).cast("long").alias(plays)]
    if weight is not None:
        aggs.append(F.sum(positive_weighted(delta, weight)).alias(minutes))
    if else_rows:
        aggs.append(else_count(delta).alias(else_rows))
    if distinct is not None:
        aggs.append(F.count_distinct(distinct).alias(distinct_name))
    return df.groupBy(*keys).agg(*aggs)
