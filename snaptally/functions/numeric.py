"""Numeric column helpers shared by every report.

Two rules keep Spark and DuckDB in step (SURVEY 1.4.16-17):

* ``round_half_away`` rounds ``x * 10^n`` to an integer and divides back,
  which is how DuckDB rounds a double. Spark's ``round(x, n)`` goes through
  the shortest decimal text of ``x`` and differs on values like 5100 ms.
* minutes are summed as exact ``DECIMAL(18,2)`` (a minute value has two
  decimals), so sums do not depend on row order or on pre-aggregation, then
  cast to double once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = T.DecimalType(18, 2)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c, n: int = 0) -> Column:
    """Round a double half away from zero on its exact binary value."""
    c = _c(c).cast("double")
    if n == 0:
        return F.round(c, 0)
    scale = float(10 ** n)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def ms_to_minutes(ms) -> Column:
    """Milliseconds to minutes with two decimals (double)."""
    return round_half_away(_c(ms).cast("double") / F.lit(1000.0) / F.lit(60.0), 2)


def exact(c) -> Column:
    """A two-decimal double as an exact decimal."""
    return _c(c).cast(EXACT)


def positive(delta) -> Column:
    """``delta`` when it is positive, else 0 (NULL deltas count as 0)."""
    d = _c(delta)
    return F.when(d > 0, d).otherwise(F.lit(0))


def positive_weighted(delta, weight) -> Column:
    """``delta * weight`` (exact) when delta is positive, else 0.

    A NULL weight gives NULL for a positive delta, which SUM skips.
    """
    d = _c(delta)
    return F.when(d > 0, d * exact(weight)).otherwise(F.lit(0).cast(EXACT))


def else_count(delta) -> Column:
    """Number of rows that take the ELSE (zero) branch of ``positive``."""
    return F.count(F.when(~F.coalesce(_c(delta) > 0, F.lit(False)), F.lit(1)))


def distinct_count(x, when=None) -> Column:
    """COUNT(DISTINCT x), or of x only where ``when`` holds. Exact."""
    x = _c(x)
    if when is not None:
        x = F.when(_c(when), x)
    return F.count_distinct(x)

