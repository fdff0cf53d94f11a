"""Data contracts: key uniqueness, NOT NULL, grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractViolation(ValueError):
    pass


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n_rows``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_null)`` for each listed column holding NULLs."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "n_null")
    return long.filter(F.col("n_null") > 0)


def assert_contract(df: DataFrame, keys: Sequence[str] = (),
                    not_null: Sequence[str] = (), name: str = "table") -> None:
    """Raise ``ContractViolation`` if a key repeats or a column is NULL.

    Both checks are one pass: rows and NULLs are counted per key (partial
    aggregates), then the greatest count and the NULLs are. Only for the message
    of a violation are up to 5 keys fetched.
    """
    nulls = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"_n{i}") for i, c in enumerate(not_null)]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    got = per_key.agg(F.max("_rows").alias("most"),
                      *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(nulls))]).first()
    if keys and (got["most"] or 0) > 1:
        bad = key_violations(df, keys).limit(5).collect()
        raise ContractViolation(f"{name}: duplicate key {list(keys)}: {bad}")
    bad = [(c, got[f"_n{i}"]) for i, c in enumerate(not_null) if got[f"_n{i}"]]
    if bad:
        raise ContractViolation(f"{name}: NULL in {bad}")


def grain_report(models: dict, grains: dict) -> DataFrame:
    """Per model, how many grain keys repeat (``model, grain, n_keys``).

    One small aggregate per model, unioned; zero means the grain holds."""
    out = None
    for name, df in models.items():
        keys = grains[name]
        n = key_violations(df, keys).agg(F.count(F.lit(1)).alias("n_keys"))
        part = n.select(F.lit(name).alias("model"), F.lit(",".join(keys)).alias("grain"), "n_keys")
        out = part if out is None else out.unionByName(part)
    return out
