"""Materialised layers: the ``dbt run`` of this engine.

``build`` writes the delta fact and the track dimension as Parquet tables
under one folder (the shared folder by default) and returns readers of
them. Writing cuts the lineage after each shuffle: every report starts
from a scan of the columns it needs instead of recomputing windows.
Silver is a filter and projection of raw (no shuffle), so it stays a lazy
view: storing it would cost a full write to save nothing. Reports are lazy
views over the stored tables, as in the reference.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import hot_list, in_list
from ..schema import ENTITY
from ..session import child_files, scratch_path
from ..sources.store import read_raw
from . import models as M
from . import reports as R


@dataclass
class Warehouse:
    raw: DataFrame | None
    silver: DataFrame | None
    fact: DataFrame
    dim: DataFrame
    totals: DataFrame | None = None  # reports.year_totals of the fact
    days: DataFrame | None = None  # reports.day_totals of the fact

    @property
    def plays(self) -> DataFrame:
        """What reports read: the stored totals if there are any, else the fact."""
        return self.totals if self.totals is not None else self.fact

    @property
    def trends(self) -> DataFrame:
        """What trends read: the stored day totals if there are any, else the fact."""
        return self.days if self.days is not None else self.fact


TABLES = ("fact", "dim_track", "totals")
HOT_FACT, DAYS = "fact_hot", "days"


def build(spark: SparkSession, raw: DataFrame, root: str | None = None,
          skew: str = "auto", buckets: int | None = None, scope: tuple = (), **skew_opts) -> Warehouse:
    """Write fact, dim_track and the totals under ``root``; return readers.

    ``buckets=n`` stores them bucketed (and sorted) by the track
    key into ``n`` buckets, one file each: a report's per-track roll-up and the
    join to the dimension then find their input already clustered and plan no
    exchange for them. Size ``n`` so a bucket is a comfortable task.

    A bucket holds all rows of its tracks, so a hot one (``hot_keys``: at most
    ``2 * hot_max_keys``, found on a sample) would be one task and one file. With ``skew="auto"`` such tracks
    have a fact table of their own beside the bucketed one (``fact_hot``), computed in blocks and
    dealt over all tasks; the fact is the two together. Their totals and latest states are
    partial aggregates, a few rows each, and stay in the bucketed tables. ``skew_opts`` as for
    ``counter_delta``.
    """
    root = root or scratch_path(spark, "warehouse")
    s = M.silver(M.bronze(raw, scope=scope), scope=scope)
    path = {n: os.path.join(root, n) for n in (*TABLES, HOT_FACT, DAYS)}
    days = lambda fact: R.day_totals(fact, scope).coalesce(1).write.mode("overwrite").parquet(path[DAYS])
    if not buckets:
        # the window leaves each task's rows sorted by (track, date): files
        # written from it compress well and keep a track's rows together
        M.fact(s, skew=skew, scope=scope, **skew_opts).write.mode("overwrite").parquet(path["fact"])
        M.dim_track(s, scope=scope).write.mode("overwrite").parquet(path["dim_track"])
        fact = spark.read.parquet(path["fact"])
        R.year_totals(fact, scope).write.mode("overwrite").parquet(path["totals"])
        days(fact)
        _clear(spark, path[HOT_FACT], fact)
        return open_warehouse(spark, root, raw, scope)
    key = [*scope, ENTITY]
    tag = uuid.uuid4().hex[:8]

    def store(df: DataFrame, name: str) -> DataFrame:
        table = f"snaptally_{name}_{tag}"
        (df.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
         .option("path", path[name]).saveAsTable(table))
        return spark.table(table)
    found = hot_list(s, key, **skew_opts) if skew == "auto" else []
    is_hot = F.coalesce(in_list(key, found), F.lit(False)) if found else F.lit(False)
    # dealt by the bucket hash first: the window keeps that dealing, so a task writes one bucket
    dealt = (s.where(~is_hot) if found else s).repartition(buckets, *key)
    fact = store(M.fact(dealt, skew="off" if skew == "auto" else skew, scope=scope), "fact")
    dim = store(M.dim_track(s, scope=scope).repartition(buckets, *key), "dim_track")
    totals = R.year_totals(fact, scope)
    if found:
        opts = {k: v for k, v in skew_opts.items() if k == "block_bits"}
        M.fact(s.where(is_hot), skew="force", scope=scope, **opts).write.mode("overwrite").parquet(path[HOT_FACT])
        hot = spark.read.parquet(path[HOT_FACT])
        totals = totals.unionByName(R.year_totals(hot, scope)).repartition(buckets, *key)
        fact_all = fact.unionByName(hot)
    else:
        _clear(spark, path[HOT_FACT], fact)
        fact_all = fact
    totals = store(totals, "totals")
    days(fact_all)
    return Warehouse(raw=raw, silver=s, fact=fact_all, dim=dim, totals=totals, days=spark.read.parquet(path[DAYS]))


def _clear(spark: SparkSession, path: str, like: DataFrame) -> None:
    """A hot table of an earlier build holds rows that are in the fact now."""
    if child_files(spark, path):
        like.limit(0).write.mode("overwrite").parquet(path)


def open_warehouse(spark: SparkSession, root: str, raw: DataFrame | None = None,
                   scope: tuple = (), buckets: int | None = None) -> Warehouse:
    """Readers of a stored warehouse. ``buckets`` as given to ``build`` opens its tables as
    bucketed ones (registered in this session's catalog under fresh names)."""
    raw = raw if raw is not None else read_raw(spark, os.path.join(root, "raw"), scope)
    key = ", ".join([*scope, ENTITY])

    def table(name: str) -> DataFrame:
        path = os.path.join(root, name)
        plain = spark.read.parquet(path)
        if not buckets:
            return plain
        own = f"snaptally_{name}_{uuid.uuid4().hex[:8]}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        spark.sql(f"CREATE TABLE {own} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
        return spark.table(own)

    def beside(name: str) -> DataFrame | None:
        path = os.path.join(root, name)
        return spark.read.parquet(path) if child_files(spark, path) else None
    fact, dim, totals = (table(n) for n in TABLES)
    hot, days = beside(HOT_FACT), beside(DAYS)
    return Warehouse(raw=raw, silver=M.silver(M.bronze(raw, scope=scope), scope=scope),
                     fact=fact if hot is None else fact.unionByName(hot), dim=dim, totals=totals, days=days)


def report_views(wh: Warehouse, scope: tuple = ()) -> dict[str, DataFrame]:
    """Every report over the materialised layers (lazy)."""
    d, t, k = wh.dim, wh.plays, {"scope": scope}
    return {
        "dim_artist": M.dim_artist(d, **k),
        "dim_album": M.dim_album(d, **k),
        "summary": R.summary(t, d, **k),
        "top_songs": R.top_songs(t, d, **k),
        "top_songs_limit": R.top_songs_limit(t, d, 20, **k),
        "top_artists": R.top_artists(t, d, **k),
        "top_albums": R.top_albums(t, d, **k),
        "top_genres": R.top_genres(t, d, **k),
        "yearly_summary": R.yearly_summary(t, d, **k),
        "yearly_top_artists": R.yearly_top_artists(t, d, **k),
        "yearly_top_songs": R.yearly_top_songs(t, d, **k),
        "yearly_top_albums": R.yearly_top_albums(t, d, **k),
        "replay_page": R.replay_page(t, d, **k),
        "weekly_trend": R.weekly_trend(wh.trends, **k),
        "monthly_trend": R.monthly_trend(wh.trends, **k),
        "library_overview": R.library_overview(wh.raw, **k),
        "snapshot_preview": R.snapshot_preview(wh.raw, **k),
    }


__all__ = ["Warehouse", "build", "open_warehouse", "report_views"]
