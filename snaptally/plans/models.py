"""Bronze, silver and gold models.

Every function takes and returns DataFrames; nothing runs until an action.
``fact`` and ``dim_track`` both key on ``track_persistent_id``, so reports
that join them, or roll the fact up per track first, reuse that partitioning.

``scope`` names extra key columns (e.g. ``["library_id"]``) so that many
libraries share one table: every key, join and group gains them, and one
job computes every library's layers. An empty scope is one library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact, ms_to_minutes
from ..operators.delta import counter_delta
from ..operators.latest import latest_by
from ..schema import (DIM_TRACK_COLUMNS, ENTITY, FACT_COLUMNS, RAW_COLUMNS,
                      SILVER_COLUMNS, SNAPSHOT, TIEBREAK)


def bronze(raw: DataFrame, scope: tuple = ()) -> DataFrame:
    """The 25 raw columns (after any scope columns), passed through."""
    return raw.select(*scope, *RAW_COLUMNS)


def silver(bronze_df: DataFrame, blank_id: str = "keep", scope: tuple = ()) -> DataFrame:
    """R2: rows with an id, renamed and typed.

    ``blank_id="keep"`` keeps an empty ``persistent_id`` as one shared id
    (the source behaviour); ``"null"`` drops such rows like missing ids.
    """
    pid = F.col("persistent_id")
    keep = pid.isNotNull()
    if blank_id == "null":
        keep = keep & (pid != "")
    elif blank_id != "keep":
        raise ValueError(f"unknown blank_id {blank_id!r}")
    rating = F.col("rating")
    return bronze_df.filter(keep).select(
        *scope,
        pid.alias("track_persistent_id"),
        F.col("snapshot_date"),
        F.col("track_id").alias("itunes_track_id"),
        F.col("name").alias("title"),
        F.col("artist").alias("artist_name"),
        F.col("album_artist").alias("album_artist_name"),
        F.col("album").alias("album_name"),
        F.col("genre"),
        F.col("year").alias("release_year"),
        F.col("kind").alias("file_type"),
        F.col("total_time").alias("duration_ms"),
        ms_to_minutes("total_time").alias("duration_min"),
        "disc_number", "disc_count", "track_number", "track_count",
        F.coalesce(F.col("play_count"), F.lit(0)).alias("play_count"),
        F.col("play_date").alias("last_played_at"),
        F.col("play_date_utc").alias("last_played_at_utc"),
        F.coalesce(F.col("skip_count"), F.lit(0)).alias("skip_count"),
        F.col("skip_date").alias("last_skipped_at"),
        rating.alias("rating_raw"),
        F.when(rating.isNull(), F.lit(None)).otherwise(rating / F.lit(20)).alias("rating_stars"),
        F.coalesce(F.col("loved"), F.lit(False)).alias("is_loved"),
        F.col("date_added").alias("added_at"),
        F.col("location").alias("file_path"),
        F.col("snapshot_path"),
    ).select(*scope, *SILVER_COLUMNS)


def fact(silver_df: DataFrame, skew: str = "auto", scope: tuple = (), **skew_opts) -> DataFrame:
    """Per (track, snapshot) counters with deltas to the track's previous row."""
    base = silver_df.select(*scope, ENTITY, SNAPSHOT, TIEBREAK, "play_count", "skip_count",
                            "last_played_at_utc", "duration_min")
    d = counter_delta(base, [*scope, ENTITY], SNAPSHOT, ["play_count", "skip_count"],
                      tiebreak=[TIEBREAK], skew=skew, **skew_opts)
    return d.select(*scope, *FACT_COLUMNS)


def dim_track(silver_df: DataFrame, method: str = "window", scope: tuple = ()) -> DataFrame:
    """Latest state of each track (a higher track id wins within a date)."""
    cols = [c for c in DIM_TRACK_COLUMNS if c != ENTITY]
    latest = latest_by(silver_df.select(*scope, *DIM_TRACK_COLUMNS, SNAPSHOT), [*scope, ENTITY],
                       [SNAPSHOT], tiebreak=[TIEBREAK], columns=cols, method=method)
    return latest.select(*scope, *DIM_TRACK_COLUMNS)


def dim_artist(dim: DataFrame, scope: tuple = ()) -> DataFrame:
    """Per artist of the latest state: tracks, distinct albums, duration."""
    return (dim.filter(F.col("artist_name").isNotNull())
            .groupBy(*scope, "artist_name")
            .agg(F.count(F.col(ENTITY)).alias("track_count"),  # one row per track
                 F.count_distinct("album_name").alias("album_count"),
                 F.sum(exact("duration_min")).cast("double").alias("total_duration_min")))


def dim_album(dim: DataFrame, scope: tuple = ()) -> DataFrame:
    """Per (album, album artist): first release year, tracks, duration."""
    return (dim.filter(F.col("album_name").isNotNull())
            .groupBy(*scope, "album_name", "album_artist_name")
            .agg(F.min("release_year").alias("release_year"),
                 F.count(F.col(ENTITY)).alias("track_count"),
                 F.sum(exact("duration_min")).cast("double").alias("total_duration_min")))
