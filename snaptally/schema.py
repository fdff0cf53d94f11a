"""Table schemas and column constants (the raw snapshot contract)."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw snapshot table, one row per (snapshot_date, track_id).
# Comments carry the source's column descriptions (D3).
RAW_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.DateType(), False,
                  {"comment": "date of the snapshot"}),
    T.StructField("snapshot_path", T.StringType(), False,
                  {"comment": "file the snapshot was read from"}),
    T.StructField("track_id", T.LongType(), False,
                  {"comment": "track id inside the library"}),
    T.StructField("name", T.StringType(), True, {"comment": "song title"}),
    T.StructField("artist", T.StringType(), True, {"comment": "artist name"}),
    T.StructField("album_artist", T.StringType(), True),
    T.StructField("album", T.StringType(), True, {"comment": "album name"}),
    T.StructField("genre", T.StringType(), True),
    T.StructField("kind", T.StringType(), True),
    T.StructField("total_time", T.IntegerType(), True, {"comment": "duration in ms"}),
    T.StructField("disc_number", T.IntegerType(), True),
    T.StructField("disc_count", T.IntegerType(), True),
    T.StructField("track_number", T.IntegerType(), True),
    T.StructField("track_count", T.IntegerType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("date_added", T.TimestampNTZType(), True),
    T.StructField("play_count", T.IntegerType(), True,
                  {"comment": "play count (cumulative)"}),
    T.StructField("play_date", T.LongType(), True),
    T.StructField("play_date_utc", T.TimestampNTZType(), True,
                  {"comment": "last played at (UTC)"}),
    T.StructField("skip_count", T.IntegerType(), True),
    T.StructField("skip_date", T.TimestampNTZType(), True),
    T.StructField("rating", T.IntegerType(), True, {"comment": "0-100"}),
    T.StructField("loved", T.BooleanType(), True),
    T.StructField("persistent_id", T.StringType(), True,
                  {"comment": "stable track identity of the library application"}),
    T.StructField("location", T.StringType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
RAW_KEY = ["snapshot_date", "track_id"]
RAW_NOT_NULL = ["snapshot_date", "snapshot_path", "track_id"]

ENTITY = "track_persistent_id"
SNAPSHOT = "snapshot_date"
TIEBREAK = "itunes_track_id"

SILVER_COLUMNS = [
    "track_persistent_id", "snapshot_date", "itunes_track_id", "title",
    "artist_name", "album_artist_name", "album_name", "genre", "release_year",
    "file_type", "duration_ms", "duration_min", "disc_number", "disc_count",
    "track_number", "track_count", "play_count", "last_played_at",
    "last_played_at_utc", "skip_count", "last_skipped_at", "rating_raw",
    "rating_stars", "is_loved", "added_at", "file_path", "snapshot_path",
]

DIM_TRACK_COLUMNS = [
    "track_persistent_id", "itunes_track_id", "title", "artist_name",
    "album_artist_name", "album_name", "genre", "release_year", "file_type",
    "duration_ms", "duration_min", "disc_number", "disc_count", "track_number",
    "track_count", "rating_raw", "rating_stars", "is_loved", "added_at",
]

FACT_COLUMNS = [
    "track_persistent_id", "snapshot_date", "play_count", "skip_count",
    "last_played_at_utc", "duration_min", "play_count_delta",
    "skip_count_delta", "prev_snapshot_date",
]

# Documented grain of each model (D5). dim_album is documented by album
# name, though its rows are per (album name, album artist): the check shows it.
GRAINS = {
    "raw": ["snapshot_date", "track_id"],
    "silver": ["track_persistent_id", "snapshot_date"],
    "fact": ["track_persistent_id", "snapshot_date"],
    "dim_track": ["track_persistent_id"],
    "dim_artist": ["artist_name"],
    "dim_album": ["album_name"],
}
