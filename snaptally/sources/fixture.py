"""Raw snapshot rows derived from the driver's tables.

Parts play the tracks, quarters are the snapshots, running line counts are
the cumulative counters (FIXTURES.md section 4). A second configuration uses
``events``: users are the entities, days the snapshots, a running event
count the counter and the last event time the last play.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENTITY, RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def persistent_id(key):
    return F.when(key % 97 == 0, F.lit(None)).otherwise(F.lpad(key.cast("string"), 16, "0"))


def fixture_raw(lineitem: DataFrame, part: DataFrame, orders: DataFrame | None = None,
                libraries: int = 3) -> DataFrame:
    """The 25-column raw snapshot table built from ``lineitem`` and ``part``.

    With ``orders``, plays are split into ``libraries`` libraries by the
    ordering customer (``library_id = o_custkey % libraries``), each with its
    own cumulative counters; the result then leads with ``library_id``.
    """
    lib: list = []
    if orders is not None:
        o = orders.select("o_orderkey", (F.col("o_custkey") % libraries).alias("library_id"))
        lineitem = lineitem.join(o, lineitem["l_orderkey"] == o["o_orderkey"], "inner")
        lib = ["library_id"]
    q = (lineitem
         .groupBy(*lib, "l_partkey",
                  F.date_trunc("quarter", "l_shipdate").cast("date").alias("d"))
         .agg(F.count(F.lit(1)).alias("n"),
              F.count(F.when(F.col("l_returnflag") == "R", F.lit(1))).alias("r"),
              F.max("l_shipdate").alias("last_ts")))
    # at most one row per part and quarter here, so the window groups are small
    w = Window.partitionBy(*lib, "l_partkey").orderBy("d")
    if lib:  # dealt by part, the window and the parts need no shuffle of their own
        q = q.repartition("l_partkey")
    c = q.select("*", F.sum("n").over(w).alias("cn"), F.sum("r").over(w).alias("cr"))
    p = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = c.join(p, c["l_partkey"] == p["p_partkey"], "inner")

    size, key, d = F.col("p_size"), F.col("p_partkey"), F.col("d")
    cn, cr = F.col("cn"), F.col("cr")

    def unless(cond, value):
        return F.when(cond, F.lit(None)).otherwise(value)

    return j.select(
        *lib,
        d.alias("snapshot_date"),
        F.lit("fixture").alias("snapshot_path"),
        key.alias("track_id"),
        F.col("p_name").alias("name"),
        unless(size % 13 == 0, F.col("p_brand")).alias("artist"),
        unless(size % 3 == 0, F.concat(F.lit("AA "), F.col("p_brand"))).alias("album_artist"),
        unless(size % 10 == 0, F.col("p_type")).alias("album"),
        F.col("p_type").alias("genre"),
        F.lit("AAC").alias("kind"),
        unless(key % 53 == 0, (F.lit(180000) + (key * 7919) % 120000 + F.year(d) % 2)
               .cast("int")).alias("total_time"),
        F.lit(1).alias("disc_number"),
        F.lit(1).alias("disc_count"),
        (key % 12).cast("int").alias("track_number"),
        F.lit(12).alias("track_count"),
        (F.lit(1990) + size % 30).cast("int").alias("year"),
        unless(key % 19 == 0, F.make_timestamp_ntz(
            F.lit(2015) + key % 8, F.lit(1) + key % 12, F.lit(1) + key % 28,
            key % 24, key % 60, key % 60)).alias("date_added"),
        unless((key + F.month(d) + F.year(d)) % 11 == 0, (cn - cn % 2).cast("int"))
        .alias("play_count"),
        unless(key % 29 == 0, (F.lit(3_000_000_000) + key * 37 + cn).cast("bigint")).alias("play_date"),
        F.col("last_ts").cast(T.TimestampNTZType()).alias("play_date_utc"),
        unless(key % 7 == 0, cr.cast("int")).alias("skip_count"),
        unless(key % 17 == 0, F.col("last_ts").cast(T.TimestampNTZType()) - F.make_dt_interval(
            F.lit(0), F.lit(0), (key % 1000).cast("int"))).alias("skip_date"),
        unless(size % 5 == 0, (size % 6 * 20 - size % 2 * (size % 6)).cast("int")).alias("rating"),
        unless(size % 4 == 0, size % 2 == 1).alias("loved"),
        persistent_id(key).alias("persistent_id"),
        unless(size % 9 == 0, F.concat(F.lit("file:///Music/"), F.col("p_brand"), F.lit("/"), F.col("p_name"),
                                       F.lit(" & 100%+/"), key.cast("string"), F.lit(".m4a"))).alias("location"),
    ).select(*lib, *RAW_COLUMNS)


def load_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_raw(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def load_line_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track of every line (``track_persistent_id``): a track's snapshots are quarters of its
    lines, so it has at least as many lines; neither the counters nor the parts are needed."""
    key = F.col("l_partkey")
    return read_table(spark, sf_dir, "lineitem").select(persistent_id(key).alias(ENTITY)).where(F.col(ENTITY).isNotNull())


def load_library_fixture(spark: SparkSession, sf_dir: str, libraries: int = 3) -> DataFrame:
    """Raw snapshots of several libraries in one table (``library_id`` first)."""
    return fixture_raw(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"),
                       read_table(spark, sf_dir, "orders"), libraries)


def event_counters(events: DataFrame) -> DataFrame:
    """``events`` as cumulative per-user counters, one snapshot per day.

    Columns: ``user_id, snapshot_date, play_count`` (running event count),
    ``last_played_at_utc`` (last event time up to that day).
    """
    daily = (events
             .groupBy("user_id", F.col("ts").cast("date").alias("snapshot_date"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")))
    # one row per user and day: window groups are bounded by the day count
    w = Window.partitionBy("user_id").orderBy("snapshot_date")
    return daily.select(
        "user_id", "snapshot_date",
        F.sum("n").over(w).cast("int").alias("play_count"),
        F.col("last_ts").cast(T.TimestampNTZType()).alias("last_played_at_utc"),
    )
