"""Reports over the delta fact and the latest-state dimension.

Shape of every ranked report: roll the fact up per track first (partial
aggregation, in the fact's own partitioning), join that one-row-per-track
table to the one-row-per-track dimension (no fan-out, no hot key), group by
the report key, drop zero-play groups, rank with the histogram rank. Songs are
ranked before they meet the dimension. Every ``fact`` argument but those of the
trends may be the stored ``year_totals`` instead; no report then reads the fact.

Minutes are exact decimal sums (``positive_weighted``), so rolling up per
track first gives the same values as summing the joined rows directly.

``scope`` (e.g. ``("library_id",)``) makes every report per scope value:
the scope joins the track key, leads every group key and partitions every
rank, so one job reports on all libraries at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import (EXACT, distinct_count, exact, positive,
                                 positive_weighted, round_half_away)
from ..operators.rank import competition_rank, first_n
from ..operators.rollup import positive_rollup
from ..schema import ENTITY, SNAPSHOT

DELTA = "play_count_delta"


def _played_fact(fact: DataFrame) -> DataFrame:
    """Fact rows that have a previous snapshot (first sightings dropped)."""
    return fact.filter(F.col(DELTA).isNotNull())


def year_totals(fact: DataFrame, scope: tuple = ()) -> DataFrame:
    """The (track, year) roll-up that every song, artist, album and summary report follows from.

    ``plays``; exact ``minutes_x`` of the rows with plays by the fact's duration; and the
    number of rows with a positive (``n_pos``), another (``n_zero``) and no delta
    (``n_first``), and of plays of a known duration (``n_timed``). A year is that of the later
    snapshot of a delta. Reports take this table (stored by ``warehouse.build``) in place of the fact."""
    plays = F.col(DELTA) > 0
    return fact.groupBy(*scope, ENTITY, year_of(SNAPSHOT).alias("year")).agg(
        F.sum(positive(DELTA)).cast("long").alias("plays"),
        F.sum(F.when(plays, positive_weighted(DELTA, "duration_min"))).alias("minutes_x"),
        F.count(F.when(plays, 1)).alias("n_pos"),
        F.count(F.when(F.col(DELTA).isNotNull() & ~plays, 1)).alias("n_zero"),
        F.count(F.when(F.col(DELTA).isNull(), 1)).alias("n_first"),
        F.count(F.when(plays, F.col("duration_min"))).alias("n_timed"))


TOTALS = ["plays", "minutes_x", "n_pos", "n_zero", "n_first", "n_timed"]


def merge_totals(added: list[DataFrame], gone: list[DataFrame], scope: tuple = ()) -> DataFrame:
    """``year_totals`` of a fact from those of its parts: ``added`` count, ``gone`` are taken back.

    All columns are sums, so a (track, year) whose parts are known needs no other row; one
    without rows left goes. Minutes are unknown (NULL) when no play of a known duration is left."""
    key = [*scope, ENTITY, "year"]

    def signed(df, sign):
        minutes = F.coalesce("minutes_x", F.lit(0).cast(EXACT))
        each = [minutes if c == "minutes_x" else F.col(c) for c in TOTALS]
        return df.select(*key, *[(x if sign > 0 else -x).alias(c) for c, x in zip(TOTALS, each, strict=True)])
    parts = [*[signed(a, 1) for a in added], *[signed(g, -1) for g in gone]]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    t = every.groupBy(*key).agg(*[F.sum(c).alias(c) for c in TOTALS]).where(F.col("n_pos") + F.col("n_zero") + F.col("n_first") > 0)
    minutes = F.when(F.col("n_timed") > 0, F.col("minutes_x")).cast("decimal(38,2)")
    return t.select(*key, *[minutes.alias(c) if c == "minutes_x" else F.col(c).cast("long").alias(c) for c in TOTALS])


def day_totals(fact: DataFrame, scope: tuple = ()) -> DataFrame:
    """The roll-up that the trends follow from: per snapshot date ``plays`` and exact ``minutes_x``.

    A sum of a week's or month's day sums is the sum over its rows, also where minutes are unknown."""
    return _played_fact(fact).groupBy(*scope, SNAPSHOT).agg(
        F.sum(positive(DELTA)).cast("long").alias("plays"),
        F.sum(positive_weighted(DELTA, "duration_min")).alias("minutes_x"))


def is_totals(df: DataFrame) -> bool:
    return "n_first" in df.columns


def track_totals(fact: DataFrame, by: tuple = (), all_rows: bool = False,
                 scope: tuple = ()) -> DataFrame:
    """Per track (and ``by``, which is empty or ``("year",)``): ``plays``, exact ``minutes_x`` using
    the fact's duration, and ``n_else`` (rows with no positive delta). ``fact`` may be
    ``year_totals`` of a fact. Without ``all_rows`` first sightings are left out."""
    if not is_totals(fact) and not by:
        f = fact if all_rows else _played_fact(fact)
        return positive_rollup(f, [*scope, ENTITY], DELTA, weight="duration_min")
    t = fact if is_totals(fact) else year_totals(fact, scope)
    if not all_rows:
        t = t.where(F.col("n_pos") + F.col("n_zero") > 0)
    if not by:
        t = t.groupBy(*scope, ENTITY).agg(*[F.sum(c).alias(c) for c in (
            "plays", "minutes_x", "n_zero", "n_first")])
    zero = F.col("n_zero") + (F.col("n_first") if all_rows else F.lit(0))
    # a row of the zero branch makes a sum of unknown minutes 0
    minutes = F.when(zero > 0, F.coalesce("minutes_x", F.lit(0).cast(EXACT))).otherwise(F.col("minutes_x"))
    return t.select(*scope, ENTITY, *by, "plays", minutes.alias("minutes_x"), zero.alias("n_else"))


def _minutes(c: Column) -> Column:
    """Exact minutes to a double rounded to whole minutes."""
    return round_half_away(c.cast("double"), 0)


def _rank(df: DataFrame, partition=(), max_rank=None, method="histogram") -> DataFrame:
    return competition_rank(df, "play_count", partition=list(partition),
                            where=F.col("play_count") > 0, max_rank=max_rank, method=method)


def year_of(c) -> Column:
    return F.year(F.col(c) if isinstance(c, str) else c).cast("int")


# ---------------------------------------------------------------- all time

def summary(fact: DataFrame, dim: DataFrame, scope: tuple = ()) -> DataFrame:
    """One row (per scope): minutes, hours, plays, tracks/artists/albums played."""
    k = [*scope, ENTITY]
    t = track_totals(fact, scope=scope).join(dim.select(*k, "artist_name", "album_name"), k, "left")
    played = F.col("plays") > 0
    total = F.sum("minutes_x").cast("double")
    return t.groupBy(*scope).agg(
        total.alias("total_listening_minutes"),
        round_half_away(total / F.lit(60.0), 1).alias("total_listening_hours"),
        F.sum("plays").alias("total_plays"),
        F.count(F.when(played, F.col(ENTITY))).alias("unique_tracks_played"),
        distinct_count("artist_name", played).alias("unique_artists_played"),
        distinct_count("album_name", played).alias("unique_albums_played"),
    )


SONG_COLUMNS = ["title", "artist_name", "album_name", "duration_min", "play_count",
                "listening_minutes", "rank"]


def _songs(ranked: DataFrame, dim: DataFrame, scope: tuple) -> DataFrame:
    """Ranked per-track totals with the dimension's attributes; minutes by the dimension's
    duration. The key is the track, so equal titles stay apart."""
    k = [*scope, ENTITY]
    t = ranked.join(dim.select(*k, "title", "artist_name", "album_name", "duration_min"), k, "left")
    dur = F.col("duration_min")
    # sum(delta * D) over positive deltas == D * plays, exactly, in decimal;
    # a NULL duration gives NULL unless some row took the zero branch
    minutes = (F.when(dur.isNull(), F.when(F.col("n_else") > 0, F.lit(0).cast(EXACT)))
               .otherwise(exact(dur) * F.col("play_count")))
    return t.withColumn("listening_minutes", _minutes(minutes)).select(*scope, *SONG_COLUMNS)


def _song_totals(fact: DataFrame, scope: tuple) -> DataFrame:
    return track_totals(fact, scope=scope).withColumnRenamed("plays", "play_count")


def top_songs(fact: DataFrame, dim: DataFrame, method: str = "histogram",
              scope: tuple = ()) -> DataFrame:
    """Ranked songs with plays > 0. Totals are ranked first, then get their attributes."""
    return _songs(_rank(_song_totals(fact, scope), partition=scope, method=method), dim, scope)


def top_songs_limit(fact: DataFrame, dim: DataFrame, n: int = 20, scope: tuple = ()) -> DataFrame:
    """O2: first ``n`` songs by rank (per scope); ties at the cut broken by track id.

    The cut is by plays, which is the order of the rank, so only ``n`` rows are ranked
    (every song with more plays is among them) and joined to the dimension."""
    t = _song_totals(fact, scope).where("play_count > 0")
    order = [F.col("play_count").desc(), F.col(ENTITY)]
    if scope:
        w = Window.partitionBy(*scope).orderBy(*order)
        t = t.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
    else:
        t = first_n(t, n, order)
    return _songs(_rank(t, partition=scope, method="window"), dim, scope)


def _group_plays(fact: DataFrame, dim: DataFrame, key_cols: list, require: list,
                 by: tuple = (), all_rows: bool = False, unique_tracks: bool = True,
                 scope: tuple = ()) -> DataFrame:
    """Per-track totals joined to the dimension and grouped by ``key_cols``.

    Minutes use the fact's duration (as of each snapshot)."""
    k = [*scope, ENTITY]
    d = dim.select(*k, *[c for c in ("artist_name", "album_artist_name", "album_name",
                                     "genre", "title") if c in dim.columns])
    for r in require:
        d = d.filter(F.col(r).isNotNull())
    t = track_totals(fact, by=by, all_rows=all_rows, scope=scope).join(d, k, "inner")
    aggs = [F.sum("plays").alias("play_count"), F.sum("minutes_x").alias("mx")]
    if unique_tracks:
        aggs.append(F.count(F.lit(1)).alias("unique_tracks"))  # one row per track
    g = t.groupBy(*scope, *by, *key_cols).agg(*aggs)
    return g.withColumn("listening_minutes", _minutes(F.col("mx"))).drop("mx")


def top_artists(fact: DataFrame, dim: DataFrame, method: str = "histogram",
                max_rank: int | None = None, scope: tuple = ()) -> DataFrame:
    """Ranked artists (latest-state artist; NULL artist left out)."""
    g = _group_plays(fact, dim, [F.col("artist_name")], ["artist_name"], scope=scope)
    return _rank(g, partition=scope, max_rank=max_rank, method=method).select(
        *scope, "artist_name", "play_count", "listening_minutes", "unique_tracks", "rank")


def top_albums(fact: DataFrame, dim: DataFrame, method: str = "histogram",
               scope: tuple = ()) -> DataFrame:
    """Ranked albums keyed by (album, album artist else artist)."""
    key = [F.col("album_name"),
           F.coalesce(F.col("album_artist_name"), F.col("artist_name")).alias("artist_name")]
    g = _group_plays(fact, dim, key, ["album_name"], scope=scope)
    return _rank(g, partition=scope, method=method).select(
        *scope, "album_name", "artist_name", "play_count", "listening_minutes", "unique_tracks",
        "rank")


def top_genres(fact: DataFrame, dim: DataFrame, scope: tuple = ()) -> DataFrame:
    """Ranked genres, as top artists with genre as key."""
    g = _group_plays(fact, dim, [F.col("genre")], ["genre"], scope=scope)
    return _rank(g, partition=scope).select(
        *scope, "genre", "play_count", "listening_minutes", "unique_tracks", "rank")


# ------------------------------------------------------------------ yearly
# A year is that of the later snapshot of a delta. First sightings are kept
# (their delta counts as 0), so a year of first sightings still has a row.

def yearly_summary(fact: DataFrame, dim: DataFrame, scope: tuple = ()) -> DataFrame:
    """Per year: minutes, hours, plays, tracks and artists played."""
    k = [*scope, ENTITY]
    t = (track_totals(fact, by=("year",), all_rows=True, scope=scope)
         .join(dim.select(*k, "artist_name"), k, "left"))
    played = F.col("plays") > 0
    total = F.sum("minutes_x").cast("double")
    return t.groupBy(*scope, "year").agg(
        total.alias("total_listening_minutes"),
        round_half_away(total / F.lit(60.0), 1).alias("total_listening_hours"),
        F.sum("plays").alias("total_plays"),
        F.count(F.when(played, F.col(ENTITY))).alias("unique_tracks_played"),
        distinct_count("artist_name", played).alias("unique_artists_played"),
    )


def yearly_top_artists(fact: DataFrame, dim: DataFrame, max_rank: int | None = None,
                       scope: tuple = ()) -> DataFrame:
    """Y2: artists ranked within each year."""
    g = _group_plays(fact, dim, [F.col("artist_name")], ["artist_name"],
                     by=("year",), all_rows=True, unique_tracks=False, scope=scope)
    return _rank(g, partition=[*scope, "year"], max_rank=max_rank).select(
        *scope, "year", "artist_name", "play_count", "listening_minutes", "rank")


def yearly_top_songs(fact: DataFrame, dim: DataFrame, max_rank: int | None = None,
                     scope: tuple = ()) -> DataFrame:
    """Songs ranked within each year, keyed by (title, artist, album).

    Tracks sharing all three merge; minutes use the fact's duration."""
    key = [F.col("title"), F.col("artist_name"), F.col("album_name")]
    k = [*scope, ENTITY]
    d = dim.select(*k, "title", "artist_name", "album_name")
    t = track_totals(fact, by=("year",), all_rows=True, scope=scope).join(d, k, "left")
    g = (t.groupBy(*scope, "year", *key)
         .agg(F.sum("plays").alias("play_count"), F.sum("minutes_x").alias("mx"))
         .withColumn("listening_minutes", _minutes(F.col("mx"))).drop("mx"))
    return _rank(g, partition=[*scope, "year"], max_rank=max_rank).select(
        *scope, "year", "title", "artist_name", "album_name", "play_count", "listening_minutes",
        "rank")


def yearly_top_albums(fact: DataFrame, dim: DataFrame, max_rank: int | None = None,
                      scope: tuple = ()) -> DataFrame:
    """Albums ranked within each year."""
    key = [F.col("album_name"),
           F.coalesce(F.col("album_artist_name"), F.col("artist_name")).alias("artist_name")]
    g = _group_plays(fact, dim, key, ["album_name"], by=("year",),
                     all_rows=True, unique_tracks=False, scope=scope)
    return _rank(g, partition=[*scope, "year"], max_rank=max_rank).select(
        *scope, "year", "album_name", "artist_name", "play_count", "listening_minutes", "rank")


PAGE_COLUMNS = ["section", "rank", "title", "artist_name", "album_name", "play_count",
                "listening_minutes"]


def replay_page(fact: DataFrame, dim: DataFrame, year: int | None = None, k: int = 3,
                scope: tuple = ()) -> DataFrame:
    """Top ``k`` artists, songs and albums (ties kept, per scope) of one year.

    ``year=None`` takes the latest year that has plays (a scalar subquery).
    From a fact, rows are cut to the year by a date range, which reaches the scan (the
    deltas are already in the rows, so the cut sits above the LAG), and one (track, year)
    roll-up feeds the three rankings.
    """
    if is_totals(fact):
        played = fact.where("plays > 0").select(F.max("year"))
        y = F.lit(year) if year is not None else played.scalar()
        t = fact.where(F.col("year") == y)
    else:
        last = fact.where(F.col(DELTA) > 0).select(F.year(F.max(SNAPSHOT)))
        y = F.lit(year) if year is not None else last.scalar()
        t = year_totals(fact.where(F.col(SNAPSHOT).between(
            F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31)))), scope)
    none = F.lit(None).cast("string")
    a = yearly_top_artists(t, dim, max_rank=k, scope=scope).select(
        *scope, F.lit("artists").alias("section"), "rank", none.alias("title"),
        "artist_name", none.alias("album_name"), "play_count", "listening_minutes")
    s = yearly_top_songs(t, dim, max_rank=k, scope=scope).select(
        *scope, F.lit("songs").alias("section"), "rank", "title", "artist_name", "album_name",
        "play_count", "listening_minutes")
    b = yearly_top_albums(t, dim, max_rank=k, scope=scope).select(
        *scope, F.lit("albums").alias("section"), "rank", none.alias("title"),
        "artist_name", "album_name", "play_count", "listening_minutes")
    return a.unionByName(s).unionByName(b).select(*scope, *PAGE_COLUMNS)


# ------------------------------------------------------------------ trends

def _trend(fact: DataFrame, unit: str, name: str, scope: tuple) -> DataFrame:
    """``fact`` may be its ``day_totals``: a row per date, whatever the number of tracks."""
    days = fact if "minutes_x" in fact.columns else day_totals(fact, scope)
    period = F.date_trunc(unit, F.col(SNAPSHOT)).cast("date").alias(name)
    return (days.groupBy(*scope, period)
            .agg(F.sum("plays").cast("long").alias("plays"),
                 _minutes(F.sum("minutes_x")).alias("listening_minutes")))


def weekly_trend(fact: DataFrame, scope: tuple = ()) -> DataFrame:
    """Plays and minutes per week (Monday) of the later snapshot."""
    return _trend(fact, "week", "week", scope)


def monthly_trend(fact: DataFrame, scope: tuple = ()) -> DataFrame:
    """Plays and minutes per month of the later snapshot."""
    return _trend(fact, "month", "month", scope)


def hourly_listening(fact: DataFrame, entity: str = ENTITY, scope: tuple = ()) -> DataFrame:
    """Plays by hour of the last play time, for rows with a positive delta.

    A snapshot only knows the last play, so all plays of a delta land in the
    hour of that last play."""
    f = fact.filter(F.col(DELTA) > 0).filter(F.col("last_played_at_utc").isNotNull())
    return (f.groupBy(*scope, F.hour("last_played_at_utc").alias("hour"))
            .agg(F.sum(DELTA).cast("long").alias("plays"),
                 F.count_distinct(entity).alias("entities")))


# ------------------------------------------------------------- per snapshot

def library_overview(raw: DataFrame, scope: tuple = ()) -> DataFrame:
    """Per snapshot: item count and total plays."""
    return (raw.groupBy(*scope, "snapshot_date")
            .agg(F.count(F.lit(1)).alias("item_count"),
                 F.sum(F.coalesce(F.col("play_count"), F.lit(0))).cast("long").alias("total_plays")))


def snapshot_preview(raw: DataFrame, n: int = 10, scope: tuple = ()) -> DataFrame:
    """First ``n`` tracks (by id) of the latest snapshot (per scope); no artist -> 'Unknown'."""
    cols = ["track_id", F.col("name").alias("title"), F.coalesce(F.col("artist"), F.lit("Unknown")).alias("artist")]
    if not scope:
        latest = raw.select(F.max("snapshot_date")).scalar()
        return first_n(raw.filter(F.col("snapshot_date") == latest).select(*cols), n, [F.col("track_id")])
    latest = raw.groupBy(*scope).agg(F.max("snapshot_date").alias("snapshot_date"))
    rows = raw.join(latest, [*scope, "snapshot_date"], "left_semi").select(*scope, *cols)
    w = Window.partitionBy(*scope).orderBy("track_id")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
