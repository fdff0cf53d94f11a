"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each callable reads the driver's tables from ``sf_dir`` and returns the plan
raw -> silver -> fact / dimension -> report. Jobs that run before it returns:
the fact's hot-key sample (one small job), and the ingest / store queries'
writes of their input files and tables into the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hex_suffix_id
from ..operators.checks import grain_report, key_violations, null_violations
from ..operators.delta import counter_delta
from ..operators.rank import order_by_rank
from ..schema import GRAINS, RAW_COLUMNS
from ..session import materialise, scratch_path
from ..sources import backups, csvfile, plist, store
from ..sources.fixture import event_counters, load_fixture, load_library_fixture, load_line_tracks, read_table
from . import models as M
from . import reports as R


class Gold:
    """The layers of one run over the fixture of ``sf_dir``, built on first use."""

    scope: tuple = ()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _load(self) -> DataFrame:
        return load_fixture(self.spark, self.sf_dir)

    def _hot_from(self) -> DataFrame | None:
        return load_line_tracks(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return M.bronze(self._load(), scope=self.scope)

    @cached_property
    def silver(self) -> DataFrame:
        return M.silver(self.raw, scope=self.scope)

    @cached_property
    def fact(self) -> DataFrame:
        return M.fact(self.silver, scope=self.scope, hot_from=self._hot_from())

    @cached_property
    def dim(self) -> DataFrame:
        return M.dim_track(self.silver, scope=self.scope)


LIB = ("library_id",)


class LibraryGold(Gold):
    """Several libraries in one table: every layer keyed by ``library_id``."""

    scope = LIB

    def _load(self) -> DataFrame:
        return load_library_fixture(self.spark, self.sf_dir)

    def _hot_from(self) -> DataFrame | None:
        return None


def _libs(fn: Callable[[LibraryGold], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(LibraryGold(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _gold(fn: Callable[[Gold], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Gold(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = event_counters(read_table(spark, sf_dir, "events"))
    return counter_delta(c, ["user_id"], "snapshot_date", ["play_count"])


def _fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.bronze(load_fixture(spark, sf_dir))


def _folder(rows: DataFrame, pattern: str = r"/snapshot=([^/]+)/[^/]+$") -> DataFrame:
    """``snapshot_path`` cut to what the writer named the file's folder by."""
    return rows.withColumn("snapshot_path", F.regexp_extract("snapshot_path", pattern, 1))


def _plist_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture -> plist files (Spark text writer) -> plist source."""
    out = scratch_path(spark, "plist")
    plist.write_plist_snapshots(_fixture(spark, sf_dir), out, compression="members")
    return _folder(plist.plist_snapshots(spark, out, glob="part-*"))


def _plist_split_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 for large files: as ``plist_ingest``, with every file read by its splits."""
    out = scratch_path(spark, "plist-large")
    plist.write_plist_snapshots(_fixture(spark, sf_dir), out, compression="members")
    parsed = plist.read_plist_files(spark, out, glob="part-*", split_bytes=0)
    return _folder(plist.snapshot_rows(plist.split_errors(parsed)[0]))


def _plist_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first date's file has over 50,000 tracks and a bad number in the last one, the
    second date's is cut off, the others are good. Per file: rows given, and if it failed."""
    # read for its dates, its first date and its lines: computed once
    raw = materialise(_fixture(spark, sf_dir), "corrupt-raw")
    first, second = [r[0] for r in raw.select("snapshot_date").distinct().orderBy("snapshot_date").limit(2).collect()]
    copies = 50_000 // raw.filter(F.col("snapshot_date") == first).count() + 1
    many = F.when(F.col("snapshot_date") == first, F.sequence(F.lit(0), F.lit(copies))).otherwise(F.array(F.lit(0)))
    raw = raw.withColumn("_c", F.explode(many)).withColumn(
        "track_id", F.col("track_id") + F.col("_c") * F.lit(10_000_000).cast("long")).drop("_c")
    lines = plist.plist_lines(raw)
    big = F.col("snapshot") == str(first)
    last = lines.filter(big).agg(F.max("_ord")).first()[0]
    lines = lines.filter((F.col("snapshot") != str(second)) | (F.col("_part") < 2)).withColumn(
        "value", F.when(big & (F.col("_ord") == last), F.replace("value", F.lit("<integer>"), F.lit("<integer>x")))
        .otherwise(F.col("value")))
    out = scratch_path(spark, "plist-corrupt")
    plist.write_plist_lines(lines, out, compression="members")
    parsed = plist.read_plist_files(spark, out, glob="part-*")
    return (parsed.groupBy(F.regexp_extract("path", r"/snapshot=([^/]+)/", 1).alias("snapshot"))
            .agg(F.count(F.when(F.col("parse_error").isNull(), 1)).alias("n_tracks"),
                 (F.count("parse_error") > 0).alias("failed")))


def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture -> CSV exports -> CSV source."""
    out = scratch_path(spark, "csv")
    csvfile.write_csv_snapshots(_fixture(spark, sf_dir), out, compression="gzip")
    return _folder(csvfile.csv_snapshots(spark, out))


def _csv_split_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 for large files: as ``csv_ingest`` with line breaks in titles, every file read by its splits."""
    out, raw = scratch_path(spark, "csv-large"), _fixture(spark, sf_dir)
    name = F.when(F.col("track_id") % 7 == 0, F.concat("name", F.lit('\nand "more", yes'))).otherwise(F.col("name"))
    csvfile.write_csv_snapshots(raw.withColumn("name", name), out)
    return _folder(csvfile.csv_snapshots(spark, out, split_bytes=0))


def _csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of odd months have their columns in reverse, no genre and one unknown column."""
    raw, out = _fixture(spark, sf_dir), scratch_path(spark, "csv-mixed")
    odd = F.month("snapshot_date") % 2 == 1
    csvfile.write_csv_snapshots(raw.filter(~odd), f"{out}/even", compression="gzip")
    rows = csvfile.export_rows(raw.filter(odd))
    lead = ["snapshot", "_ord"]
    back = [c for c in reversed(rows.columns) if c not in (*lead, "genre")]
    csvfile.write_export_rows(rows.select(*lead, *back[:3], F.lit("?").alias("unknown"), *back[3:]), f"{out}/odd",
                              compression="gzip")
    return _folder(csvfile.csv_snapshots(spark, out))


def _surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hex-suffix ids of ids, titles and corrupted ids."""
    raw = _fixture(spark, sf_dir)
    return raw.select(
        "snapshot_date", "track_id", "persistent_id",
        hex_suffix_id("persistent_id", F.lit(-1)).alias("id_from_pid"),
        hex_suffix_id("name", F.lit(-1)).alias("id_from_title"),
        hex_suffix_id(F.concat("persistent_id", F.lit("g")), F.lit(-1)).alias("id_from_bad"),
    )


def _upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed upsert of a re-export of the latest snapshot."""
    raw = _fixture(spark, sf_dir)
    return store.upsert(raw, store.bump_latest(raw))


def _replace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the fixture partitioned by date, replace the latest
    date with a smaller re-export, load an empty batch, read the table back."""
    path = scratch_path(spark, "raw")
    raw = _fixture(spark, sf_dir)
    store.replace_snapshot(raw, path)
    # the re-export is derived from the source rows, not from the table being
    # overwritten, so no job reads and replaces the same partition
    store.replace_snapshot(store.bump_latest(raw), path)
    store.replace_snapshot(raw.limit(0), path)
    return store.read_raw(spark, path)


def _upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 on the stored table: only the latest date's partition is merged and replaced."""
    path, raw = scratch_path(spark, "raw"), _fixture(spark, sf_dir)
    store.replace_snapshot(raw, path)
    store.upsert_table(spark, path, store.bump_latest(raw))
    return store.read_raw(spark, path)


def _library_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 with a scope: libraries are stored one after another over the same dates, then
    one date of library 1 is replaced; nothing of another library goes."""
    path = scratch_path(spark, "raw")
    # computed once and stored by library: a load reads its own rows, from files that stay
    raw = materialise(M.bronze(load_library_fixture(spark, sf_dir), scope=LIB), "library-raw", by=LIB)
    for lib in range(3):
        store.replace_snapshot(raw.filter(F.col("library_id") == lib), path, scope=LIB, stored=True)
    store.replace_snapshot(store.bump_latest(raw.filter(F.col("library_id") == 1)), path, scope=LIB)
    return store.read_raw(spark, path, LIB)


def _library_backups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S14 on files: three users' backup trees, two backups a day each; the earlier one of a
    day holds higher counters and must not count. Users stay apart."""
    raw = materialise(M.bronze(load_library_fixture(spark, sf_dir), scope=LIB), "backup-raw")
    root = scratch_path(spark, "backups")
    for time, rows in (("095001", raw), ("080000", raw.withColumn("play_count", F.col("play_count") + 1))):
        out = scratch_path(spark, "backup-files")
        plist.write_plist_snapshots(rows, out, scope=LIB, compression="members")
        backups.place_libraries(spark, out, root, time)
    rows, _ = backups.read_backup_tree(spark, root)
    return _folder(rows, r"/([^/]+)\.backup/[^/]+/Users/")


def _stream_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports per date in folders with spaces and signs, all with one modification time: the
    stream keeps each date's last by path."""
    from ..session import touch_files
    from ..streaming.ingest import snapshot_stream
    drop, table = scratch_path(spark, "drop folder"), scratch_path(spark, "raw")
    # a file position could equal another track's id: every track gets an id text
    raw = materialise(_fixture(spark, sf_dir).withColumn("persistent_id", F.coalesce(
        "persistent_id", F.lpad(F.col("track_id").cast("string"), 16, "0"))), "same-day-raw")
    csvfile.write_csv_snapshots(raw, f"{drop}/export 1+1", compression="gzip")
    csvfile.write_csv_snapshots(raw.withColumn("rating", F.lit(60)), f"{drop}/export 2%20", compression="gzip")
    touch_files(spark, drop, csvfile.GLOB, 1_700_000_000_000)
    q = snapshot_stream(spark, drop, table, "csv", checkpoint=scratch_path(spark, "stream"))
    q.awaitTermination()
    return _folder(store.read_raw(spark, table), r"/(export [^/]+)/")


def _by_year(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw rows and their ``_year``, computed once and stored by year: a load reads its years only.
    A year's rows are sorted by track, as the loads sort them."""
    raw = _fixture(spark, sf_dir).withColumn("_year", R.year_of("snapshot_date"))
    return materialise(raw.sortWithinPartitions("_year", "track_id", "snapshot_date"), name, by=("_year",))


def _incremental(spark: SparkSession, sf_dir: str):
    """Load the fixture in three batches: through 1999, 2000, 2001 and later."""
    from . import incremental as I
    root = scratch_path(spark, "incremental")
    # every load reads the raw rows again: cut their lineage once, in the shared folder
    raw = _by_year(spark, sf_dir, "incremental-raw")
    year = F.col("_year")
    I.init(spark, raw.filter(year <= 1999), root)
    I.append(spark, raw.filter(year == 2000), root)
    I.append(spark, raw.filter(year >= 2001), root)
    return I.open_incremental(spark, root)


def _incremental_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every year but 1998, then 1998 arrives late and is repaired in."""
    from . import incremental as I
    root = scratch_path(spark, "incremental-repair")
    raw = _by_year(spark, sf_dir, "repair-raw")
    year = F.col("_year")
    I.init(spark, raw.filter(year != 1998), root)
    I.repair(spark, raw, raw.filter(year == 1998), root)
    return I.open_incremental(spark, root).fact


def _incremental_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repair and an append die before they are published, later loads run, the repair is
    run again: the fact is that of a full rebuild."""
    from . import incremental as I
    root = scratch_path(spark, "incremental-retry")
    raw = _by_year(spark, sf_dir, "retry-raw")
    year = F.col("_year")
    late = raw.filter(year == 1998)
    I.init(spark, raw.filter((year < 2000) & (year != 1998)), root)
    I.repair(spark, raw.filter(year < 2000), late, root, publish=False)
    I.append(spark, raw.filter(year == 2000), root)
    I.append(spark, raw.filter(year == 2001), root, publish=False)
    I.append(spark, raw.filter(year >= 2001), root)
    I.repair(spark, raw, late, root)
    I.expire(spark, root, keep=1)
    return I.open_incremental(spark, root).fact


def _kept(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """What is kept beside the fact after a first load, an append, a late year and another append."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from . import incremental as I
        root = scratch_path(spark, "incremental-kept")
        raw = _by_year(spark, sf_dir, "kept-raw")
        year = F.col("_year")
        I.init(spark, raw.filter((year < 2000) & (year != 1998)), root)
        I.append(spark, raw.filter(year == 2000), root)
        I.repair(spark, raw.filter(year <= 2000), raw.filter(year == 1998), root)
        I.append(spark, raw.filter(year >= 2001), root)
        return fn(I.open_incremental(spark, root))
    run.__doc__ = fn.__doc__
    return run


def _append_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 at append: the latest date is added, then a batch whose keys are stored is refused and
    changes nothing."""
    from ..operators.checks import ContractViolation
    path, raw = scratch_path(spark, "raw"), _fixture(spark, sf_dir)
    latest = raw.agg(F.max("snapshot_date")).first()[0]
    store.append_snapshots(raw.filter(F.col("snapshot_date") < latest), path)
    store.append_snapshots(raw.filter(F.col("snapshot_date") == latest), path)
    try:
        store.append_snapshots(store.bump_latest(raw), path)
    except ContractViolation:
        return store.read_raw(spark, path)
    raise AssertionError("a stored key was appended")


def _backup_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 with a ledger: a day's early backups are loaded first, the later ones when they appear; a
    load that finds nothing new decodes nothing."""
    raw = materialise(M.bronze(load_library_fixture(spark, sf_dir), scope=LIB), "backup-raw")
    root, table, ledger = (scratch_path(spark, n) for n in ("backups", "raw", "ledger"))
    early = raw.withColumn("play_count", F.col("play_count") + 1)
    for time, rows in (("080000", early), ("095001", raw)):
        out = scratch_path(spark, "backup-files")
        plist.write_plist_snapshots(rows, out, scope=LIB, compression="members")
        backups.place_libraries(spark, out, root, time)
        backups.load_new_backups(spark, root, table, ledger)
    if backups.load_new_backups(spark, root, table, ledger):
        raise AssertionError("a known backup was decoded again")
    return _folder(store.read_raw(spark, table, ("user",)), r"/([^/]+)\.backup/[^/]+/Users/")


def _stored(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A report over the stored, bucketed warehouse."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .warehouse import build
        return fn(build(spark, materialise(_fixture(spark, sf_dir), "raw"), buckets=8))
    run.__doc__ = fn.__doc__
    return run


def _table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as a table and read back, twice (full refresh)."""
    g, path = Gold(spark, sf_dir), scratch_path(spark, "report")
    store.write_table(R.yearly_top_artists(g.fact, g.dim).limit(1), path, ["year"])
    return store.write_table(R.yearly_top_artists(g.fact, g.dim), path, ["year"]).select(
        "year", "artist_name", "play_count", "listening_minutes", "rank")


def _view_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as a view, read by SQL."""
    g = Gold(spark, sf_dir)
    store.as_view(R.top_genres(g.fact, g.dim), "snaptally_top_genres")
    return spark.sql("SELECT * FROM snaptally_top_genres")


def _backup_listing(spark: SparkSession, sf_dir: str):
    return backups.fixture_backup_listing(read_table(spark, sf_dir, "orders"),
                                          read_table(spark, sf_dir, "lineitem"))


def _pick_candidate_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse backup folder names, choose each backup's library file."""
    paths, _ = _backup_listing(spark, sf_dir)
    chosen = backups.pick_library_files(backups.parse_backup_paths(paths))
    return chosen.select("user", "backup_name", "backup_ts", "path")


def _daily_last_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, the latest backup whose library has rows."""
    paths, rows = _backup_listing(spark, sf_dir)
    chosen = backups.pick_library_files(backups.parse_backup_paths(paths))
    b = chosen.join(rows, ["user", "backup_name"], "inner")
    return (backups.latest_per_day(b, keys=("user",))
            .select("user", "snapshot_date", "backup_ts", "path", "n_tracks"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_library": _fixture,
    "silver_tracks": lambda s, d: M.silver(_fixture(s, d)),
    "dim_track": _gold(lambda g: g.dim),
    "fact_delta": _gold(lambda g: g.fact),
    "dim_artist": _gold(lambda g: M.dim_artist(g.dim)),
    "dim_album": _gold(lambda g: M.dim_album(g.dim)),
    "summary": _gold(lambda g: R.summary(g.fact, g.dim)),
    "top_songs": _gold(lambda g: R.top_songs(g.fact, g.dim)),
    "top_songs_limit": _gold(lambda g: R.top_songs_limit(g.fact, g.dim, 20)),
    "top_artists": _gold(lambda g: R.top_artists(g.fact, g.dim)),
    "top_artists_k": _gold(lambda g: R.top_artists(g.fact, g.dim, max_rank=10)),
    "top_albums": _gold(lambda g: R.top_albums(g.fact, g.dim)),
    "top_genres": _gold(lambda g: R.top_genres(g.fact, g.dim)),
    "yearly_summary": _gold(lambda g: R.yearly_summary(g.fact, g.dim)),
    "yearly_top_artists": _gold(lambda g: R.yearly_top_artists(g.fact, g.dim)),
    "yearly_top_songs": _gold(lambda g: R.yearly_top_songs(g.fact, g.dim)),
    "yearly_top_albums": _gold(lambda g: R.yearly_top_albums(g.fact, g.dim)),
    "replay_page": _gold(lambda g: R.replay_page(g.fact, g.dim)),
    "weekly_trend": _gold(lambda g: R.weekly_trend(g.fact)),
    "monthly_trend": _gold(lambda g: R.monthly_trend(g.fact)),
    "hourly_listening": lambda s, d: R.hourly_listening(_event_fact(s, d), entity="user_id"),
    "event_counter_delta": _event_fact,
    "library_overview": lambda s, d: R.library_overview(_fixture(s, d)),
    "snapshot_preview": lambda s, d: R.snapshot_preview(_fixture(s, d)),
    "key_violations": _gold(lambda g: key_violations(M.dim_album(g.dim), ["album_name"])),
    "null_violations": lambda s, d: null_violations(_fixture(s, d), RAW_COLUMNS),
    "top_songs_ordered": _gold(lambda g: order_by_rank(R.top_songs(g.fact, g.dim))),
    "stored_summary": _stored(lambda wh: R.summary(wh.plays, wh.dim)),
    "stored_top_songs": _stored(lambda wh: R.top_songs(wh.plays, wh.dim)),
    "stored_yearly_top_albums": _stored(lambda wh: R.yearly_top_albums(wh.plays, wh.dim)),
    "stored_replay_page": _stored(lambda wh: R.replay_page(wh.plays, wh.dim)),
    "table_sink": _table_sink,
    "view_sink": _view_sink,
    "plist_corrupt": _plist_corrupt,
    "csv_mixed_headers": _csv_mixed_headers,
    "upsert_table": _upsert_table,
    "library_replace_snapshot": _library_replace,
    "library_backup_load": _library_backups,
    "library_replay_page": _libs(lambda g: R.replay_page(g.fact, g.dim, scope=LIB)),
    "library_overview_scoped": _libs(lambda g: R.library_overview(g.raw, scope=LIB)),
    "stream_same_day": _stream_same_day,
    "incremental_retry": _incremental_retry,
    "incremental_totals": _kept(lambda wh: wh.totals.withColumn("minutes_x", F.col("minutes_x").cast("double"))),
    "incremental_top_songs": _kept(lambda wh: R.top_songs(wh.plays, wh.dim)),
    "incremental_yearly_summary": _kept(lambda wh: R.yearly_summary(wh.plays, wh.dim)),
    "incremental_monthly_trend": _kept(lambda wh: R.monthly_trend(wh.trends)),
    "stored_weekly_trend": _stored(lambda wh: R.weekly_trend(wh.trends)),
    "append_checked": _append_checked,
    "backup_ledger": _backup_ledger,
    "plist_ingest": _plist_ingest,
    "plist_split_ingest": _plist_split_ingest,
    "csv_ingest": _csv_ingest,
    "csv_split_ingest": _csv_split_ingest,
    "surrogate_id": _surrogate_id,
    "upsert_snapshot": _upsert_snapshot,
    "replace_snapshot": _replace_snapshot,
    "grain_violations": _gold(lambda g: grain_report(
        {"raw": g.raw, "silver": g.silver, "fact": g.fact, "dim_track": g.dim,
         "dim_artist": M.dim_artist(g.dim), "dim_album": M.dim_album(g.dim)}, GRAINS)),
    "library_summary": _libs(lambda g: R.summary(g.fact, g.dim, scope=LIB)),
    "library_top_artists": _libs(lambda g: R.top_artists(g.fact, g.dim, scope=LIB)),
    "library_top_songs": _libs(lambda g: R.top_songs(g.fact, g.dim, scope=LIB)),
    "library_yearly_top_albums": _libs(lambda g: R.yearly_top_albums(g.fact, g.dim, scope=LIB)),
    "incremental_fact": lambda s, d: _incremental(s, d).fact,
    "incremental_dim": lambda s, d: _incremental(s, d).dim,
    "incremental_repair_fact": _incremental_repair,
    "pick_candidate_path": _pick_candidate_path,
    "daily_last_backup": _daily_last_backup,
}
