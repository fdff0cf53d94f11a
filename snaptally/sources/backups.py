"""Backup-tree discovery.

A backup tree holds ``<name>.backup`` folders named ``YYYY-MM-DD-HHMMSS``,
either nested (``<name>.backup/<name>.backup/``) or flat, each with a
library file under one of several volumes and library paths. Everything
here works on a DataFrame of file paths, so the listing is distributed and
only file metadata (never content) is read to choose files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS
from ..session import child_files, materialise, scratch_path
from . import plist as P
from .store import replace_snapshot

# Volumes and library paths, in the order they are tried.
VOLUMES = ["Data", "Macintosh HD - Data", "Macintosh HD"]
LIBRARY_PATHS = [
    "Music/Music/Music Library.xml",
    "Music/iTunes/iTunes Music Library.xml",
    "Music/iTunes/iTunes Library.xml",
]
BACKUP_NAME_FORMAT = "yyyy-MM-dd-HHmmss"

_NAME = r"(\d{4}-\d{2}-\d{2}-\d{6})"
_VOL = "(" + "|".join(v.replace(" ", " ") for v in VOLUMES) + ")"
_LIB = "(" + "|".join(p.replace(".", r"\.") for p in LIBRARY_PATHS) + ")"
# <root>/<name>.backup/[<name>.backup/]<volume>/Users/<user>/<library>
BACKUP_PATH_PATTERN = (r"^(.*?)/" + _NAME + r"\.backup/(" + r"\2\.backup/)?" + _VOL
                       + r"/Users/([^/]+)/" + _LIB + "$")


def list_files(spark: SparkSession, root: str, glob: str = "*.xml") -> DataFrame:
    """``path, modified, size`` of every file under ``root`` matching ``glob``.

    Only metadata columns are selected, so no file content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")))


def parse_backup_paths(paths: DataFrame, user: str | None = None) -> DataFrame:
    """Keep paths that sit where a library file of a backup is expected.

    Adds ``backup_root, backup_name, backup_ts, nested, volume, user,
    library, priority``; a folder name that is not a valid timestamp drops
    the row (``try_to_timestamp``). Lower ``priority`` wins: nested before
    flat, then volume order, then library path order.
    """
    p = F.col("path")
    # the groups in one match: the root has no line break (``.``) and the user no slash
    parts = F.split(F.regexp_replace(p, BACKUP_PATH_PATTERN, "$1\n$2\n$3\n$4\n$6\n$5/"), "\n", 6)
    g = lambda i: F.get("_g", F.lit(i))
    vol_rank = F.array_position(F.array(*[F.lit(v) for v in VOLUMES]), F.col("volume"))
    lib_rank = F.array_position(F.array(*[F.lit(x) for x in LIBRARY_PATHS]), F.col("library"))
    out = paths.where(p.rlike(BACKUP_PATH_PATTERN)).withColumn("_g", parts).select(
        *paths.columns,
        g(0).alias("backup_root"),
        g(1).alias("backup_name"),
        F.try_to_timestamp(g(1), F.lit(BACKUP_NAME_FORMAT)).cast("timestamp_ntz").alias("backup_ts"),
        (F.length(g(2)) > 0).alias("nested"),
        g(3).alias("volume"),
        F.substring_index(g(5), "/", 1).alias("user"),
        g(4).alias("library"),
    ).filter(F.col("backup_ts").isNotNull())
    out = out.withColumn(
        "priority",
        (F.when(F.col("nested"), 0).otherwise(1) * 100 + vol_rank * 10 + lib_rank).cast("int"))
    if user is not None:
        out = out.filter(F.col("user") == user)
    return out


def pick_library_files(parsed: DataFrame) -> DataFrame:
    """One library file per backup (and user): the lowest priority.

    The priority names the place of the file, so the smallest one (a number: hash aggregated,
    partially before the shuffle) gives the path back."""
    best = parsed.groupBy("backup_root", "backup_name", "backup_ts", "user").agg(F.min("priority").alias("priority"))
    nested = F.col("priority") < 100
    place = F.col("priority") % 100
    volume = F.element_at(F.array(*[F.lit(v) for v in VOLUMES]), F.floor(place / 10).cast("int"))
    library = F.element_at(F.array(*[F.lit(x) for x in LIBRARY_PATHS]), (place % 10).cast("int"))
    folder = F.concat(F.col("backup_name"), F.lit(".backup/"))
    path = F.concat(F.col("backup_root"), F.lit("/"), folder, F.when(nested, folder).otherwise(F.lit("")),
                    volume, F.lit("/Users/"), F.col("user"), F.lit("/"), library)
    return best.select("backup_root", "backup_name", "backup_ts", "user", path.alias("path"), nested.alias("nested"),
                       volume.alias("volume"), library.alias("library"), "priority")


def latest_per_day(backups: DataFrame, ts: str = "backup_ts", rows: str = "n_tracks",
                   keys: tuple = ()) -> DataFrame:
    """Per day, the latest backup that has rows (same-day backups
    replace each other in time order; an empty one replaces nothing).

    Input has one row per backup, so the per-day window is small."""
    have = backups.filter(F.col(rows) > 0).withColumn("snapshot_date", F.col(ts).cast("date"))
    w = Window.partitionBy(*keys, "snapshot_date").orderBy(F.col(ts).desc(), F.col("path").desc())
    return have.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


BATCH_FILES = 5_000


def read_backup_tree(spark: SparkSession, root: str, user: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw snapshot rows from a backup tree (S3 + S15 + S1 + S14), and ``path, parse_error`` of
    the library files that gave none.

    The snapshot date comes from the backup folder name; the path of the
    chosen library file is the snapshot path. With ``user`` the rows are that
    user's; without, they lead with a ``user`` column, the scope of a table of
    many users (a user's backups never replace another's).

    Only the chosen files' content is read: their paths (metadata only) go to the
    ``binaryFile`` reader ``BATCH_FILES`` at a time, so the driver holds one batch,
    and each file is decoded once, into a stored table. ``load_new_backups`` decodes
    only what an earlier load has not.
    """
    chosen = materialise(pick_library_files(parse_backup_paths(list_files(spark, root), user))
                         .select("path", "backup_ts", "user"), "backup-files")
    ok, errors = P.split_errors(_decode(spark, chosen))
    per_backup = ok.groupBy("path").agg(F.count(F.lit(1)).alias("n_tracks")).join(chosen, "path")
    # stored, so that its size is known: the rows meet it where they are read
    keep = materialise(latest_per_day(per_backup, keys=("user",)).select("path", "backup_ts", "user"), "backup-keep")
    lead = [] if user is not None else ["user"]
    return _snapshot_rows(ok, keep, lead), errors


def _decode(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """The parsed rows of the chosen files, each decoded once, ``BATCH_FILES`` paths at a time. Stored."""
    out, batch = scratch_path(spark, "backup-rows"), []

    def decode():
        P.read_plist_files(spark, batch, glob=None, recursive=False).write.mode("append").option("compression", "zstd").parquet(out)
        batch.clear()
    spark.createDataFrame([], P.PARSED_SCHEMA).write.mode("append").parquet(out)
    for r in chosen.select("path").toLocalIterator():
        batch.append(r.path)
        if len(batch) >= BATCH_FILES:
            decode()
    if batch:
        decode()
    return spark.read.schema(P.PARSED_SCHEMA).parquet(out)


def _snapshot_rows(ok: DataFrame, keep: DataFrame, lead: list[str]) -> DataFrame:
    rows = ok.join(keep, "path").select(
        *lead, F.col("backup_ts").cast("date").alias("snapshot_date"), F.col("path").alias("snapshot_path"),
        *[F.col(c) for c in RAW_COLUMNS[2:]])
    return rows.select(*lead, *RAW_COLUMNS)


LEDGER_SCHEMA = ("path string, modified timestamp, size long, user string, backup_ts timestamp_ntz, "
                 "n_tracks long, parse_error string, loaded_at timestamp")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What has been decoded so far: one row per file and version of it, with its rows or its error."""
    if not child_files(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def load_new_backups(spark: SparkSession, root: str, table: str, ledger: str, user: str | None = None) -> int:
    """S14 again and again: load what a backup tree has gained since the last load; returns the files decoded.

    A library file is known by its path, time and size: known ones are taken out by an anti-join
    before any content is read. Of a day's backups the latest that has rows counts, so a new file
    replaces a day only if no known backup of that user and day with rows is later. The table
    (scope: ``user``) is written before the ledger: a load that fails between them is done again,
    to the same rows. Files that went from the tree stay loaded."""
    files = materialise(list_files(spark, root), "backup-list")
    known = read_ledger(spark, ledger)
    chosen = pick_library_files(parse_backup_paths(files, user)).select("path", "backup_ts", "user").join(files, "path")
    new = materialise(chosen.join(known, ["path", "modified", "size"], "left_anti"), "backup-new")
    n = new.count()
    if not n:
        return 0
    ok, errors = P.split_errors(_decode(spark, new))
    counts = ok.groupBy("path").agg(F.count(F.lit(1)).alias("n_tracks"))
    entries = materialise(new.join(counts, "path", "left").join(errors.select("path", "parse_error"), "path", "left").select(
        "path", "modified", "size", "user", "backup_ts", F.coalesce("n_tracks", F.lit(0)).cast("long").alias("n_tracks"),
        "parse_error", F.current_timestamp().alias("loaded_at")), "backup-entries")
    # a file that changed counts as it is now
    before = known.join(entries.select("path"), "path", "left_anti").select("path", "user", "backup_ts", "n_tracks")
    both = before.withColumn("_new", F.lit(False)).unionByName(
        entries.select("path", "user", "backup_ts", "n_tracks").withColumn("_new", F.lit(True)))
    keep = materialise(latest_per_day(both, keys=("user",)).where("_new").select("path", "backup_ts", "user"), "backup-keep")
    replace_snapshot(_snapshot_rows(ok, keep, ["user"]), table, scope=("user",))
    entries.write.mode("append").parquet(ledger)
    return n


def place_libraries(spark: SparkSession, written: str, root: str, time: str) -> None:
    """Move plist libraries written per ``library_id`` and date into a backup tree under
    ``root``: user ``u<library_id>``, backup ``<date>-<time>`` (one rename per library file)."""
    from ..session import rename_file
    pattern = r"/library_id=([^/]+)/snapshot=([^/]+)/part-[^/]+$"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(written).select("path", F.regexp_extract("path", pattern, 1).alias("lib"),
                                                         F.regexp_extract("path", pattern, 2).alias("day"))
    for f in files.toLocalIterator():
        name = f"{f.day}-{time}.backup"
        rename_file(spark, f.path, f"{root}/{name}/{name}/{VOLUMES[0]}/Users/u{f.lib}/{LIBRARY_PATHS[0]}")


def fixture_backup_listing(orders: DataFrame, lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A backup tree listing derived from the driver tables.

    Customers own libraries, orders are backups: the backup day is the
    Monday of the order's week (so a customer's orders of one week are
    same-day backups) and the time is ``o_orderkey % 86400`` seconds. Each
    backup gets some of the 18 candidate library paths; every 17th order has
    an invalid folder name. Returns ``(paths, backup_rows)``: the file
    listing, and per (user, backup name) the number of rows its library
    would hold (order lines; 0 for orders with status 'F').
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    d = F.col("o_orderdate").cast("date")
    monday = F.date_sub(d, (F.dayofweek(d) + 5) % 7)
    ts = monday.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    key = F.col("o_orderkey")
    name = (F.when(key % 17 == 0, F.date_format(ts, "yyyy-'13'-dd-HHmmss"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd-HHmmss")))
    user = F.concat(F.lit("u"), F.col("o_custkey").cast("string"))
    named = o.select("o_orderkey", "o_orderstatus", name.alias("name"), user.alias("user"))
    combos = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(lb).alias("l"), F.lit(n).alias("n"))
                       for v in range(3) for lb in range(3) for n in range(2)])
    # which candidates a backup has depends on its key's rest by 4: a folder's rests are told apart
    # before the candidates are made, which then are distinct
    rest = F.pmod(key, F.lit(4))
    c = (named.select("name", "user", rest.alias("rest")).where("name IS NOT NULL AND user IS NOT NULL").distinct()
         .select("*", F.explode(combos).alias("c"))
         .filter((F.col("rest") + 5 * F.col("c.v") + 3 * F.col("c.l") + 7 * F.col("c.n")) % 4 == 0))
    vol = F.element_at(F.array(*[F.lit(v) for v in VOLUMES]), F.col("c.v") + 1)
    lib = F.element_at(F.array(*[F.lit(x) for x in LIBRARY_PATHS]), F.col("c.l") + 1)
    nm = F.col("name")
    path = F.concat(F.lit("/tm/"), nm, F.lit(".backup/"),
                    F.when(F.col("c.n") == 1, F.concat(nm, F.lit(".backup/"))).otherwise(F.lit("")),
                    vol, F.lit("/Users/"), F.col("user"), F.lit("/"), lib)
    paths = c.select(path.alias("path"))
    lines = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    rows = (named.join(lines, named["o_orderkey"] == lines["l_orderkey"], "left")
            .groupBy("user", F.col("name").alias("backup_name"))
            .agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.lit(0))
                       .otherwise(F.coalesce(F.col("n_lines"), F.lit(0)))).alias("n_tracks")))
    return paths, rows
