"""Incremental snapshot loading with Structured Streaming.

Snapshots arrive over time as files in a drop folder. A file stream over
that folder lists new files (metadata only: the ``binaryFile`` content
column is never selected); each micro-batch hands its new paths (at most
``max_files``) to the batch reader of their format and replaces the dates
they hold in the raw table. Replacing dates is idempotent, so a batch
replayed after a failure gives the same table; the stream's checkpoint in
the shared folder records which files were loaded.

Several files of one date in a batch: the most recently modified one wins (the last
by path among equally old ones), as a later same-day load replaces an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import materialise, scratch_path
from ..sources import csvfile, plist, store

# the fixed schema of the binaryFile source (a stream needs it up front)
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# glob, and reader of (track rows, error rows) of a list of files
READERS = {
    "csv": (csvfile.GLOB, lambda spark, paths: (csvfile.csv_snapshots(spark, paths), None)),
    "plist": ("*.xml", lambda spark, paths: _plist(spark, paths)),
}


class UnknownFile(ValueError):
    """Rows name a file that the batch did not list."""


def _plist(spark: SparkSession, paths: list) -> tuple[DataFrame, DataFrame]:
    # decoded once; rows and errors are both read from the stored result
    parsed = materialise(plist.read_plist_files(spark, paths, glob=None), "plist-rows")
    ok, bad = plist.split_errors(parsed)
    return plist.snapshot_rows(ok), bad


def latest_file_per_date(rows: DataFrame, files: DataFrame, scope: tuple = ()) -> DataFrame:
    """Keep, per (scope and) snapshot date, the rows of the most recently modified file;
    of equally old ones the last by path.

    ``files`` has one row per input file (``path, modificationTime``)."""
    per_file = (rows.select(*scope, "snapshot_date", "snapshot_path").distinct()
                .join(files.select("path", "modificationTime"), F.col("snapshot_path") == F.col("path"), "left"))
    # one row per date: stored, so that its size is known and the rows meet it where they are read
    keep = materialise(per_file.groupBy(*scope, "snapshot_date").agg(
        F.max_by("snapshot_path", F.struct("modificationTime", "snapshot_path")).alias("snapshot_path"),
        F.count(F.when(F.col("path").isNull(), 1)).alias("_unknown")), "batch-keep")
    lost = keep.where("_unknown > 0").limit(3).collect()
    if lost:
        raise UnknownFile(f"rows of files that the batch does not list: {lost}")
    return rows.join(keep.drop("_unknown"), [*scope, "snapshot_date", "snapshot_path"], "left_semi")


def load_batch(spark: SparkSession, files: DataFrame, table_path: str, fmt: str,
               warehouse_root: str | None = None, scope: dict | None = None,
               errors_path: str | None = None) -> int:
    """Load one batch of new files into the raw table; returns the file count.

    The rows are decoded once and stored, cut to the last file per date, checked and
    published from there. Files that do not decode give no rows; they are added to
    ``errors_path`` (``path, parse_error, loaded_at``). ``scope``: constant scope columns
    of the drop folder, e.g. ``{"library_id": 3}``.
    With ``warehouse_root`` the fact and track state there are brought up to
    date too: appended when the batch is later than the state, else repaired
    (a late snapshot changes written deltas)."""
    paths = [r.path for r in files.select("path").collect()]  # bounded by max_files
    if not paths:
        return 0
    names = tuple(scope or {})
    rows, bad = READERS[fmt][1](spark, paths)
    rows = materialise(rows, "batch-rows").withColumns({k: F.lit(v) for k, v in (scope or {}).items()})
    if bad is not None and errors_path:
        bad.withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(errors_path)
    staged = store.replace_snapshot(latest_file_per_date(rows, files, names), table_path, scope=names)
    if warehouse_root is not None:
        from ..plans import incremental
        if not incremental.append(spark, staged, warehouse_root, scope=names):
            incremental.repair(spark, store.read_raw(spark, table_path, names), staged, warehouse_root, scope=names)
    return len(paths)


def snapshot_stream(spark: SparkSession, source_dir: str, table_path: str, fmt: str = "csv",
                    checkpoint: str | None = None, max_files: int = 64,
                    available_now: bool = True, warehouse_root: str | None = None,
                    scope: dict | None = None, errors_path: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    ``warehouse_root`` also keeps an incremental fact / track state there;
    ``scope`` and ``errors_path`` as for ``load_batch``."""
    glob, _ = READERS[fmt]
    listing = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
               .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", max_files)
               .load(source_dir).select("path", "modificationTime"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        load_batch(batch.sparkSession, batch, table_path, fmt, warehouse_root, scope, errors_path)

    w = (listing.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "snapshot-stream")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
