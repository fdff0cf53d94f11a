"""Snapshot table storage.

The raw table is Parquet partitioned by the scope columns (e.g. the library or
the user) and ``snapshot_date``. Loading a snapshot replaces exactly the
(scope, date) pairs present in the new rows (dynamic partition overwrite):
others are untouched, an empty load touches nothing, and a failed job leaves
the old partition in place.

A load is staged: the rows are computed once and written to the shared folder,
checked there with one aggregate, then published from there, dealt by partition: a small
partition is one file, a large one is split over tasks by its bytes (``by_partition``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import ContractViolation, assert_contract
from ..schema import RAW_COLUMNS, RAW_KEY, RAW_NOT_NULL, RAW_SCHEMA
from ..session import child_folders, materialise

PARTITION = "snapshot_date"


def scoped_schema(df: DataFrame, scope: Sequence[str]) -> T.StructType:
    """The contract schema led by the scope columns as ``df`` has them."""
    return T.StructType([*[df.schema[c] for c in scope], *RAW_SCHEMA.fields])


def read_raw(spark: SparkSession, path: str, scope: Sequence[str] = ()) -> DataFrame:
    """The raw table, typed by the contract schema (scope columns as stored)."""
    if not scope:
        return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_COLUMNS)
    stored = spark.read.parquet(path)
    return spark.read.schema(scoped_schema(stored, scope)).parquet(path).select(*scope, *RAW_COLUMNS)


def stage(df: DataFrame, scope: Sequence[str] = (), check: bool = True, stored: bool = False) -> DataFrame:
    """The rows of one load, computed once, stored in the shared folder and checked there.

    ``stored``: they are a plain read of files that stay while the load runs, and not copied."""
    staged = df.select(*scope, *RAW_COLUMNS)
    if not stored:
        staged = materialise(staged, "load")
    if check:
        assert_contract(staged, [*scope, *RAW_KEY], [*scope, *RAW_NOT_NULL], name="snapshot")
    return staged


def sized(stored: DataFrame, parts: Sequence[str], spread: Sequence[str], rows_per_file: int) -> DataFrame:
    """Stored rows dealt so that a partition's files hold about ``rows_per_file`` rows each: a
    hot partition is many shuffle partitions (by a hash of ``spread``), a small one is one file."""
    files = stored.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    salt = F.pmod(F.xxhash64(*spread), F.col("_files"))
    return (stored.join(files, list(parts)).withColumn("_salt", salt)
            .repartition(*parts, "_salt").select(*stored.columns))


def by_partition(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows dealt by partition for writing: small partitions are one file, and AQE splits one
    beyond spark.sql.adaptive.advisoryPartitionSizeInBytes over tasks, by the shuffle's own sizes."""
    return df.hint("rebalance", *[F.col(c) for c in parts])


def publish(staged: DataFrame, path: str, scope: Sequence[str] = (), mode: str = "overwrite",
            rows_per_file: int | None = None) -> None:
    """Write staged rows into the table, replacing (or, with ``append``, adding) their partitions.

    Files are sized by bytes in the same shuffle, or by ``rows_per_file`` at the cost of a count."""
    parts = [*scope, PARTITION]
    dealt = (sized(staged, parts, ["track_id", "persistent_id"], rows_per_file) if rows_per_file
             else by_partition(staged, parts))
    (dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def replace_snapshot(df: DataFrame, path: str, check: bool = True, scope: Sequence[str] = (),
                     stored: bool = False) -> DataFrame:
    """S5 + S12: replace only the (scope, date) pairs that ``df`` holds; returns the staged rows.

    With ``check`` the staged rows are validated first (D1 key, D2 NOT NULL). ``stored`` as for ``stage``.
    """
    staged = stage(df, scope, check, stored)
    publish(staged, path, scope)
    return staged


def create_bucketed_raw(df: DataFrame, table: str, path: str, buckets: int,
                        scope: tuple = ()) -> DataFrame:
    """Store raw snapshots partitioned by date and, inside each date,
    bucketed and sorted by track (``persistent_id``, after any scope).

    A bucketed read hands each task one bucket of every date, already
    clustered by track, so the fact's LAG and the latest-state window plan
    no exchange at all (tested). Rows are dealt by the bucket hash first, so
    there is one file per date and bucket; the table lives in the session
    catalog (register it in a shared metastore to reuse it).
    """
    key = [*scope, "persistent_id"]
    (df.select(*scope, *RAW_COLUMNS).repartition(buckets, *key).write.mode("overwrite").partitionBy(PARTITION)
     .bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def replace_snapshot_bucketed(df: DataFrame, table: str, buckets: int, scope: tuple = (),
                              check: bool = True) -> None:
    """S5 on a bucketed raw table: replace the dates ``df`` holds, keeping
    the table's bucketing (dynamic partition overwrite through insertInto).
    A date is replaced for all scopes, as scopes share a date's buckets."""
    staged = stage(df, scope, check)
    cols = df.sparkSession.table(table).columns  # insertInto matches by position
    (staged.repartition(buckets, *scope, "persistent_id").select(*cols).write
     .option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True))


def append_snapshots(df: DataFrame, path: str, scope: Sequence[str] = (), check: bool = True) -> None:
    """T1 + D1: add snapshots to the table; nothing is replaced, so no key may be there already.

    The staged rows are checked among themselves, then against the stored rows of their own dates
    (other partitions are not read). A stored key aborts the load before anything is written."""
    staged = stage(df, scope, check)
    spark = df.sparkSession
    if check and child_folders(spark, path):
        keys = [*scope, *RAW_KEY]
        dates = [r[0] for r in staged.select(PARTITION).distinct().collect()]  # bounded by the calendar
        stored = read_raw(spark, path, scope).where(F.col(PARTITION).isin(dates)).select(*keys)
        held = stored.join(staged.select(*keys), keys, "left_semi").limit(5).collect()
        if held:
            raise ContractViolation(f"snapshot: key {keys} is stored already: {held}")
    publish(staged, path, scope, mode="append")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] = tuple(RAW_KEY)) -> DataFrame:
    """Keyed replace, last write wins per key (lazy).

    Rows of ``old`` whose key is in ``new`` are dropped and ``new`` is added.
    Only the dates present in ``new`` can change; when ``old`` is the
    partitioned table, dynamic partition pruning limits the scan to them.
    """
    keys = list(keys)
    kept = old.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new.select(*old.columns))


def upsert_table(spark: SparkSession, path: str, new: DataFrame, scope: Sequence[str] = ()) -> None:
    """S6 on the stored table: merge the touched partitions, then replace them.

    The merged partitions are staged in the shared folder first, so the table is
    never read and overwritten by the same job.
    """
    new = stage(new, scope)
    old = read_raw(spark, path, scope)
    parts = [*scope, PARTITION]
    touched = old.join(new.select(*parts).distinct(), parts, "left_semi")
    publish(stage(upsert(touched, new, [*scope, *RAW_KEY]), scope, check=False), path, scope)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full-refresh table sink; returns the DataFrame reading it back."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A view, recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


def bump_latest(raw: DataFrame, every: int = 2, plus: int = 1) -> DataFrame:
    """A re-export of the latest snapshot derived from ``raw``: every
    ``every``-th track with its play counter raised by ``plus`` (used by the
    store queries and tests)."""
    latest = raw.select(F.max(PARTITION)).scalar()
    return (raw.filter((F.col(PARTITION) == latest) & (F.col("track_id") % every == 0))
            .withColumn("play_count", (F.col("play_count") + F.lit(plus)).cast("int"))
            .withColumn("snapshot_path", F.lit("re-export")))
