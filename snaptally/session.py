"""Spark session settings and the shared scratch folder.

Every job here is written against these settings: UTC session zone,
TIMESTAMP_NTZ as the default timestamp type, ANSI arithmetic, AQE with
skew-join splitting, dynamic partition overwrite for snapshot replacement.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, total_cores: int, target_mb: int = 128,
                max_partitions: int = 200_000) -> dict:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Scan splits of ``target_mb`` and an initial shuffle partition count
    that gives about ``target_mb`` per partition (never below 2 per core),
    which AQE then coalesces where stages turn out smaller: partitions stay
    far below executor memory, so sorts and aggregations spill rarely and
    a lost task is cheap to redo. The bound keeps per-shuffle bookkeeping on
    the driver manageable (it still allows ~25 TB per shuffle at 128 MB).
    """
    n = max(2 * total_cores, -(-input_bytes // (target_mb * MB)))
    n = min(n, max_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_mb}m",
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_mb}m",
    }


def build_session(master: str | None = None, app_name: str = "snaptally",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, input_bytes: int | None = None,
                  total_cores: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    With ``input_bytes`` (and ``total_cores``, default: local cores) the
    shuffle and scan sizes come from ``sizing_conf``."""
    b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    if input_bytes:
        conf.update(sizing_conf(input_bytes, total_cores or os.cpu_count() or 8))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


# What a query needs from a session it did not create: UTC for the few
# zone-dependent conversions (file times), ANSI arithmetic, and generated code in methods that
# the JVM compiles (longer ones it interprets). Everything
# else is typed explicitly (TIMESTAMP_NTZ casts) or passed per writer
# (dynamic partition overwrite), so the caller's other settings stay as set.
QUERY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_conf(spark: SparkSession) -> None:
    """Apply the settings the queries rely on to an existing session and ship the package.

    Results depend on these settings, so a session that refuses one is an error."""
    for k, v in QUERY_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python
    workers import it wherever the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_snaptally_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="snaptally-code-"), "snaptally.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("snaptally", os.path.relpath(full, top)))
    sc.addPyFile(out)
    sc._snaptally_shipped = True


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this package's own (a superseded load) from any file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _listing(spark: SparkSession, path: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.listStatus(p)) if fs.exists(p) else []


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (one listing); none if it is not there."""
    return sorted(f.getPath().getName() for f in _listing(spark, path) if f.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files in ``path``; none if it is not there."""
    names = (f.getPath().getName() for f in _listing(spark, path) if f.isFile())
    return sorted(n for n in names if n[0] not in "_.")


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """The first bytes of one file, up to ``n``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        got = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in got if b >= 0)


def rename_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file on its own file system, making the target's folders."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")


def touch_files(spark: SparkSession, folder: str, glob: str, millis: int) -> None:
    """Set the modification time of the files under ``folder`` that match ``glob``."""
    jvm = spark.sparkContext._jvm
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", glob).load(folder).select("path")
    for f in files.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(f.path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(p, millis, -1)


def materialise(df: DataFrame, name: str, by: tuple = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps reread the rows
    and not the plan, and the optimizer knows their size. They are packed by zstd, as they only pass through. ``by``: columns of few values to part
    the files by, so that a step reading some of the values opens no other file."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for materialised tables and lineage cuts.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one (tests, the
    bench) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared folder")
        d = tempfile.mkdtemp(prefix="snaptally-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
