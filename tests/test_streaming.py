import os
import tempfile
import time

from snaptally.sources import store
from snaptally.streaming.ingest import snapshot_stream

HEAD = "snapshot_date,title,persistent_id,play_count\n"


def drop(d, name, date, plays):
    with open(os.path.join(d, name), "w") as f:
        f.write(HEAD + f"{date}T09:50:01Z,Song,0000000A,{plays}\n")


def test_stream_loads_new_snapshots_once(spark):
    src, table, ckpt = (tempfile.mkdtemp() for _ in range(3))
    drop(src, "a.csv", "2025-01-01", 1)
    drop(src, "b.csv", "2025-01-02", 3)
    q = snapshot_stream(spark, src, table + "/raw", checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted((r.snapshot_date.day, r.play_count) for r in store.read_raw(spark, table + "/raw").collect())
    assert got == [(1, 1), (2, 3)]
    time.sleep(1.1)
    drop(src, "c.csv", "2025-01-02", 5)  # a later export of the same day replaces it
    drop(src, "d.csv", "2025-01-03", 6)
    q = snapshot_stream(spark, src, table + "/raw", checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted((r.snapshot_date.day, r.play_count) for r in store.read_raw(spark, table + "/raw").collect())
    assert got == [(1, 1), (2, 5), (3, 6)]


def test_stream_keeps_incremental_warehouse(spark):
    from snaptally.plans import models as M
    from snaptally.plans.incremental import open_incremental
    src, table, ckpt, wh = (tempfile.mkdtemp() for _ in range(4))
    drop(src, "a.csv", "2025-01-01", 1)
    drop(src, "b.csv", "2025-01-03", 4)
    snapshot_stream(spark, src, table + "/raw", checkpoint=ckpt,
                    warehouse_root=wh).awaitTermination(120)
    time.sleep(1.1)
    drop(src, "c.csv", "2025-01-05", 9)   # later: incremental append
    drop(src, "d.csv", "2025-01-02", 2)   # late: rebuild from the raw table
    snapshot_stream(spark, src, table + "/raw", checkpoint=ckpt,
                    warehouse_root=wh).awaitTermination(120)
    w = open_incremental(spark, wh)
    got = sorted((r.snapshot_date.day, r.play_count_delta) for r in w.fact.collect())
    assert got == [(1, None), (2, 1), (3, 2), (5, 5)]
    full = M.fact(M.silver(store.read_raw(spark, table + "/raw")))
    assert sorted(map(tuple, full.select(*w.fact.columns).collect()), key=repr) == \
        sorted(map(tuple, w.fact.collect()), key=repr)


def test_same_day_ties_and_odd_names(spark):
    src, table, ckpt = (tempfile.mkdtemp(suffix=" a+b") for _ in range(3))
    for name, plays in (("one more.csv", 1), ("two%20.csv", 2), ("ü.csv", 3)):
        drop(src, name, "2025-01-01", plays)
        os.utime(os.path.join(src, name), (1_700_000_000, 1_700_000_000))
    snapshot_stream(spark, src, table + "/raw", checkpoint=ckpt, scope={"library_id": 4}).awaitTermination(120)
    got = [(r.library_id, r.play_count) for r in store.read_raw(spark, table + "/raw", ("library_id",)).collect()]
    assert got == [(4, 3)]


def test_rows_of_an_unlisted_file_fail(spark):
    import pytest

    from snaptally.streaming.ingest import UnknownFile, latest_file_per_date
    rows = spark.createDataFrame([("2025-01-01", "file:/x/a.csv", 1)], "snapshot_date string, snapshot_path string, n int")
    files = spark.createDataFrame([("file:/x/b.csv", 1)], "path string, modificationTime int")
    with pytest.raises(UnknownFile):
        latest_file_per_date(rows, files)


def test_bad_files_are_recorded(spark):
    src, table, ckpt, errors = (tempfile.mkdtemp() for _ in range(4))
    with open(f"{src}/bad.xml", "w") as f:
        f.write("<plist><dict>")
    snapshot_stream(spark, src, table + "/raw", fmt="plist", checkpoint=ckpt,
                    errors_path=errors + "/bad").awaitTermination(120)
    got = spark.read.parquet(errors + "/bad").collect()
    assert len(got) == 1 and got[0].path.endswith("bad.xml")
