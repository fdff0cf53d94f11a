"""File sources: plist, CSV, backup tree; round trips and edge cases."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from snaptally.sources import backups as B
from snaptally.sources import csvfile, plist, store

PLIST = """<?xml version="1.0" encoding="UTF-8"?>
<plist version="1.0"><dict>
  <key>Date</key><date>{date}</date>
  <key>Tracks</key><dict>
    <key>101</key><dict>
      <key>Name</key><string>A &amp; B</string>
      <key>Total Time</key><integer>215000</integer>
      <key>Play Count</key><integer>{plays}</integer>
      <key>Play Date UTC</key><date>2025-01-02T21:15:00Z</date>
      <key>Persistent ID</key><string>A1B2C3D4E5F60718</string>
      <key>Loved</key><true/>
    </dict>
    <key>102</key><dict/>
  </dict>
</dict></plist>"""


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_plist_file_to_rows(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/lib.xml", PLIST.format(date="2025-01-03T09:50:01Z", plays=7))
    rows = {r.track_id: r for r in plist.plist_snapshots(spark, d).collect()}
    assert set(rows) == {101, 102}
    a = rows[101]
    assert (a.name, a.total_time, a.play_count, a.loved, a.persistent_id) == \
        ("A & B", 215000, 7, True, "A1B2C3D4E5F60718")
    assert a.snapshot_date == dt.date(2025, 1, 3)
    assert a.play_date_utc == dt.datetime(2025, 1, 2, 21, 15)
    b = rows[102]
    assert b.name is None and b.play_count is None and b.loved is None


def test_plist_without_date_uses_file_time(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/lib.xml", PLIST.replace("<key>Date</key><date>{date}</date>", "").format(plays=1))
    os.utime(f"{d}/lib.xml", (1736000000, 1736000000))  # 2025-01-04 UTC
    got = plist.plist_snapshots(spark, d).select("snapshot_date").distinct().collect()
    assert [r[0] for r in got] == [dt.date(2025, 1, 4)]


def test_corrupt_file_is_reported_and_skipped(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/good.xml", PLIST.format(date="2025-01-03T09:50:01Z", plays=7))
    write(f"{d}/bad.xml", "<plist><dict><key>Tracks</key><dict><key>1")
    ok, bad = plist.split_errors(plist.read_plist_files(spark, d))
    assert ok.count() == 2
    errs = bad.collect()
    assert len(errs) == 1 and errs[0].path.endswith("bad.xml")


def test_plist_round_trip_from_fixture(spark):
    from conftest import SF_SMALL
    from snaptally.schema import RAW_COLUMNS
    from snaptally.sources.fixture import load_fixture
    raw = load_fixture(spark, SF_SMALL)
    out = tempfile.mkdtemp() + "/p"
    plist.write_plist_snapshots(raw, out)
    back = plist.plist_snapshots(spark, out, glob="part-*")
    cols = [c for c in RAW_COLUMNS if c != "snapshot_path"]
    assert back.select(*cols).exceptAll(raw.select(*cols)).count() == 0
    assert raw.select(*cols).exceptAll(back.select(*cols)).count() == 0


CSV_HEAD = ("snapshot_date,title,persistent_id,artist,album,total_time,play_count,skip_count,"
            "last_played_date,loved,rating\n")


def test_csv_rules(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a.csv", CSV_HEAD
          + "2025-01-03T09:50:01Z,One,00000000000000FF,X,L,1000,3,,2025-01-03T09:50:01+09:00,TRUE,80\n"
          + ",,,,,,,,,,\n"
          + ',"Two, quoted",ZZZZZZZZ,,,, 4 ,1,,no,\n')
    rows = csvfile.csv_snapshots(spark, d).orderBy("track_id").collect()
    assert {r.snapshot_date for r in rows} == {dt.date(2025, 1, 3)}
    by_pos = {r.name: r for r in rows}
    one, blank, two = by_pos["One"], by_pos[""], by_pos["Two, quoted"]
    assert one.track_id == 255 and one.loved is True and one.skip_count == 0
    assert one.play_date_utc == dt.datetime(2025, 1, 3, 0, 50, 1)
    assert blank.track_id == 1 and blank.persistent_id == "" and blank.play_count == 0
    assert blank.artist is None and blank.loved is False
    assert two.track_id == 2 and two.play_count == 4 and two.loved is False


def test_csv_zone_is_utc_under_other_session_zone(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a.csv", CSV_HEAD + "2025-01-03T09:50:01Z,T,00000001,,,,1,,2025-01-03T09:50:01Z,,\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = csvfile.csv_snapshots(spark, d).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.play_date_utc == dt.datetime(2025, 1, 3, 9, 50, 1)


def test_csv_bad_integer_fails_like_source(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a.csv", CSV_HEAD + "2025-01-03T09:50:01Z,T,00000001,,,12.0,1,,,,\n")
    with pytest.raises(Exception):
        csvfile.csv_snapshots(spark, d).collect()


def test_csv_missing_snapshot_date_uses_now(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a.csv", CSV_HEAD + "not a date,T,00000001,,,,1,,,,\n")
    r = csvfile.csv_snapshots(spark, d).collect()[0]
    assert abs((r.snapshot_date - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_blank_csv_id_can_be_nulled(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a.csv", CSV_HEAD + "2025-01-03T09:50:01Z,T,,,,,1,,,,\n")
    assert csvfile.csv_snapshots(spark, d, blank_id="null").collect()[0].persistent_id is None


def lib(root, name, vol="Data", libpath=B.LIBRARY_PATHS[0], nested=True, user="u", plays=1,
        date="2025-01-03T09:50:01Z", empty=False):
    base = f"{root}/{name}.backup/" + (f"{name}.backup/" if nested else "")
    body = PLIST.format(date=date, plays=plays)
    if empty:
        body = '<plist version="1.0"><dict><key>Tracks</key><dict/></dict></plist>'
    write(f"{base}{vol}/Users/{user}/{libpath}", body)
    return f"{base}{vol}/Users/{user}/{libpath}"


def test_backup_path_precedence(spark):
    root = tempfile.mkdtemp()
    lib(root, "2025-01-03-095001", vol="Macintosh HD", libpath=B.LIBRARY_PATHS[0])
    best = lib(root, "2025-01-03-095001", vol="Data", libpath=B.LIBRARY_PATHS[2])
    lib(root, "2025-01-03-095001", vol="Data", libpath=B.LIBRARY_PATHS[1], nested=False)
    lib(root, "2025-13-03-095001", vol="Data")  # not a timestamp: skipped
    write(f"{root}/notes/x.xml", "<plist/>")
    picked = B.pick_library_files(B.parse_backup_paths(B.list_files(spark, root))).collect()
    assert len(picked) == 1 and picked[0].path.endswith(best[len(root):])


def test_backup_tree_same_day_and_empty(spark):
    root = tempfile.mkdtemp()
    lib(root, "2025-01-03-095001", plays=3)
    lib(root, "2025-01-03-180000", plays=5)           # later the same day: wins
    lib(root, "2025-01-03-230000", empty=True)        # empty: replaces nothing
    lib(root, "2025-01-04-080000", plays=6, nested=False)
    lib(root, "2025-01-05-080000", plays=9, user="other")
    rows = B.read_backup_tree(spark, root, user="u")[0].filter("track_id = 101").collect()
    got = sorted((r.snapshot_date, r.play_count) for r in rows)
    assert got == [(dt.date(2025, 1, 3), 5), (dt.date(2025, 1, 4), 6)]


def test_replace_is_idempotent_and_empty_load_keeps_table(spark):
    from conftest import raw_row
    from snaptally.schema import RAW_SCHEMA
    path = tempfile.mkdtemp() + "/raw"
    day1 = spark.createDataFrame([raw_row("2025-01-01", 1, "P1", 1), raw_row("2025-01-01", 2, "P2", 1)],
                                 RAW_SCHEMA)
    day2 = spark.createDataFrame([raw_row("2025-01-02", 1, "P1", 2)], RAW_SCHEMA)
    store.replace_snapshot(day1, path)
    store.replace_snapshot(day2, path)
    store.replace_snapshot(day2, path)
    assert store.read_raw(spark, path).count() == 3
    store.replace_snapshot(day1.limit(0), path)
    assert store.read_raw(spark, path).count() == 3
    smaller = spark.createDataFrame([raw_row("2025-01-01", 1, "P1", 4)], RAW_SCHEMA)
    store.replace_snapshot(smaller, path)
    got = sorted((r.snapshot_date.day, r.track_id, r.play_count) for r in store.read_raw(spark, path).collect())
    assert got == [(1, 1, 4), (2, 1, 2)]
    store.upsert_table(spark, path, spark.createDataFrame(
        [raw_row("2025-01-02", 1, "P1", 7), raw_row("2025-01-02", 3, "P3", 1)], RAW_SCHEMA))
    got = sorted((r.snapshot_date.day, r.track_id, r.play_count) for r in store.read_raw(spark, path).collect())
    assert got == [(1, 1, 4), (2, 1, 7), (2, 3, 1)]


def test_replace_rejects_duplicate_keys(spark):
    from conftest import raw_row
    from snaptally.operators.checks import ContractViolation
    from snaptally.schema import RAW_SCHEMA
    dup = spark.createDataFrame([raw_row("2025-01-01", 1, "P1", 1), raw_row("2025-01-01", 1, "P2", 1)],
                                RAW_SCHEMA)
    with pytest.raises(ContractViolation):
        store.replace_snapshot(dup, tempfile.mkdtemp() + "/raw")


def test_append_view_and_table_sinks(spark):
    from conftest import raw_row
    from snaptally.schema import RAW_SCHEMA
    root = tempfile.mkdtemp()
    d1 = spark.createDataFrame([raw_row("2025-01-01", 1, "P1", 1)], RAW_SCHEMA)
    d2 = spark.createDataFrame([raw_row("2025-01-02", 1, "P1", 2)], RAW_SCHEMA)
    store.append_snapshots(d1, root + "/raw")
    store.append_snapshots(d2, root + "/raw")
    raw = store.read_raw(spark, root + "/raw")
    assert raw.count() == 2
    v = store.as_view(raw.groupBy("track_id").count(), "snaptally_test_view")
    assert spark.table("snaptally_test_view").collect()[0]["count"] == 2 and v.count() == 1
    t = store.write_table(raw, root + "/copy", partition_by=["snapshot_date"])
    assert t.count() == 2


def test_plist_stream(spark):
    from snaptally.streaming.ingest import snapshot_stream
    src, table, ckpt = (tempfile.mkdtemp() for _ in range(3))
    write(f"{src}/a.xml", PLIST.format(date="2025-01-03T09:50:01Z", plays=7))
    write(f"{src}/b.xml", PLIST.format(date="2025-01-04T09:50:01Z", plays=9))
    snapshot_stream(spark, src, table + "/raw", fmt="plist", checkpoint=ckpt).awaitTermination(120)
    got = sorted((r.snapshot_date.day, r.play_count) for r in
                 store.read_raw(spark, table + "/raw").filter("track_id = 101").collect())
    assert got == [(3, 7), (4, 9)]


def test_writers_make_one_file_per_library_snapshot(spark):
    from conftest import SF_SMALL
    from snaptally.sources.fixture import load_library_fixture
    raw = load_library_fixture(spark, SF_SMALL)
    out = tempfile.mkdtemp()
    plist.write_plist_snapshots(raw, out + "/p", scope=("library_id",))
    csvfile.write_csv_snapshots(raw, out + "/c", scope=("library_id",))
    n = raw.select("library_id", "snapshot_date").distinct().count()
    for sub, ext in (("p", ".txt"), ("c", ".csv")):
        files = [f for _, _, fs in os.walk(f"{out}/{sub}") for f in fs if f.endswith(ext)]
        assert len(files) == n
    back = plist.plist_snapshots(spark, out + "/p", glob="part-*")
    assert back.count() == raw.count()


BAD = PLIST.replace("<integer>{plays}</integer>", "<integer>x{plays}</integer>")


def test_a_bad_file_gives_no_rows_at_any_size(spark, monkeypatch):
    d = tempfile.mkdtemp()
    track = "<key>{0}</key><dict><key>Play Count</key><integer>{1}</integer></dict>"
    for name, last in (("bad", "x1"), ("good", "1")):
        body = "".join(track.format(i, 1) for i in range(50_050)) + track.format(60_000, last)
        write(f"{d}/{name}.xml", f'<plist version="1.0"><dict><key>Tracks</key><dict>{body}</dict>'
                                 "<key>Date</key><date>2025-01-03T09:50:01Z</date></dict></plist>")
    write(f"{d}/late.xml", PLIST.replace("</dict></plist>", "<key>Date</key><date>no date</date></dict></plist>")
          .replace("<key>Date</key><date>{date}</date>", "").format(plays=1))
    ok, bad = plist.split_errors(plist.read_plist_files(spark, d))
    assert {(r.path.rsplit("/", 1)[1], r["count"]) for r in ok.groupBy("path").count().collect()} == {("good.xml", 50_051)}
    assert {r.path.rsplit("/", 1)[1] for r in bad.collect()} == {"bad.xml", "late.xml"}
    # the date stands after the tracks and still dates all of them
    assert plist.snapshot_rows(ok).select("snapshot_date").distinct().collect()[0][0] == dt.date(2025, 1, 3)


def test_playlists_are_not_kept_in_memory():
    import tracemalloc
    big = "<array>" + "<dict><key>Name</key><string>p</string></dict>" * 200_000 + "</array>"
    content = PLIST.format(date="2025-01-03T09:50:01Z", plays=1).replace(
        "<dict>\n  <key>Date", f"<dict><key>Playlists</key>{big}<key>Date", 1).encode()
    tracemalloc.start()
    n = sum(len(f) for f in plist._decode("p", content))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 and peak < len(content) + 20_000_000


def test_csv_files_with_headers_of_their_own(spark):
    d = tempfile.mkdtemp()
    write(f"{d}/a b+c%20.csv", "title,persistent_id,snapshot_date,play_count\nOne,0000000A,2025-01-03T09:50:01Z,3\n")
    write(f"{d}/z.csv", "﻿play_count,other,snapshot_date,title,persistent_id,genre\n"
                        '4,x,2025-01-04T09:50:01Z,"Two\nlines",0000000B,Rock\n5,x,,Three,,\n')
    rows = {r.name: r for r in csvfile.csv_snapshots(spark, d).collect()}
    assert {(r.snapshot_date.day, r.play_count, r.genre) for r in rows.values()} == {(3, 3, None), (4, 4, "Rock"), (4, 5, None)}
    assert rows["One"].snapshot_path.endswith("/a b+c%20.csv") and rows["One"].snapshot_path.startswith("file:/")
    assert rows["Three"].track_id == 1 and rows["Two\nlines"].track_id == 11


def test_wide_csv_files(spark):
    d = tempfile.mkdtemp()
    many = ",".join(f"x{i}" for i in range(60))
    write(f"{d}/a.csv", f"{many},title,persistent_id,snapshot_date,play_count\n{',' * 60}W,0000000A,2025-01-03T09:50:01Z,3\n")
    r = csvfile.csv_snapshots(spark, d).collect()
    assert [(x.name, x.play_count, x.snapshot_date.day) for x in r] == [("W", 3, 3)]


def test_backup_users_stay_apart(spark):
    root = tempfile.mkdtemp()
    lib(root, "2025-01-03-095001", plays=3, user="ann")
    lib(root, "2025-01-03-180000", plays=5, user="bob")
    lib(root, "2025-01-03-190000", plays=9, user="bob", date="x")  # does not decode: replaces nothing
    rows, errors = B.read_backup_tree(spark, root)
    got = sorted((r.user, r.snapshot_date.day, r.play_count) for r in rows.filter("track_id = 101").collect())
    assert got == [("ann", 3, 3), ("bob", 3, 5)]
    assert [r.path.split("/")[-8 + 1] for r in errors.collect()] != []
    table = tempfile.mkdtemp() + "/raw"
    store.replace_snapshot(rows, table, scope=("user",))
    store.replace_snapshot(rows.filter("user = 'bob'"), table, scope=("user",))
    assert store.read_raw(spark, table, ("user",)).count() == 4


def test_partitions_get_files_by_size(spark):
    import glob

    from conftest import raw_row
    from snaptally.schema import RAW_SCHEMA
    rows = [raw_row("2025-01-01", i, f"P{i}", 1) for i in range(500)] + [raw_row("2025-01-02", i, f"P{i}", 1) for i in range(9)]
    path = tempfile.mkdtemp() + "/raw"
    staged = store.stage(spark.createDataFrame(rows, RAW_SCHEMA).repartition(8))
    store.publish(staged, path, rows_per_file=100)
    n = {d: len(glob.glob(f"{path}/snapshot_date={d}/*.parquet")) for d in ("2025-01-01", "2025-01-02")}
    assert n["2025-01-02"] == 1 and 1 <= n["2025-01-01"] <= 5
    assert store.read_raw(spark, path).count() == 509


def test_code_is_found_from_another_folder():
    """Executors get the package from the driver: no PYTHONPATH, another working directory."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "import __spark_entry__ as E\nfrom snaptally.session import build_session\n"
            "s = build_session('local[2]', shuffle_partitions=2)\n"
            f"print('ROWS', E.queries()['plist_ingest'](s, {'/root/testdata/sf0.001'!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True,
                         timeout=300)
    assert "ROWS 3633" in out.stdout, out.stderr[-2000:]


def test_append_refuses_stored_keys(spark, make_raw):
    from conftest import raw_row
    from snaptally.operators.checks import ContractViolation
    path = tempfile.mkdtemp() + "/raw"
    first = make_raw([raw_row("2025-01-01", i, f"P{i}", 1) for i in range(4)])
    store.append_snapshots(first, path)
    store.append_snapshots(make_raw([raw_row("2025-01-01", 9, "P9", 1), raw_row("2025-01-02", 1, "P1", 2)]), path)
    before = sorted(map(tuple, store.read_raw(spark, path).collect()), key=repr)
    for bad in ([raw_row("2025-01-03", 1, "P1", 3), raw_row("2025-01-01", 9, "P9", 7)],
                [raw_row("2025-01-04", 1, "P1", 3), raw_row("2025-01-04", 1, "P2", 3)]):
        with pytest.raises(ContractViolation):
            store.append_snapshots(make_raw(bad), path)
        assert sorted(map(tuple, store.read_raw(spark, path).collect()), key=repr) == before
    # only the batch's dates are read for the check
    stored = store.read_raw(spark, path).where(F.col("snapshot_date").isin([dt.date(2025, 1, 2)]))
    assert "PartitionFilters: [isnotnull(snapshot_date" in stored._jdf.queryExecution().executedPlan().toString()


def test_known_backups_are_not_decoded_again(spark, monkeypatch):
    root, table, ledger = tempfile.mkdtemp(), tempfile.mkdtemp() + "/raw", tempfile.mkdtemp() + "/ledger"
    decoded = []
    real = B.P.read_plist_files
    monkeypatch.setattr(B.P, "read_plist_files", lambda s, paths, **k: decoded.extend(paths) or real(s, paths, **k))

    def put(name, body, user="ann"):
        at = os.path.join(root, f"{name}.backup", "Data", "Users", user, "Music/Music")
        os.makedirs(at, exist_ok=True)
        with open(os.path.join(at, "Music Library.xml"), "w") as f:
            f.write(body)

    def tracks(plays):
        return ('<plist version="1.0"><dict><key>Tracks</key><dict><key>1</key><dict><key>Track ID</key><integer>1</integer>'
                f"<key>Play Count</key><integer>{plays}</integer></dict></dict></dict></plist>")

    def load():
        decoded.clear()
        n = B.load_new_backups(spark, root, table, ledger)
        assert n == len(decoded)
        got = sorted((r.user, r.snapshot_date.day, r.play_count) for r in store.read_raw(spark, table, ("user",)).collect())
        return n, got
    put("2025-01-03-100000", tracks(1))
    put("2025-01-04-100000", tracks(2))
    put("2025-01-03-100000", tracks(7), "bob")
    assert load() == (3, [("ann", 3, 1), ("ann", 4, 2), ("bob", 3, 7)])
    assert load() == (0, [("ann", 3, 1), ("ann", 4, 2), ("bob", 3, 7)])
    put("2025-01-04-120000", tracks(5))  # later that day
    put("2025-01-03-080000", tracks(9))  # earlier that day: does not count
    put("2025-01-05-080000", "<plist><broken")
    assert load() == (3, [("ann", 3, 1), ("ann", 4, 5), ("bob", 3, 7)])
    errors = [r.path for r in B.read_ledger(spark, ledger).where("parse_error is not null").collect()]
    assert len(errors) == 1 and "2025-01-05" in errors[0]
    put("2025-01-04-120000", tracks(66666))  # the file changed
    assert load() == (1, [("ann", 3, 1), ("ann", 4, 66666), ("bob", 3, 7)])
    assert load()[0] == 0
