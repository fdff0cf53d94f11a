"""Round 3: steps that failed or grew too fast at size; each test builds its own rows."""

import gzip
import os
import random
import xml.etree.ElementTree as ET

from snaptally.sources import csvfile, plist, plistsplit

HEAD = ('<?xml version="1.0" encoding="UTF-8"?><plist version="1.0"><dict>'
        '<key>Date</key><date>2024-05-01T08:00:00Z</date><key>Tracks</key><dict>\n')
TRACK = '<key>{0}</key><dict><key>Name</key><string>n &amp; {0}</string><key>Play Count</key><integer>{0}</integer></dict>\n'
FOOT = "</dict></dict></plist>"


def _write(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def _library(n, foot=FOOT, head=HEAD):
    return head + "".join(TRACK.format(i) for i in range(1, n + 1)) + foot


def _key(rows):
    return sorted(map(str, rows))


def test_large_odd_plists_are_decoded_as_streams(spark, tmp_path, monkeypatch):
    """a file over the split size that is not plain never is in memory as one value."""
    d = str(tmp_path)
    _write(d, "bad_number.xml", _library(300).replace("<integer>300<", "<integer>x300<"))
    _write(d, "cut_off.xml", _library(300, foot=""))
    _write(d, "no_tracks.xml", HEAD + FOOT)
    _write(d, "comment.xml", _library(300).replace("<key>7</key><dict>", "<!-- c --><key>7</key><dict>"))
    late = _library(300, head=HEAD.replace("<key>Date</key><date>2024-05-01T08:00:00Z</date>", ""),
                    foot="</dict><key>Date</key><date>2024-06-02T08:00:00Z</date></dict></plist>")
    _write(d, "late_date.xml", late)
    want = [(r.path.rsplit("/", 1)[1], r.parse_error, r.library_date, r.track_id, r.name, r.play_count, r.file_modified)
            for r in plist.read_plist_files(spark, d).collect()]
    whole = plist._whole

    def small(files):
        got = whole(files)
        assert not files.select("path").limit(1).count(), "a large file's content was read as one value"
        return got
    monkeypatch.setattr(plist, "_whole", small)
    got = [(r.path.rsplit("/", 1)[1], r.parse_error, r.library_date, r.track_id, r.name, r.play_count, r.file_modified)
           for r in plist.read_plist_files(spark, d, split_bytes=0).collect()]
    assert _key(got) == _key(want) and len({r[0] for r in got}) == 5


def test_gzip_libraries_are_read_by_their_first_bytes(spark, tmp_path):
    """backup trees may hold packed libraries, read whole or as streams."""
    d = str(tmp_path)
    packed = gzip.compress(_library(200).encode())
    _write(d, "packed.xml", packed)
    _write(d, "two.xml", gzip.compress(_library(200).encode()[:500]) + gzip.compress(_library(200).encode()[500:]))
    _write(d, "torn.xml", packed[:-20])
    for size in (plist.SPLIT_BYTES, 0):
        rows = plist.read_plist_files(spark, d, split_bytes=size).collect()
        assert sorted(r.track_id for r in rows if r.path.endswith("packed.xml")) == list(range(1, 201))
        assert sorted(r.track_id for r in rows if r.path.endswith("two.xml")) == list(range(1, 201))
        (torn,) = [r for r in rows if r.path.endswith("torn.xml")]
        assert torn.track_id is None and "EOFError" in torn.parse_error


def _slow(record):
    e = ET.fromstring(b"<r>%s</dict></r>" % record)
    got = plistsplit._pair(e[0], e[1]) if len(e) == 2 else None
    return got and (got[0], {k: plist._value(v) for k, v in got[1].items()})


def test_plain_tracks_are_read_as_the_xml_parser_reads_them():
    """The pattern refuses what it cannot read."""
    rng, hits = random.Random(3), 0
    parts = ["<key>Name</key><string>a b</string>", "<key>Year</key> <integer>-19</integer>", "\n", "<key>Loved</key><true/>",
             "<key>Loved</key><false/>", "<key>Kind</key><string></string>", "<key>x</key><date>2020-01-01T00:00:00Z</date>",
             "<key>Name</key><string>é</string>", "<key>Name</key><string>a&lt;b</string>", "\r", "<integer>3</integer>",
             "<key>n</key><real>1.5</real>", "<key>n</key><integer>x</integer>", "\x0b", "<key>q</key><string>]]></string>"]
    for _ in range(3000):
        record = f"<key>{rng.randrange(99)}</key><dict>{''.join(rng.choices(parts, k=rng.randrange(5)))}".encode()
        fast = plistsplit.plain_track(record)
        if fast is not None:
            hits += 1
            assert (fast[0], dict(fast[1])) == _slow(record)
    assert hits > 300


def test_csv_date_and_header_are_read_once_a_file(spark, tmp_path):
    """No row meets its file's header or date by a shuffle of cells."""
    d = str(tmp_path)
    _write(d, "a.csv", "play_count,title,persistent_id,snapshot_date,last_played_date\n"
                       "3,x,00000000000000AB,2024-01-02T01:00:00+02:00,2024-01-01 10:00:00Z\n4,y,zz,,2024-01-01T10:00+01:00\n")
    _write(d, "b.csv", "title\n")
    rows = csvfile.csv_snapshots(spark, d)
    got = sorted((str(r.snapshot_date), r.track_id, r.name, r.play_count, str(r.play_date_utc)) for r in rows.collect())
    assert got == [("2024-01-01", 1, "y", 4, "2024-01-01 09:00:00"), ("2024-01-01", 171, "x", 3, "2024-01-01 10:00:00")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_backup_paths_are_matched_once_and_picked_by_a_number(spark):
    """One pattern per path, no row compared by its texts."""
    from snaptally.sources import backups as B
    flat = "/tm/{0}.backup/{1}/Users/{2}/{3}"
    name, bad = "2024-01-02-030405", "2024-13-02-030405"
    paths = [flat.format(name, "Data", "a b\nc", B.LIBRARY_PATHS[2]), flat.format(name, "Macintosh HD", "a b\nc", B.LIBRARY_PATHS[0]),
             flat.format(f"{name}.backup/{name}", "Macintosh HD", "u$1", B.LIBRARY_PATHS[1]),
             flat.format(name, "Data", "u$1", B.LIBRARY_PATHS[0]), flat.format(bad, "Data", "u", B.LIBRARY_PATHS[0]),
             flat.format(name, "Disk", "u", B.LIBRARY_PATHS[0]), None]
    picked = B.pick_library_files(B.parse_backup_paths(spark.createDataFrame([(p,) for p in paths], "path string")))
    assert sorted((r.user, r.path, r.nested, r.volume, r.library) for r in picked.collect()) == [
        ("a b\nc", paths[0], False, "Data", B.LIBRARY_PATHS[2]), ("u$1", paths[2], True, "Macintosh HD", B.LIBRARY_PATHS[1])]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "min_by" not in plan and "min(priority" in plan and "regexp_extract" not in plan


def test_classifier_counts_words_by_their_bytes():
    """op7: the counts of a text's words, as their definitions give them."""
    from snaptally.llm import classifier as C
    raw = "Ab AB ab! ab! é! É 1a _x (y) A. same same\n?".encode()
    words = raw.split()
    n, x = len(words), C.vector(raw)[:C.SIZE // 3]
    want = [sum(w[-1:] in b".!?" for w in words), sum(a == b for a, b in zip(words, words[1:])),
            sum(w.isupper() for w in words), sum(w[:1].isupper() for w in words),
            sum(not w[:1].isalnum() and w[:1] < b"\x80" for w in words)]
    assert all(v / n in x for v in want)
    assert C.UPPER == bytes(range(65, 91)) and b"_" not in C.BARE and "é".encode()[:1] in C.BARE


def _tables(spark, folder):
    """Three customers, four orders, two parts with lines in two years."""
    import datetime as dt
    days = [dt.date(1999, 1, 5), dt.date(1999, 8, 5), dt.date(2000, 2, 5), dt.date(2000, 11, 5)]
    lines = [(o, p, days[(o + p + i) % 4], "R" if i else "N") for o in range(4) for p in (1, 2) for i in (0, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_shipdate date, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(o, o % 3) for o in range(4)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(p, f"n{p}", "b", "t", 7) for p in (1, 2)], "p_partkey long, p_name string, p_brand string, "
                          "p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return folder


def test_hot_keys_are_looked_for_in_one_pass(spark, monkeypatch):
    """Rows without a hot key are not counted again, and may be looked for elsewhere."""
    from snaptally.operators import delta as D
    rows = spark.createDataFrame([("a", i, i) for i in range(40)] + [("b", 1, 5), ("b", 2, 7)], "k string, d int, c int")
    runs, real = [], D.hot_keys
    monkeypatch.setattr(D, "hot_keys", lambda df, keys, max_keys=1000, *a, **k: runs.append(max_keys) or real(df, keys, max_keys, *a, **k))
    assert D.hot_list(rows, ["k"], 1000, 10_000, 1.0) == [] and runs == [None]
    assert D.hot_list(rows, ["k"], 1000, 30, 1.0) == [("a",)] and runs == [None, None, 1000]
    assert D.hot_list(rows, ["k"], 1, 2, 1.0) == [("a",)]  # b is under half the rows
    want = sorted(map(tuple, D.counter_delta(rows, ["k"], "d", ["c"]).collect()), key=str)
    asked = []
    monkeypatch.setattr(D, "hot_list", lambda df, *a: asked.append(df) or [("a",)])
    other = rows.select("k")
    got = D.counter_delta(rows, ["k"], "d", ["c"], hot_from=other)
    assert asked == [other] and sorted(map(tuple, got.collect()), key=str) == want


def test_hot_tracks_of_the_fixture_are_looked_for_in_its_lines(spark, tmp_path):
    """finding hot tracks builds no snapshots; a track has at least as many lines."""
    from snaptally.plans.catalog import Gold, LibraryGold
    d = _tables(spark, str(tmp_path))
    g = Gold(spark, d)
    lines = g._hot_from()
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    count = {r[0]: r[1] for r in lines.groupBy("track_persistent_id").count().collect()}
    rows = {r[0]: r[1] for r in g.silver.groupBy("track_persistent_id").count().collect()}
    assert rows and rows.keys() == count.keys() and all(count[k] >= n for k, n in rows.items())
    assert LibraryGold(spark, d)._hot_from() is None


def test_loads_read_their_own_part_of_the_raw_rows(spark, tmp_path):
    """A load of one year opens the files of that year only."""
    from snaptally.plans import catalog as C
    from pyspark.sql import functions as F
    d = _tables(spark, str(tmp_path))
    raw = C._by_year(spark, d, "raw")
    assert sorted(map(str, raw.drop("_year").collect())) == sorted(map(str, C._fixture(spark, d).collect()))
    one = raw.where(F.col("_year") == 2000)
    years = {str(r[0])[:4] for r in one.select("snapshot_date").collect()}
    assert years == {"2000"} and all("_year=2000" in f for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in plan


def test_libraries_are_computed_once_and_not_copied(spark, tmp_path, monkeypatch):
    """three loads and a re-export read stored rows; a load of stored rows makes no copy."""
    from snaptally.plans import catalog as C
    from snaptally.sources import store
    d = _tables(spark, str(tmp_path))
    made, built = [], []
    real, load = store.materialise, C.load_library_fixture
    monkeypatch.setattr(store, "materialise", lambda df, name, *a: made.append(df.count()) or real(df, name, *a))
    seen = []
    replace = store.replace_snapshot
    monkeypatch.setattr(store, "replace_snapshot", lambda df, *a, **k: seen.append(
        df._jdf.queryExecution().executedPlan().toString()) or replace(df, *a, **k))
    monkeypatch.setattr(C, "load_library_fixture", lambda *a: built.append(1) or load(*a))
    got = C._library_replace(spark, d)
    assert built == [1] and len(made) == 1 and len(seen) == 4
    assert all("Exchange" not in p for p in seen[:3])  # the re-export looks for the latest date
    raw = load(spark, d)
    bumped = store.bump_latest(raw.filter("library_id = 1"))
    kept = raw.join(bumped.select("library_id", "snapshot_date").distinct(), ["library_id", "snapshot_date"], "left_anti")
    want = kept.unionByName(bumped.select(kept.columns))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_parts_of_several_libraries_are_dealt_once(spark, tmp_path):
    """the counters' window and the parts share one shuffle."""
    from snaptally.sources.fixture import load_library_fixture
    d = _tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load_library_fixture(spark, d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(library_id" in plan and plan.count("Exchange hashpartitioning") == 5
