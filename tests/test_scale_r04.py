"""Round 4: steps that failed at size; each test builds its own rows."""

import gzip
import os
import re

from conftest import raw_row
from snaptally.sources import plist, plistsplit
from test_plist_splits import cases, library, small_splits  # noqa: F401


def _rows(batches):
    return [r for b in batches for r in b.to_pylist()]


def test_plain_libraries_are_decoded_once_and_not_by_the_xml_parser(monkeypatch):
    """a plain file's rows are those of the XML decoder, which it does not reach."""
    good = library()
    kinds = {**cases(), "named": good.replace("&amp; 20<", "&lt;&gt;&quot;&apos;&amp;lt; é<"),
             "number": good.replace("&amp; 20<", "&#233; 20<"), "blank_number": good.replace("<integer>150<", "<integer> 1_50 <"),
             "no_text": good.replace("<string>Söng &amp; 20</string>", "<string></string>"),
             "offset": good.replace("01T01:02:03Z", "01T01:02:03+02:00"), "february": good.replace("2024-05-01", "2024-02-30"),
             "far": good.replace("2024-05-01", "3000-05-01"), "real": good.replace("<integer>150</integer>", "<real>150.0</real>")}
    want = {n: [r for f in plist._decode("p", t.encode()) for r in _rows([plist._to_batch(f.assign(file_modified="m"))])]
            for n, t in kinds.items()}
    got = {n: _rows(plist._decode_file("p", "m", t.encode())) for n, t in kinds.items()}
    assert [n for n in kinds if got[n] != want[n]] == []
    monkeypatch.setattr(plist, "_decode", None)
    monkeypatch.setattr(plist, "_events", None)
    for name in ("plain", "named", "no_date", "tight", "no_lists"):
        assert _rows(plist._decode_file("p", "m", kinds[name].encode())) == want[name]
    assert _rows(plist._decode_file("p", "m", gzip.compress(good.encode()))) == want["plain"]
    # of a file with more rows than may wait none does, and it is read again
    monkeypatch.setattr(plist, "HELD_BYTES", 100)
    monkeypatch.setattr(plist, "CHUNK_ROWS", 7)
    assert _rows(plist._decode_file("p", "m", good.encode())) == want["plain"]


def test_backups_are_kept_without_a_shuffle_of_their_rows(spark, tmp_path):
    """which backups count is stored, so that the rows meet it where they are read."""
    from snaptally.sources import backups as B
    for time, n in (("080000", 3), ("095001", 2)):
        name = f"2025-01-03-{time}.backup"
        d = tmp_path / name / name / B.VOLUMES[0] / "Users" / "u1" / os.path.dirname(B.LIBRARY_PATHS[0])
        d.mkdir(parents=True)
        (d / os.path.basename(B.LIBRARY_PATHS[0])).write_bytes(gzip.compress(library(n).encode()))
    rows, _ = B.read_backup_tree(spark, str(tmp_path))
    assert sorted(r.track_id for r in rows.collect()) == [0, 1]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def _members(text, size):
    return b"".join(gzip.compress(text[i:i + size], mtime=0) for i in range(0, len(text), size))


def test_gzip_members_are_read_by_their_splits(spark, tmp_path, make_raw, small_splits, monkeypatch):  # noqa: F811
    """A packed library is one file of many members, in order, read by as many tasks as it has splits."""
    rows = [raw_row("2025-01-01", i, f"{i:016X}", i % 9, name=f"n & {i} " + os.urandom(8).hex()) for i in range(3000, 0, -1)]
    rows += [raw_row("2025-01-02", 5, None, None, name="<é>")]
    raw, out = make_raw(rows), str(tmp_path / "w")
    monkeypatch.setattr(plist, "MEMBER_BYTES", 40_000)
    plist.write_plist_snapshots(raw.repartition(6), out, compression="members")
    files = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
    assert len(files) == 2
    (big,) = [f for f in files if "2025-01-01" in f]
    data = open(big, "rb").read()
    text = gzip.decompress(data).decode()
    assert data.count(plistsplit.MEMBER) > 3 and len(data) < len(text) / 4
    assert re.findall(r"<key>(\d+)</key><dict>", text) == [str(i) for i in range(1, 3001)]
    want = sorted(map(str, raw.drop("snapshot_path").collect()))
    small_splits(len(data) // 4)
    for size in (plist.SPLIT_BYTES, 0):
        parsed = plist.read_plist_files(spark, out, glob="part-*", split_bytes=size)
        assert sorted(map(str, plist.snapshot_rows(parsed).drop("snapshot_path").collect())) == want
    names = [*plist.PARSED_SCHEMA.fieldNames(), *plistsplit.PLACE.fieldNames()]
    decode = plistsplit.decoder(plist.PLIST_KEYS, plist._value, plist._frame, names, 100, True)
    tracks, verdicts = plistsplit.read_splits(plist._reader(spark, "part-*", True), out, 0, plist.PARSED_SCHEMA, decode,
                                              packed=True)
    assert [r.plain for r in verdicts.collect()] == [True, True]
    assert tracks.where("_url like '%2025-01-01%'").select("_block").distinct().count() > 1


def test_odd_gzip_files_are_those_of_the_whole_decoder(spark, tmp_path, small_splits):  # noqa: F811
    """Members that end inside a track, torn or strange files are decoded in one piece."""
    good, d = library(300).encode(), str(tmp_path)
    lines = good.split(b"</dict>\n\t\t<key>")
    whole = [x + b"</dict>\n\t\t<key>" for x in lines[:-1]] + lines[-1:]
    kinds = {"cut_anywhere": _members(good, 997), "one": gzip.compress(good, mtime=0), "named": gzip.compress(good),
             "torn": _members(good, 997)[:-9], "after": _members(good, 5000) + b"junk", "no_end": _members(good[:-9], 5000),
             "by_tracks": b"".join(gzip.compress(x, mtime=0) for x in whole), "empty_member": gzip.compress(b"", mtime=0) + _members(good, 9999),
             "bad_number": _members(good.replace(b"<integer>150</integer>", b"<integer>x</integer>"), 5000), "plain": good,
             "bad_sum": _members(good, 5000)[:-8] + b"\1" * 8, "only_start": plistsplit.MEMBER}
    for name, data in kinds.items():
        (tmp_path / f"{name}.xml").write_bytes(data)
        os.utime(tmp_path / f"{name}.xml", (1736000000, 1736000000))

    def got(size):
        rows = plist.read_plist_files(spark, d, split_bytes=size).drop("parse_error", "file_modified").collect()
        bad = plist.load_errors(plist.read_plist_files(spark, d, split_bytes=size)).collect()
        return sorted(map(str, rows)), sorted((r.path.rsplit("/", 1)[1]) for r in bad)
    want = got(plist.SPLIT_BYTES)
    assert "torn.xml" in want[1] and "one.xml" not in want[1]
    small_splits(1500)
    assert got(0) == want


def test_packed_exports_are_read_as_plain_ones(spark, tmp_path, make_raw):
    """Exports may be gzip files, of any size and beside plain ones; each keeps its rows' places."""
    from snaptally.sources import csvfile
    from snaptally.streaming.ingest import READERS
    rows = [raw_row("2025-01-01", i, None, i % 9, name='a "b",\n' * (i % 2) + f"n{i}") for i in range(50)]
    rows += [raw_row("2025-01-02", i, f"{i:016X}", i) for i in range(9)]
    raw, a, b = make_raw(rows), str(tmp_path / "p"), str(tmp_path / "z")
    csvfile.write_csv_snapshots(raw, a)
    csvfile.write_csv_snapshots(raw, b, compression="gzip")
    files = [f for _, _, fs in os.walk(b) for f in fs if f.startswith("part-")]
    assert len(files) == 2 and all(f.endswith(".csv.gz") for f in files)

    def got(path, **k):
        return sorted(map(str, csvfile.csv_snapshots(spark, path, **k).drop("snapshot_path").collect()))
    want = got(a)
    assert len(want) == 59 and got(b) == want and got(b, split_bytes=0) == want
    assert got(str(tmp_path), split_bytes=0) == got(str(tmp_path)) == sorted(want * 2)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", READERS["csv"][0]).load(b)
    assert found.count() == 2


def test_the_last_file_of_a_date_is_kept_without_a_shuffle_of_rows(spark):
    """which file of a date counts is stored, so that the rows meet it where they are read."""
    from snaptally.streaming.ingest import latest_file_per_date
    rows = spark.createDataFrame([("2025-01-01", f"file:/x/{f}.csv", i) for f in "ab" for i in range(3)],
                                 "snapshot_date string, snapshot_path string, n int")
    files = spark.createDataFrame([("file:/x/a.csv", 1), ("file:/x/b.csv", 1)], "path string, modificationTime int")
    kept = latest_file_per_date(rows, files)
    assert sorted((r.snapshot_path[-5], r.n) for r in kept.collect()) == [("b", 0), ("b", 1), ("b", 2)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_null_lines_are_packed_as_the_text_writer_has_them(spark, tmp_path):
    """A line without text, file name or place gives the same bytes packed and plain."""
    rows = [("a", 0, 0, "<plist>"), ("a", 1, None, "x"), ("a", 1, 7, None), ("a", 2, 0, "</plist>"), (None, 1, 1, None), (None, 1, 2, "y")]
    lines = spark.createDataFrame(rows, "snapshot string, _part int, _ord long, value string")
    text = {}
    for kind in ("none", "members"):
        out = str(tmp_path / kind)
        plist.write_plist_lines(lines, out, compression=kind)
        found = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
        data = {os.path.basename(os.path.dirname(f)): open(f, "rb").read() for f in found}
        text[kind] = {k: gzip.decompress(v) if kind == "members" else v for k, v in data.items()}
    assert len(text["none"]) == 2 and text["members"] == text["none"]
