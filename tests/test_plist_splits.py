"""Large plist files by their splits: the rows and errors are those of the whole-file decoder."""

import datetime as dt
import os
import tempfile

import pytest
from snaptally.schema import RAW_COLUMNS
from snaptally.sources import plist, plistsplit

HEAD = ('<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE plist PUBLIC "-//A//DTD PLIST 1.0//EN" "http://a/b.dtd">\n'
        '<plist version="1.0">\n<dict>\n\t<key>Major Version</key><integer>1</integer>\n{date}\t<key>Tracks</key>\n\t<dict>\n')
DATE = "\t<key>Date</key><date>2025-01-03T09:50:01Z</date>\n"
TRACK = ("\t\t<key>{0}</key>\n\t\t<dict>\n\t\t\t<key>Track ID</key><integer>{0}</integer>\n"
         "\t\t\t<key>Name</key><string>Söng &amp; {0}</string>\n\t\t\t<key>Play Count</key><integer>{1}</integer>\n"
         "\t\t\t<key>Date Added</key><date>2024-05-0{2}T01:02:03Z</date>\n\t\t\t<key>Loved</key><true/>\n\t\t</dict>\n")
LISTS = ("\t<key>Playlists</key>\n\t<array>\n" + "".join(
    f"\t\t<dict>\n\t\t\t<key>Name</key><string>p{i}</string>\n\t\t\t<key>Playlist Items</key>\n\t\t\t<array>\n"
    f"\t\t\t\t<dict>\n\t\t\t\t\t<key>Track ID</key><integer>{i}</integer>\n\t\t\t\t</dict>\n"
    "\t\t\t</array>\n\t\t</dict>\n" for i in range(20)) + "\t</array>\n")
# a value after the tracks that looks like one
LIKE = "\t<key>Settings</key><dict>\n\t<key>7</key><dict><key>Name</key><string>no track</string></dict>\n\t</dict>\n"
TAIL = "</dict>\n</plist>\n"


def library(n=100, date=DATE, tracks=None, after=LISTS + LIKE):
    body = tracks if tracks is not None else "".join(TRACK.format(i, i * 3, i % 9 + 1) for i in range(n))
    return HEAD.format(date=date) + body + "\t</dict>\n" + after + TAIL


def cases():
    good = library()
    return {
        "plain": good,
        "no_date": library(date=""),
        "one_track": library(1),
        "no_lists": library(after=""),
        "tight": library().replace("\n", "").replace("\t", ""),
        "late_date": library(date="", after=LISTS + DATE),
        "bad_date": library(date=DATE.replace("2025-01-03", "soon")),
        "no_track": library(0),
        "cut": good[:len(good) * 2 // 3],
        "cut_at_dict": good[:good.rindex("</dict>") + 7],
        "cut_in_tag": good[:-6],
        "comment": library().replace("<key>Major", "<!-- a </dict> -->\n<key>Major"),
        "comment_in_track": library().replace("<key>50</key>", "<!-- a -->\n<key>50</key>"),
        "cdata": library().replace("Söng &amp; 20<", "<![CDATA[a</dict>b]]><"),
        "nested": library().replace("\t\t\t<key>Loved</key><true/>\n", "\t\t\t<key>More</key><dict><key>Name</key>"
                                    "<string>x</string></dict>\n"),
        "bad_number": library().replace("<integer>150</integer>", "<integer>many</integer>"),
        "bad_id": library().replace("<key>70</key>", "<key>x70</key>"),
        "bad_entity": library().replace("&amp; 80", "&none; 80"),
        "crossed": library().replace("</array>\n\t\t</dict>", "</dict>\n\t\t</array>", 1),
        "unclosed": library().replace("</array>\n", "", 1),
        "second_root": good + "<plist><dict></dict></plist>",
        "junk_after": good + "junk</dict>",
        "latin": good.replace("UTF-8", "ISO-8859-1"),
        "spaced_end": library().replace("<true/>\n\t\t</dict>", "<true/>\n\t\t</dict >", 7),
        "tracks_later": library(after="").replace("<key>Tracks", "<key>Other</key><dict><key>1</key><dict></dict></dict>"
                                                  "\n<key>Tracks"),
    }


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp()
    for name, text in cases().items():
        p = f"{d}/{name}.xml"
        with open(p, "wb") as f:
            f.write(text.encode())
        os.utime(p, (1736000000, 1736000000))
    with open(f"{d}/odd name+%7B&.xml", "wb") as f:
        f.write(library(5).encode())
    with open(f"{d}/bad_bytes.xml", "wb") as f:
        f.write(library().encode().replace("ö".encode(), b"\xff", 1))
    with open(f"{d}/marked.xml", "wb") as f:
        f.write(b"\xef\xbb\xbf" + library().encode())
    return d


def rows(df):
    ok, bad = plist.split_errors(df)
    cols = sorted(c for c in ok.columns if c != "parse_error")
    return sorted(map(str, ok.select(*cols).collect())), sorted(r.path for r in bad.collect())


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)),
                     spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_rows_and_errors_are_those_of_the_whole_decoder(spark, folder, small_splits):
    want = rows(plist.read_plist_files(spark, folder))
    assert len(want[0]) > 900 and len(want[1]) > 8
    small_splits(6007)
    assert rows(plist.read_plist_files(spark, folder, split_bytes=0)) == want
    # files on both sides of the limit
    small_splits(11_003)
    sizes = sorted(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    assert rows(plist.read_plist_files(spark, folder, split_bytes=sizes[len(sizes) // 2])) == want


def test_plain_files_are_read_by_their_splits(spark, folder, small_splits):
    small_splits(6007)
    names = [*plist.PARSED_SCHEMA.fieldNames(), *plistsplit.PLACE.fieldNames()]
    decode = plistsplit.decoder(plist.PLIST_KEYS, plist._value, plist._frame, names, 100)
    tracks, verdicts = plistsplit.read_splits(plist._reader(spark, "*.xml", True), folder, 0, plist.PARSED_SCHEMA, decode)
    got = {r._url.rsplit("/", 1)[1]: r.plain for r in verdicts.collect()}
    assert len(got) == len(cases()) + 3
    assert {n for n, ok in got.items() if ok} == {"plain.xml", "no_date.xml", "one_track.xml", "no_lists.xml",
                                                  "tight.xml", "comment_in_track.xml", "odd%20name+%257B&.xml"}
    spread = tracks.where("_url like '%/plain.xml'").select("_block").distinct().count()
    assert spread > 2


def test_a_large_file_goes_through_the_reader(spark, small_splits):
    d = tempfile.mkdtemp()
    with open(f"{d}/big.xml", "w") as f:
        f.write(library(40_000))
    small_splits(1 << 20)
    want = plist.plist_snapshots(spark, d)
    got = plist.snapshot_rows(plist.split_errors(plist.read_plist_files(spark, d, split_bytes=1 << 20))[0])
    assert got.count() == 40_000
    assert got.select(*RAW_COLUMNS).exceptAll(want.select(*RAW_COLUMNS)).isEmpty()
    assert got.select("snapshot_date").distinct().collect()[0][0] == dt.date(2025, 1, 3)


def test_effects_compose_in_any_grouping():
    text = library(3).encode().split(b"<")
    parts = [b"<" + x for x in text[3:]]
    one = plistsplit.effect(b"".join(parts))
    for cut in range(1, len(parts), 5):
        left, right = plistsplit.effect(b"".join(parts[:cut])), plistsplit.effect(b"".join(parts[cut:]))
        assert plistsplit.compose(left, right) == one
