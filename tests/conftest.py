import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snaptally.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from snaptally.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="snaptally-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="snaptally-test-catalog-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def raw_row(date, track_id, pid, play_count, name="t", artist="A", album="L", album_artist=None,
            total_time=180000, skip_count=0, genre="G", played=None, **kw):
    """One raw snapshot row; unspecified columns are NULL."""
    d = dict.fromkeys(RAW_COLUMNS)
    d.update(snapshot_date=dt.date.fromisoformat(date) if isinstance(date, str) else date,
             snapshot_path="test", track_id=track_id, persistent_id=pid, play_count=play_count,
             name=name, artist=artist, album=album, album_artist=album_artist,
             total_time=total_time, skip_count=skip_count, genre=genre, play_date_utc=played)
    d.update(kw)
    return tuple(d[c] for c in RAW_COLUMNS)


@pytest.fixture
def make_raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return make
