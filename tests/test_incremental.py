"""Incremental loads equal a full rebuild."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from snaptally.plans import models as M
from snaptally.plans import reports as R
from snaptally.plans.incremental import append, init, open_incremental
from snaptally.sources.fixture import load_fixture


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_appends_equal_full_build(spark):
    raw = load_fixture(spark, SF_SMALL).cache()
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    cut1, cut2 = dates[19], dates[23]
    root = tempfile.mkdtemp()
    init(spark, raw.filter(F.col("snapshot_date") <= cut1), root)
    assert append(spark, raw.filter((F.col("snapshot_date") > cut1) & (F.col("snapshot_date") <= cut2)), root)
    assert append(spark, raw.filter(F.col("snapshot_date") > cut2), root)
    wh = open_incremental(spark, root)
    s = M.silver(M.bronze(raw))
    full_fact, full_dim = M.fact(s), M.dim_track(s)
    assert rows(wh.fact) == rows(full_fact)
    assert rows(wh.dim) == rows(full_dim)
    assert rows(R.top_artists(wh.fact, wh.dim)) == rows(R.top_artists(full_fact, full_dim))
    # a batch that is not later than the state is refused and writes nothing
    assert not append(spark, raw.filter(F.col("snapshot_date") == cut2), root)
    assert rows(open_incremental(spark, root).fact) == rows(full_fact)


def test_repair_after_late_and_shrunk_snapshots(spark):
    from snaptally.plans.incremental import repair
    raw = load_fixture(spark, SF_SMALL).cache()
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    late, shrunk = dates[10], dates[20]
    root = tempfile.mkdtemp()
    # everything but one date, then the missing (late) date arrives
    init(spark, raw.filter(F.col("snapshot_date") != late), root)
    repair(spark, raw, raw.filter(F.col("snapshot_date") == late), root)
    s = M.silver(M.bronze(raw))
    assert rows(open_incremental(spark, root).fact) == rows(M.fact(s))
    assert rows(open_incremental(spark, root).dim) == rows(M.dim_track(s))
    # a re-export of an existing date without the odd tracks
    raw2 = raw.filter((F.col("snapshot_date") != shrunk) | (F.col("track_id") % 2 == 0))
    repair(spark, raw2, raw2.filter(F.col("snapshot_date") == shrunk), root)
    s2 = M.silver(M.bronze(raw2))
    assert rows(open_incremental(spark, root).fact) == rows(M.fact(s2))
    assert rows(open_incremental(spark, root).dim) == rows(M.dim_track(s2))


def files_of(root, date):
    import glob
    return {f for f in glob.glob(f"{root}/fact/load=*/snapshot_date={date}/*.parquet")}


def test_repair_writes_touched_partitions_only(spark):
    from snaptally.plans.incremental import current, repair
    raw = load_fixture(spark, SF_SMALL).cache()
    dates = sorted(str(r[0]) for r in raw.select("snapshot_date").distinct().collect())
    late = dates[10]
    root = tempfile.mkdtemp()
    init(spark, raw.filter(F.col("snapshot_date") != late), root)
    before = current(spark, root)
    repair(spark, raw, raw.filter(F.col("snapshot_date") == late), root)
    after = current(spark, root)
    changed = {d for d in after.facts if after.facts[d] != before.facts.get(d)}
    # the date itself and the dates of rows that follow it
    full = M.fact(M.silver(M.bronze(raw)))
    follows = {str(r[0]) for r in full.filter(F.col("prev_snapshot_date") == late)
               .select("snapshot_date").distinct().collect()}
    assert changed == {late} | follows and len(changed) < len(dates) // 2
    # untouched dates keep their files
    assert all(len(files_of(root, d)) == 1 for d in dates if d not in changed)


def test_failed_loads_leave_no_rows(spark):
    from snaptally.plans.incremental import expire, repair
    raw = load_fixture(spark, SF_SMALL).cache()
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    day = F.col("snapshot_date")
    root = tempfile.mkdtemp()
    init(spark, raw.filter((day < dates[20]) & (day != dates[5])), root)
    repair(spark, raw.filter(day < dates[20]), raw.filter(day == dates[5]), root, publish=False)
    assert append(spark, raw.filter((day >= dates[20]) & (day <= dates[22])), root)
    assert append(spark, raw.filter(day == dates[23]), root, publish=False)
    assert append(spark, raw.filter((day >= dates[23])), root)
    repair(spark, raw, raw.filter(day == dates[5]), root)
    full = rows(M.fact(M.silver(M.bronze(raw))))
    assert rows(open_incremental(spark, root).fact) == full
    gone = expire(spark, root, keep=1)
    assert gone and rows(open_incremental(spark, root).fact) == full
    assert not expire(spark, root, keep=1)


def test_scoped_loads(spark):
    from snaptally.plans.incremental import repair
    from snaptally.sources.fixture import load_library_fixture
    scope = ("library_id",)
    raw = M.bronze(load_library_fixture(spark, SF_SMALL), scope=scope).cache()
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    late = (F.col("snapshot_date") == dates[9]) & (F.col("library_id") == 1)
    root = tempfile.mkdtemp()
    init(spark, raw.filter(~late & (F.col("snapshot_date") <= dates[20])), root, scope)
    assert append(spark, raw.filter(F.col("snapshot_date") > dates[20]), root, scope)
    repair(spark, raw, raw.filter(late), root, scope)
    s = M.silver(raw, scope=scope)
    wh = open_incremental(spark, root, scope)
    assert rows(wh.fact) == rows(M.fact(s, scope=scope))
    assert rows(wh.dim) == rows(M.dim_track(s, scope=scope))


def test_rollups_follow_appends_and_repairs(spark):
    """(track, year) and day totals after appends, late and shrunk dates are those of a rebuild."""
    from snaptally.plans.incremental import repair
    raw = load_fixture(spark, SF_SMALL).cache()
    day = F.col("snapshot_date")
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    root = tempfile.mkdtemp()
    init(spark, raw.filter((day < dates[16]) & (day != dates[6])), root)
    assert append(spark, raw.filter((day >= dates[16]) & (day < dates[25])), root)
    repair(spark, raw.filter(day < dates[25]), raw.filter(day == dates[6]), root)
    assert append(spark, raw.filter(day >= dates[25]), root)

    def same(of):
        wh, fact = open_incremental(spark, root), M.fact(M.silver(M.bronze(of)))
        dim = M.dim_track(M.silver(M.bronze(of)))
        assert rows(wh.totals) == rows(R.year_totals(fact))
        assert rows(wh.days) == rows(R.day_totals(fact))
        assert rows(R.weekly_trend(wh.trends)) == rows(R.weekly_trend(fact))
        assert rows(R.yearly_summary(wh.plays, wh.dim)) == rows(R.yearly_summary(fact, dim))
    same(raw)
    # one date goes but for a few tracks; then all tracks of another year's date but one
    few = raw.filter((day != dates[20]) | (F.col("track_id") % 5 == 0))
    repair(spark, few, few.filter(day == dates[20]), root)
    same(few)
    one = few.filter((day != dates[0]) | (F.col("track_id") == few.filter(day == dates[0]).agg(F.min("track_id")).first()[0]))
    repair(spark, one, one.filter(day == dates[0]), root)
    same(one)


def test_minutes_become_unknown_when_the_last_known_goes(make_raw):
    """A NULL sum and a zero one stay apart in merged totals."""
    from conftest import raw_row
    raw = make_raw([raw_row("2024-01-01", 1, "A", 1), raw_row("2024-01-02", 1, "A", 4, total_time=None),
                    raw_row("2024-01-03", 1, "A", 6), raw_row("2024-01-01", 2, "B", 1), raw_row("2024-01-03", 2, "B", 1)])
    fact = M.fact(M.silver(M.bronze(raw)))
    day = F.col("snapshot_date").cast("string")
    whole, third = R.year_totals(fact), R.year_totals(fact.where(day == "2024-01-03"))
    left = R.year_totals(fact.where(day != "2024-01-03"))
    assert rows(R.merge_totals([whole], [third])) == rows(left)
    assert [r.minutes_x for r in left.orderBy("track_persistent_id").collect()] == [None, None]
    assert rows(R.merge_totals([left, third], [])) == rows(whole)
    assert rows(R.merge_totals([whole], [whole])) == []


def test_repair_reads_the_touched_tracks_and_dates_only(spark, monkeypatch):
    """A late day of ten tracks: no pass over the fact, neighbours found in the nearest dates."""
    from snaptally.plans import incremental as I
    raw = load_fixture(spark, SF_SMALL).cache()
    day = F.col("snapshot_date")
    dates = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    late = dates[10]
    ten = [r[0] for r in raw.filter(day == late).select("track_id").orderBy("track_id").limit(10).collect()]
    held = raw.filter((day != late) | ~F.col("track_id").isin(ten))
    root = tempfile.mkdtemp()
    init(spark, held.filter(day != late), root)
    read, plans = [], []
    real = I._read_fact
    monkeypatch.setattr(I, "_read_fact", lambda s, r, facts, *a: read.append(sorted(facts)) or real(s, r, facts, *a))
    keep = I.materialise
    monkeypatch.setattr(I, "materialise", lambda df, name: plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())) or keep(df, name))
    only = raw.filter((day != late) | F.col("track_id").isin(ten))
    I.repair(spark, only, only.filter(day == late), root)
    assert rows(open_incremental(spark, root).fact) == rows(M.fact(M.silver(M.bronze(only))))
    # no read takes all dates, and the first look for next rows takes two dates
    assert all(len(d) < len(dates) - 1 for d in read[:-1])
    assert [str(d) for d in dates[11:13]] in read
    # each aggregate over fact rows is above the join with the wanted keys
    for name, p in plans:
        if name == "next-rows":
            assert "LeftSemi" in p and p.index("Aggregate") < p.index("LeftSemi") < p.index("FileScan")


def test_neighbours_over_long_gaps(spark, make_raw):
    """Tracks whose next row is many dates away, new tracks, and a blank id with many rows a date."""
    from conftest import raw_row
    from snaptally.plans import incremental as I
    rs = [raw_row(f"2024-01-{d:02d}", 1, "EVERY", d) for d in range(1, 29) if d != 9]
    rs += [raw_row("2024-01-02", 2, "GAP", 2), raw_row("2024-01-27", 2, "GAP", 9), raw_row("2024-01-20", 3, "NEW", 1)]
    rs += [raw_row(f"2024-01-{d:02d}", 10 + k, "", d + k) for d in (3, 8, 15) for k in range(4)]
    late = [raw_row("2024-01-09", i, p, 5) for i, p in ((1, "EVERY"), (2, "GAP"), (3, "NEW"), (4, "LAST"), (10, ""), (11, ""))]
    root = tempfile.mkdtemp()
    init(spark, make_raw(rs), root)
    I.repair(spark, make_raw(rs + late), make_raw(late), root)
    s = M.silver(M.bronze(make_raw(rs + late)))
    wh = open_incremental(spark, root)
    assert rows(wh.fact) == rows(M.fact(s)) and rows(wh.dim) == rows(M.dim_track(s))
    assert rows(wh.totals) == rows(R.year_totals(M.fact(s)))
