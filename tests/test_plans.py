"""Physical-plan checks: the shapes the design relies on."""

from conftest import SF_SMALL
from snaptally.plans import models as M
from snaptally.plans import reports as R
from snaptally.sources.fixture import load_fixture


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def gold(spark):
    s = M.silver(load_fixture(spark, SF_SMALL))
    return s, M.fact(s), M.dim_track(s)


def test_artist_and_album_joins_are_inner(spark):
    s, _, d = gold(spark)
    f = M.fact(s, skew="off")
    for report in (R.top_artists(f, d), R.top_albums(f, d)):
        assert "LeftOuter" not in plan(report)


def test_latest_window_limits_before_shuffle(spark):
    s, _, _ = gold(spark)
    lines = plan(M.dim_track(s)).splitlines()
    ex = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(track_persistent_id" in x)
    below = "\n".join(lines[ex + 1:ex + 3])
    assert "WindowGroupLimit" in below  # partial top-1 per key on the map side


def test_latest_aggregate_is_partial_before_shuffle(spark):
    s, _, _ = gold(spark)
    assert "partial_max_by" in plan(M.dim_track(s, method="aggregate"))


def test_scan_prunes_columns(spark):
    from pyspark.sql import functions as F
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(li.filter(F.col("l_returnflag") == "R").select("l_partkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in p


def test_histogram_rank_keeps_group_rows_distributed(spark):
    s, _, d = gold(spark)
    f = M.fact(s, skew="off")  # no hot-key subqueries, so only rank exchanges remain
    win = plan(R.top_songs(f, d, method="window"))
    hist = plan(R.top_songs(f, d))
    assert win.count("SinglePartition") == 1
    # the histogram form sends only the (count -> groups) histogram to one task:
    # the single-partition exchange sits on top of the aggregate by play_count
    assert hist.count("SinglePartition") == 1
    lines = hist.splitlines()
    i = next(k for k, x in enumerate(lines) if "SinglePartition" in x)
    assert "HashAggregate(keys=[play_count" in lines[i + 1]


def test_upsert_prunes_untouched_dates(spark):
    import tempfile

    from snaptally.sources import store
    raw = load_fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp()
    store.replace_snapshot(raw, root + "/raw", check=False)
    old = store.read_raw(spark, root + "/raw")
    new = store.bump_latest(raw)
    touched = old.join(new.select("snapshot_date").distinct(), "snapshot_date", "left_semi")
    assert "dynamicpruning" in plan(touched)


def test_songs_are_ranked_before_the_dimension(spark):
    s, _, d = gold(spark)
    f = R.year_totals(M.fact(s, skew="off"))
    lines = plan(R.top_songs(f, d)).splitlines()
    i = next(k for k, x in enumerate(lines) if "SinglePartition" in x)
    # nothing of the dimension below the histogram
    assert not any("title" in x or "p_name" in x and "Project" in x for x in lines[i:i + 4])
    assert "TakeOrderedAndProject" in plan(R.top_songs_limit(f, d))


def test_reports_read_stored_totals_once(spark):
    import tempfile

    from snaptally.plans.warehouse import build, open_warehouse
    root = tempfile.mkdtemp()
    raw = load_fixture(spark, SF_SMALL)
    wh = build(spark, raw, root, buckets=4)
    for report in (R.summary, R.top_artists, R.top_albums, R.yearly_top_songs):
        p = plan(report(wh.plays, wh.dim))
        assert "fact" not in p.replace("factor", "") or "snaptally_fact" not in p
    # one file per bucket, and the stored tables open as bucketed ones again
    import glob
    assert all(len(glob.glob(f"{root}/{t}/*.parquet")) <= 4 for t in ("fact", "dim_track", "totals"))
    again = open_warehouse(spark, root, raw, buckets=4)
    p = plan(R.top_artists(again.plays, again.dim))
    assert "Bucketed: true" in p and p.count("hashpartitioning(track_persistent_id") == 0


def test_replay_page_cuts_the_fact_by_date(spark):
    import tempfile
    _, f, d = gold(spark)
    root = tempfile.mkdtemp()
    f.write.parquet(root + "/f")
    p = plan(R.replay_page(spark.read.parquet(root + "/f"), d, year=1997))
    assert "GreaterThanOrEqual(snapshot_date,1997-01-01)" in p


def test_first_ranks_move_no_rows(spark):
    """Of a top-k only the histogram of the measure meets in one task, ties at the cut included."""
    from snaptally.operators.rank import competition_rank
    df = spark.range(1000).selectExpr("id % 7 AS p", "id % 50 AS m", "id")
    for part in ([], ["p"]):
        p = plan(competition_rank(df, "m", part, max_rank=3))
        lines = p.splitlines()
        for k, x in enumerate(lines):
            if "SinglePartition" in x or "hashpartitioning(p" in x:
                assert "HashAggregate(keys=[" in lines[k + 1] and "m#" in lines[k + 1]
