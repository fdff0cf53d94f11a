"""Incremental maintenance of the fact and the latest-state dimension.

A full ``build`` reads and shuffles the whole history. When a batch of new
snapshots is later than everything loaded so far, two facts make the
history unnecessary:

* a new snapshot's delta needs only the track's last row so far;
* the latest state is a maximum over ``(snapshot_date, track_id)``, which
  can be taken over the old state and the batch instead of all rows.

So the store keeps a **track state** (the latest silver row of every track,
which is the dimension plus its last counters) and each ``append`` runs the
LAG over ``state + batch`` and the latest-state window over the same rows:
O(tracks + batch) instead of O(history). Results equal a full rebuild (the
tests compare them). A batch holding a date not after the state's is
refused by ``append`` (returns False): it changes deltas already written.

``repair`` handles it. A fact row depends on its own snapshot and the track's
previous one, so a late or re-exported date changes only rows of that date and
rows whose previous snapshot is (or was) of that date. Affected tracks are
the batch's keys and the keys the fact held on the batch's dates (a re-export
can drop tracks). For each, only the raw rows from its last snapshot before the
batch's dates to its first one after them are read and recomputed, and only the
date partitions with changed rows are written anew.

Those two neighbours come from the fact's own chain, not from a pass over it: the
first row at or after the batch's dates names the one before in ``prev_snapshot_date``;
the state says which tracks have a later row at all, and it is looked up date by
date, nearest first, in growing windows (two dates where tracks are in every snapshot).

Two roll-ups are kept with the fact, by year: the (track, year) totals and the day totals.
Their columns are sums, so a load takes back the rows of the partitions it replaces and
adds those it wrote; only the years of touched dates are written anew.

Layout under ``root``. Every load writes folders of its own, named by a fresh id,
and nothing is ever overwritten:

* ``fact/load=<id>/snapshot_date=<date>/``: fact rows a load wrote;
* ``totals/load=<id>/year=<year>/``, ``days/load=<id>/year=<year>/``: roll-ups of the years it touched;
* ``track_state/load=<id>/``: the track state after a load;
* ``manifest/v=<n>/``: one small file: the state's load and date, for each snapshot date the load
  whose fact folder holds it, and for each year the load whose roll-ups hold it.

The newest manifest is the store. A load becomes current by its manifest, one
file moved into place at job commit; what a failed load left behind is named by
no manifest, so it is never read, whatever is run after it. ``expire`` removes
folders that the kept manifests do not name.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import counter_delta
from ..operators.latest import latest_by
from ..schema import DIM_TRACK_COLUMNS, ENTITY, FACT_COLUMNS, SILVER_COLUMNS, SNAPSHOT, TIEBREAK
from ..session import child_folders, delete_path, materialise
from ..sources.store import by_partition
from . import models as M
from . import reports as R
from .warehouse import Warehouse

FACT_DIR, STATE_DIR, MANIFEST_DIR, TOTALS_DIR, DAYS_DIR = "fact", "track_state", "manifest", "totals", "days"
_FACT_INPUT = [ENTITY, SNAPSHOT, TIEBREAK, "play_count", "skip_count", "last_played_at_utc",
               "duration_min"]


def track_state(silver_df: DataFrame, scope: tuple = ()) -> DataFrame:
    """Latest silver row of every track: the dimension plus its last counters."""
    cols = [c for c in SILVER_COLUMNS if c != ENTITY]
    return latest_by(silver_df.select(*scope, *SILVER_COLUMNS), [*scope, ENTITY], [SNAPSHOT],
                     tiebreak=[TIEBREAK], columns=cols).select(*scope, *SILVER_COLUMNS)


@dataclass
class Manifest:
    """What the current store consists of; ``facts``: snapshot date -> load; ``rollups``: year -> load."""

    version: int
    asof: str
    state: str
    facts: dict[str, str]
    rollups: dict[str, str] = field(default_factory=dict)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Published manifests (one listing; ``expire`` keeps it short)."""
    return sorted(int(n[2:]) for n in child_folders(spark, os.path.join(root, MANIFEST_DIR)) if n.startswith("v="))


def _manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    rows = spark.read.schema("kind string, date string, load string").parquet(
        os.path.join(root, MANIFEST_DIR, f"v={version}")).collect()  # a row per date and year
    state = next(r for r in rows if r.kind == "state")
    return Manifest(version, state.date, state.load, {r.date: r.load for r in rows if r.kind == "fact"},
                    {r.date: r.load for r in rows if r.kind == "rollup"})


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest, or None for an empty store."""
    found = _versions(spark, root)
    return _manifest(spark, root, found[-1]) if found else None


def state_version(spark: SparkSession, root: str) -> str | None:
    """Date of the newest state version."""
    cur = current(spark, root)
    return cur.asof if cur else None


def _read_state(spark: SparkSession, root: str, load: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, STATE_DIR, f"load={load}"))


def _read_fact(spark: SparkSession, root: str, facts: dict[str, str], state: DataFrame, scope: tuple = ()) -> DataFrame:
    """The fact rows of the given dates, from exactly the folders that ``facts`` names."""
    base = os.path.join(root, FACT_DIR)
    paths = [os.path.join(base, f"load={load}", f"{SNAPSHOT}={date}") for date, load in sorted(facts.items())]
    empty = M.fact(state.limit(0), skew="off", scope=scope)  # also gives the schema: no file is read for it
    if not paths:
        return empty
    return spark.read.schema(empty.schema).option("basePath", base).parquet(*paths).select(*scope, *FACT_COLUMNS)


def _read_rollup(spark: SparkSession, root: str, folder: str, rollups: dict[str, str], like: DataFrame) -> DataFrame | None:
    base = os.path.join(root, folder)
    paths = [os.path.join(base, f"load={load}", f"year={year}") for year, load in sorted(rollups.items())]
    if not paths:
        return None
    return spark.read.schema(like.schema).option("basePath", base).parquet(*paths).select(*like.columns)


def _rollups(fact: DataFrame, scope: tuple) -> tuple[DataFrame, DataFrame]:
    """The (track, year) and the day totals of a fact, both with their year."""
    return R.year_totals(fact, scope), R.day_totals(fact, scope).withColumn("year", R.year_of(SNAPSHOT))


def _dates(df: DataFrame) -> list[str]:
    """The snapshot dates of a load (bounded by the calendar)."""
    return sorted(str(r[0]) for r in df.select(SNAPSHOT).distinct().collect())


def _write(fact: DataFrame, state: DataFrame, root: str) -> tuple[str, list[str]]:
    """Write one load's fact partitions and state under a fresh id; returns it and the written dates."""
    load = uuid.uuid4().hex
    path = os.path.join(root, FACT_DIR, f"load={load}")
    by_partition(fact, [SNAPSHOT]).write.partitionBy(SNAPSHOT).parquet(path)
    state.write.parquet(os.path.join(root, STATE_DIR, f"load={load}"))
    dates = [n.partition("=")[2] for n in child_folders(fact.sparkSession, path) if "=" in n]
    return load, dates


def _roll_up(spark: SparkSession, root: str, load: str, wrote: list[str], cur: Manifest | None, replaced: list[str],
             state: DataFrame, scope: tuple) -> dict[str, str]:
    """Write the roll-ups of the years that a load touched: what was kept, less the rows of the ``replaced``
    dates, plus those it ``wrote``. Returns year -> load of all years."""
    gone = {d: cur.facts[d] for d in replaced if d in cur.facts} if cur else {}
    years = {d[:4] for d in [*wrote, *gone]}
    new = _read_fact(spark, root, dict.fromkeys(wrote, load), state, scope)
    kept = {y: x for y, x in cur.rollups.items()} if cur else {}
    old = {y: kept.pop(y) for y in years if y in kept}
    totals, days = _rollups(new, scope)
    if old:
        left = [R.year_totals(_read_fact(spark, root, gone, state, scope), scope)] if gone else []
        held = _read_rollup(spark, root, DAYS_DIR, old, days).where(~F.col(SNAPSHOT).cast("string").isin(replaced))
        totals = R.merge_totals([_read_rollup(spark, root, TOTALS_DIR, old, totals), totals], left, scope)
        days = days.unionByName(held)
    by_partition(totals, ["year"]).write.partitionBy("year").parquet(os.path.join(root, TOTALS_DIR, f"load={load}"))
    days.coalesce(1).write.partitionBy("year").parquet(os.path.join(root, DAYS_DIR, f"load={load}"))
    found = [n.partition("=")[2] for n in child_folders(spark, os.path.join(root, TOTALS_DIR, f"load={load}")) if "=" in n]
    return {**kept, **dict.fromkeys(found, load)}


def _publish(spark: SparkSession, root: str, m: Manifest) -> None:
    """Make a load current: its manifest is one file, there or not."""
    rows = [("state", m.asof, m.state), *[("fact", d, x) for d, x in sorted(m.facts.items())],
            *[("rollup", y, x) for y, x in sorted(m.rollups.items())]]
    (spark.createDataFrame(rows, "kind string, date string, load string").coalesce(1)
     .write.parquet(os.path.join(root, MANIFEST_DIR, f"v={m.version}")))


def init(spark: SparkSession, raw: DataFrame, root: str, scope: tuple = (),
         skew: str = "auto") -> Warehouse:
    """Full load of ``raw``: the fact of all history and the first state. An earlier
    store under ``root`` is superseded."""
    s = M.silver(M.bronze(raw, scope=scope), scope=scope)
    load, dates = _write(M.fact(s, skew=skew, scope=scope), track_state(s, scope), root)
    state = _read_state(spark, root, load)
    found = _versions(spark, root)
    _publish(spark, root, Manifest(found[-1] + 1 if found else 0, dates[-1] if dates else "", load,
                                   dict.fromkeys(dates, load), _roll_up(spark, root, load, dates, None, [], state, scope)))
    return open_incremental(spark, root, scope)


def append(spark: SparkSession, new_raw: DataFrame, root: str, scope: tuple = (),
           skew: str = "auto", publish: bool = True) -> bool:
    """Add a batch of later snapshots; False (nothing written) if the batch
    holds a date not after the current state's. ``publish=False`` writes the load's
    files only, as a load does that fails before its manifest."""
    cur = current(spark, root)
    batch = M.silver(M.bronze(new_raw, scope=scope), scope=scope)
    dates = _dates(batch)
    if not dates:
        return True
    if cur is None:
        if publish:
            init(spark, new_raw, root, scope, skew)
        return True
    if dates[0] <= cur.asof:
        return False
    state = _read_state(spark, root, cur.state)
    prior = state.select(*scope, *_FACT_INPUT).withColumn("_new", F.lit(False))
    rows = prior.unionByName(batch.select(*scope, *_FACT_INPUT).withColumn("_new", F.lit(True)))
    d = counter_delta(rows, [*scope, ENTITY], SNAPSHOT, ["play_count", "skip_count"], tiebreak=[TIEBREAK],
                      skew=skew)
    new_fact = d.filter(F.col("_new")).select(*scope, *FACT_COLUMNS)
    both = state.select(*scope, *SILVER_COLUMNS).unionByName(batch.select(*scope, *SILVER_COLUMNS))
    load, wrote = _write(new_fact, track_state(both, scope), root)
    if publish:
        rollups = _roll_up(spark, root, load, wrote, cur, [], state, scope)
        _publish(spark, root, Manifest(cur.version + 1, dates[-1], load, {**cur.facts, **dict.fromkeys(wrote, load)}, rollups))
    return True


def _neighbours(spark: SparkSession, root: str, cur: Manifest, keys: DataFrame, state: DataFrame, first: str,
                last: str, scope: tuple = ()) -> DataFrame:
    """keys with ``_before`` and ``_after``: each track's last snapshot before ``first`` and first one after ``last``.

    Reads the fact between the two dates and from ``last`` on as many dates as the farthest next row
    is away; a track without a later row (the state knows) is not looked for."""
    named = [*scope, ENTITY]
    ends = state.select(*named, F.col(SNAPSHOT).alias("_last"))
    wanted = materialise(_same(keys, ends, named, "left").select(*named, "_last"), "wanted")

    def nearest(dates: list[str], of: DataFrame) -> DataFrame:
        rows = _read_fact(spark, root, {d: cur.facts[d] for d in dates}, state, scope)
        rows = _same(rows.select(*named, SNAPSHOT, "prev_snapshot_date"), of.select(*named), named, "left_semi")
        # of a date's rows the first one has the previous date; a first sighting has none, which sorts first
        return rows.groupBy(*named).agg(F.min(F.struct(SNAPSHOT, "prev_snapshot_date")).alias("_row"))
    inside = nearest([d for d in cur.facts if first <= d <= last], wanted)
    later = sorted(d for d in cur.facts if d > last)
    left, hits, at, width = wanted.where(F.col("_last") > F.lit(last).cast("date")), [], 0, 2
    while at < len(later):
        hits.append(materialise(nearest(later[at:at + width], left), "next-rows"))
        at, width = at + width, 4 * width
        left = _same(left, hits[-1].select(*named), named, "left_anti")
        if at < len(later) and left.isEmpty():
            break
    after = hits[0] if hits else inside.limit(0)
    for h in hits[1:]:
        after = after.unionByName(h)
    both = _same(_same(wanted, inside.withColumnRenamed("_row", "_in"), named, "left"),
                 after.withColumnRenamed("_row", "_next"), named, "left")
    before = (F.when(F.col("_in").isNotNull(), F.col("_in.prev_snapshot_date"))
              .when(F.col("_next").isNotNull(), F.col("_next.prev_snapshot_date")).otherwise(F.col("_last")))
    return materialise(both.select(*named, before.alias("_before"), F.col(f"_next.{SNAPSHOT}").alias("_after")), "neighbours")


def repair(spark: SparkSession, raw: DataFrame, batch_raw: DataFrame, root: str,
           scope: tuple = (), skew: str = "auto", publish: bool = True) -> None:
    """Bring the store up to date after ``batch_raw`` replaced or added
    snapshot dates anywhere in time; ``raw`` is the raw table that already
    holds them. Only affected tracks are recomputed and only the partitions
    with changed rows are written (see module doc)."""
    cur = current(spark, root)
    if cur is None:
        if publish:
            init(spark, raw, root, scope, skew)
        return
    keys = [*scope, ENTITY]
    state = _read_state(spark, root, cur.state)
    batch = M.silver(M.bronze(batch_raw, scope=scope), scope=scope)
    dates = _dates(batch_raw)
    if not dates:
        return
    day = F.col(SNAPSHOT)
    first, last = (F.lit(d).cast("date") for d in (dates[0], dates[-1]))

    def old(of) -> DataFrame:
        return _read_fact(spark, root, {d: x for d, x in cur.facts.items() if d in of}, state, scope)
    held = old(set(dates))
    if scope:
        held = held.join(batch_raw.select(*scope).distinct(), list(scope), "left_semi")
    # The affected tracks, each with its last snapshot before and first one after the batch's dates:
    # nothing outside (before, after] changes. Batch-sized and stored once, so the optimizer
    # broadcasts it if its real size allows.
    affected = _neighbours(spark, root, cur, batch.select(*keys).unionByName(held.select(*keys)).distinct(), state,
                           dates[0], dates[-1], scope)
    ends = sorted({str(r[0]) for r in affected.select(F.explode(F.array("_before", "_after")).alias("d"))
                   .where("d IS NOT NULL").distinct().collect()})  # bounded by the calendar
    # prunes raw's date partitions, or its row groups by their dates
    near = day.between(first, last) | day.isin([date.fromisoformat(d) for d in ends])
    inside = (F.col("_before").isNull() | (day >= F.col("_before"))) & (F.col("_after").isNull() | (day <= F.col("_after")))
    s = _same(M.silver(M.bronze(raw.where(near), scope=scope), scope=scope), affected, keys, "inner").where(inside)
    # the row at ``_before`` only gives the next one its previous values
    own = M.fact(s.drop("_before", "_after"), skew=skew, scope=scope)
    own = _same(own, affected, keys, "inner").where(F.col("_before").isNull() | (day > F.col("_before")))
    new_fact = materialise(own.select(*scope, *FACT_COLUMNS), "repaired-fact")
    follows = F.col("prev_snapshot_date").cast("string").isin(dates)
    # a row that follows a batch date lies among the batch's dates or is a track's first one after them
    among = {d for d in cur.facts if dates[0] <= d <= dates[-1]} | set(ends)
    following = new_fact.where(follows).select(SNAPSHOT).unionByName(
        _same(old(among).where(follows), affected, keys, "inner").select(SNAPSHOT))
    touched = sorted({*dates, *_dates(following)})
    here = day.cast("string").isin(touched)
    kept = _same(old(set(touched)), affected.withColumn("_hit", F.lit(True)), keys, "left").where(
        F.col("_hit").isNull() | (day <= F.col("_before")) | (day > F.col("_after")))
    fact = kept.select(*scope, *FACT_COLUMNS).unionByName(new_fact.where(here))
    # a track with a later snapshot than the batch's keeps its state
    ended = affected.where(F.col("_after").isNull()).withColumn("_hit", F.lit(True))
    old_state = _same(state, ended, keys, "left").where(F.col("_hit").isNull())
    new_state = old_state.select(*scope, *SILVER_COLUMNS).unionByName(
        track_state(s.where(F.col("_after").isNull()), scope))
    load, wrote = _write(fact, new_state, root)  # a date whose rows all went has no folder
    if publish:
        facts = {d: x for d, x in cur.facts.items() if d not in touched}
        facts.update(dict.fromkeys(wrote, load))
        rollups = _roll_up(spark, root, load, wrote, cur, touched, state, scope)
        _publish(spark, root, Manifest(cur.version + 1, max(facts, default=""), load, facts, rollups))


def _same(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """df joined to ``other`` on null-safe equal keys; the keys are df's."""
    named = other.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(named, on, how).drop(*[f"_{k}" for k in keys])


def open_incremental(spark: SparkSession, root: str, scope: tuple = ()) -> Warehouse:
    """Readers of the incremental store as its newest manifest names it."""
    cur = current(spark, root)
    state = _read_state(spark, root, cur.state)
    fact = _read_fact(spark, root, cur.facts, state, scope)
    totals, days = (_read_rollup(spark, root, folder, cur.rollups, like) for folder, like in zip(
        (TOTALS_DIR, DAYS_DIR), _rollups(fact, scope), strict=True))
    return Warehouse(raw=None, silver=None, fact=fact, dim=state.select(*scope, *DIM_TRACK_COLUMNS), totals=totals,
                     days=None if days is None else days.drop("year"))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all manifests but the newest ``keep`` and the load folders none of those
    names (superseded or left by a failed load); returns the removed folders.
    Run it when no load is running and no reader uses an older version."""
    found = _versions(spark, root)
    kept = [_manifest(spark, root, v) for v in found[-keep:]]
    facts = {x for m in kept for x in m.facts.values()}
    states, rollups = {m.state for m in kept}, {x for m in kept for x in m.rollups.values()}
    gone = [os.path.join(root, MANIFEST_DIR, f"v={v}") for v in found[:-keep]]
    for folder, used in ((FACT_DIR, facts), (STATE_DIR, states), (TOTALS_DIR, rollups), (DAYS_DIR, rollups)):
        loads = [n.partition("=")[2] for n in child_folders(spark, os.path.join(root, folder))]
        gone += [os.path.join(root, folder, f"load={x}") for x in loads if x and x not in used]
    for path in gone:
        delete_path(spark, path)
    return gone
