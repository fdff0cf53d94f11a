"""Benchmark: ingest, warehouse build and every report at $BENCH_SF_DIR.

Runs on local[$BENCH_CPUS]. Layout follows the reference's own run: the raw
snapshot table is stored once (ingest), silver / fact / dimension are built
(its ``dbt run``), then each report is queried. Each report is timed as the
median of $BENCH_REPEAT runs after one warm-up; ingest and build once.
Also times the DuckDB SQL of the same reports on the same tables as a
single-node yardstick, and a synthetic year of daily snapshots
($BENCH_YEAR_TRACKS tracks, 365 dates; 50,000 make the 18.25 million rows of the
reference's own estimate): plain and bucketed builds, histogram and window ranks,
an append, a late day, and file ingest. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))
YEAR_TRACKS = int(os.environ.get("BENCH_YEAR_TRACKS", "4000"))


def _sf(d: str) -> float | str:
    b = os.path.basename(os.path.normpath(d))
    try:
        return float(b.replace("sf", ""))
    except ValueError:
        return b


def main() -> None:
    from snaptally.plans.catalog import QUERIES
    from snaptally.plans.warehouse import build, report_views
    from snaptally.session import build_session
    from snaptally.sources import store
    from snaptally.sources.fixture import load_fixture

    work = tempfile.mkdtemp(prefix="snaptally-bench-")
    inputs = sum(os.path.getsize(os.path.join(SF_DIR, f"{t}.parquet"))
                 for t in ("lineitem", "part", "orders", "events"))
    spark = build_session(f"local[{CPUS}]", input_bytes=inputs, total_cores=CPUS,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(work, "ckpt"),
                                 "spark.sql.warehouse.dir": os.path.join(work, "catalog")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(df) -> float:
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times: dict[str, float] = {}
    duck: dict[str, float] = {}
    errors: list[str] = []
    paths: dict[str, str] = {}
    notes: list[str] = []

    def sections() -> None:
        # JVM and Python-worker warm-up, so the first timed step is not charged for it
        spark.read.parquet(os.path.join(SF_DIR, "part.parquet")).groupBy("p_size").count().collect()

        t = time.perf_counter()
        raw_path = os.path.join(work, "raw")
        store.replace_snapshot(load_fixture(spark, SF_DIR), raw_path, check=False)
        times["ingest_raw"] = time.perf_counter() - t
        paths["raw"] = raw_path
        raw = store.read_raw(spark, raw_path)

        t = time.perf_counter()
        # fact and dimension bucketed by track: reports roll up and join without a shuffle
        wh = build(spark, raw, os.path.join(work, "wh"), buckets=CPUS)
        times["build_gold"] = time.perf_counter() - t

        views = report_views(wh)
        from snaptally.plans import reports as R
        views["top_songs_rank_window"] = R.top_songs(wh.plays, wh.dim, method="window")
        for name, df in views.items():
            run(df)  # warm-up
            times[name] = statistics.median(run(df) for _ in range(REPEAT))

        # incremental: load through 2000, then time appending the 2001 snapshots
        from pyspark.sql import functions as F

        from snaptally.plans import incremental
        inc_root = os.path.join(work, "incremental")
        t = time.perf_counter()
        incremental.init(spark, raw.filter(F.year("snapshot_date") <= 2000), inc_root)
        times["incremental_init_to_2000"] = time.perf_counter() - t
        t = time.perf_counter()
        incremental.append(spark, raw.filter(F.year("snapshot_date") >= 2001), inc_root)
        times["incremental_append_2001"] = time.perf_counter() - t
        # 1998 re-exported (every track present again): repair the affected tracks only
        t = time.perf_counter()
        incremental.repair(spark, raw, raw.filter(F.year("snapshot_date") == 1998), inc_root)
        times["incremental_repair_1998"] = time.perf_counter() - t

        # every library's replay in one job: raw keyed by library, scoped build and reports
        from snaptally.sources.fixture import load_library_fixture
        lib = ("library_id",)
        t = time.perf_counter()
        lib_path = os.path.join(work, "raw_libraries")
        store.replace_snapshot(load_library_fixture(spark, SF_DIR), lib_path, check=False, scope=lib)
        lib_raw = store.read_raw(spark, lib_path, lib)
        lwh = build(spark, lib_raw, os.path.join(work, "wh_libraries"), buckets=CPUS, scope=lib)
        times["library_build"] = time.perf_counter() - t
        paths["lib"] = lib_path
        lib_views = {"library_summary": R.summary(lwh.plays, lwh.dim, scope=lib),
                     "library_top_artists": R.top_artists(lwh.plays, lwh.dim, scope=lib),
                     "library_top_songs": R.top_songs(lwh.plays, lwh.dim, scope=lib)}
        for name, df in lib_views.items():
            run(df)
            times[name] = statistics.median(run(df) for _ in range(REPEAT))

        for name in ("hourly_listening", "event_counter_delta"):
            fn = QUERIES[name]
            run(fn(spark, SF_DIR))
            times[name] = statistics.median(run(fn(spark, SF_DIR)) for _ in range(REPEAT))

    year: dict[str, float] = {}

    def year_section() -> None:
        """A synthetic year: every track in each of 365 daily snapshots."""
        from pyspark.sql import functions as F

        from snaptally.plans import incremental
        from snaptally.plans import reports as R
        from snaptally.schema import RAW_COLUMNS, RAW_SCHEMA
        from snaptally.sources import csvfile, plist
        root = os.path.join(work, "year")
        n = YEAR_TRACKS

        def timed(name: str, fn):
            t = time.perf_counter()
            out = fn()
            year[name] = round(time.perf_counter() - t, 3)
            return out
        i, d = F.col("id") % n, F.floor(F.col("id") / n).cast("int")
        made = {"snapshot_date": F.date_add(F.lit("2024-01-01").cast("date"), d), "snapshot_path": F.lit("year"),
                "track_id": i, "name": F.concat(F.lit("Song "), i), "artist": F.concat(F.lit("Artist "), i % 997),
                "album": F.concat(F.lit("Album "), i % 4999), "genre": F.concat(F.lit("Genre "), i % 23),
                "total_time": 120_000 + (i * 7919) % 200_000, "play_count": F.floor(d * (i % 13) / 24),
                "skip_count": F.floor(d * (i % 5) / 60), "persistent_id": F.lpad(F.hex(i + 1), 16, "0"),
                "play_date_utc": F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")}
        rows = spark.range(0, n * 365, 1, CPUS * 8).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(
            f.name) for f in RAW_SCHEMA.fields])
        raw_path = os.path.join(root, "raw")
        timed("year_ingest", lambda: store.replace_snapshot(rows, raw_path))
        raw = store.read_raw(spark, raw_path)
        plain = timed("year_build_plain", lambda: build(spark, raw, os.path.join(root, "plain")))
        bucketed = timed("year_build_bucketed", lambda: build(spark, raw, os.path.join(root, "bucketed"), buckets=CPUS))
        for name, w in (("plain", plain), ("bucketed", bucketed)):
            for method in ("histogram", "window"):
                df = R.top_songs(w.plays, w.dim, method=method)
                run(df)
                year[f"year_top_songs_{name}_{method}"] = round(statistics.median(run(df) for _ in range(REPEAT)), 3)
            df = R.top_artists(w.fact, w.dim)
            run(df)
            year[f"year_top_artists_from_fact_{name}"] = round(run(df), 3)
            df = R.replay_page(w.plays, w.dim)
            run(df)
            year[f"year_replay_page_{name}"] = round(run(df), 3)
        inc, day = os.path.join(root, "incremental"), F.col("snapshot_date")
        late, last = F.lit("2024-07-01").cast("date"), F.lit("2024-12-30").cast("date")
        timed("year_incremental_init", lambda: incremental.init(spark, raw.where((day != late) & (day < last)), inc))
        timed("year_append_day", lambda: incremental.append(spark, raw.where(day == last), inc))
        timed("year_repair_late_day", lambda: incremental.repair(spark, raw, raw.where(day == late), inc))
        one = raw.where(day == last).select(*RAW_COLUMNS)
        for name, mod, write, read in (
                ("plist", plist, plist.write_plist_snapshots, lambda p: plist.plist_snapshots(spark, p, glob="part-*")),
                ("csv", csvfile, csvfile.write_csv_snapshots, lambda p: csvfile.csv_snapshots(spark, p))):
            out = os.path.join(root, name)
            write(one, out)
            timed(f"year_{name}_day", lambda out=out, read=read, name=name: store.replace_snapshot(
                read(out), os.path.join(root, f"raw_{name}")))
        notes.append(f"year: {n * 365} rows")

    for part in (sections, year_section) if YEAR_TRACKS else (sections,):
        try:
            part()
        except Exception as e:  # keep the numbers measured so far
            errors.append(f"{type(e).__name__}: {str(e)[:300]}")
    reports = {k: v for k, v in times.items()
               if k not in ("ingest_raw", "build_gold", "library_build",
                            "incremental_init_to_2000", "incremental_append_2001",
                            "incremental_repair_1998")}
    if "raw" in paths:
        try:
            duck = _duckdb_times(list(reports), paths["raw"], paths.get("lib"))
        except Exception as e:
            errors.append(f"DuckDB: {type(e).__name__}: {str(e)[:300]}")
    spark.stop()
    out = {
        "metric": "ingest_build_and_reports_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "reports_total_sec": round(sum(reports.values()), 3),
        "duckdb_same_sql_sec": duck,
        "synthetic_year_sec": year,
        "notes": notes,
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "repeat": REPEAT,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


def _duckdb_layout(raw_path: str, lib: str = ""):
    """A DuckDB connection holding raw, silver and fact tables built the way
    the reference builds them (the dimension is a view); returns
    (connection, load sec, build sec)."""
    import duckdb

    from snaptally import oracle as O
    con = duckdb.connect()
    for t in ("part", "lineitem", "events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    t0 = time.perf_counter()
    con.execute(f"CREATE TABLE raw AS SELECT * FROM read_parquet('{raw_path}/**/*.parquet', "
                "hive_partitioning = true)")
    t1 = time.perf_counter()
    for name, cte in O.layers(lib).items():
        if name != "raw":
            kind = "TABLE" if name in ("silver", "fact") else "VIEW"
            con.execute(f"CREATE {kind} {name} AS {cte[cte.index('('):]}")
    return con, t1 - t0, time.perf_counter() - t1


def _plain_rank(sql: str) -> str:
    """The oracle's counting rank as DuckDB's own window rank, which is faster."""
    def window(m: re.Match) -> str:
        within = re.findall(r"o\.(\w+) = g\.\1", m.group(0))
        part = f"PARTITION BY {', '.join(within)} " if within else ""
        return f"RANK() OVER ({part}ORDER BY play_count DESC) AS rank"
    return re.sub(r"1 \+ \(SELECT COUNT\(\*\) FROM groups o WHERE [^)]*\) AS rank", window, sql)


def _duckdb_times(names: list[str], raw_path: str, lib_path: str | None) -> dict[str, float]:
    """The same reports in DuckDB on the same stored raw tables, laid out as
    the reference runs them: silver and fact as tables (build timed once),
    the dimension and the reports as views."""
    from snaptally import oracle as O
    con, load, build_s = _duckdb_layout(raw_path)
    res = {"ingest_raw": round(load, 3), "build_gold": round(build_s, 3)}
    lcon = None
    if lib_path:
        lcon, _, lbuild = _duckdb_layout(lib_path, "library_id, ")
        res["library_build"] = round(lbuild, 3)
    for n in names:
        if n not in O.ORACLE or (n.startswith("library_") and n != "library_overview" and lcon is None):
            continue
        scoped = n in ("library_summary", "library_top_artists", "library_top_songs")
        sql = O.ORACLE[n]
        for gold in (O.LIB_GOLD, O.GOLD, f"WITH {O.RAW_CTE}"):
            sql = sql.replace(gold + ",", "WITH").replace(gold, "")
        c, sql = (lcon if scoped else con), _plain_rank(sql)
        c.execute(sql).fetchall()
        ts = []
        for _ in range(REPEAT):
            t = time.perf_counter()
            c.execute(sql).fetchall()
            ts.append(time.perf_counter() - t)
        res[n] = round(statistics.median(ts), 3)
    return res


if __name__ == "__main__":
    main()
