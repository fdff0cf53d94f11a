"""Generic operators: alternative strategies give identical rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from snaptally.operators import (competition_rank, counter_delta, hot_keys, key_violations,
                                 null_violations, top_k)
from snaptally.operators.checks import ContractViolation, assert_contract
from snaptally.plans import models as M
from snaptally.sources.fixture import load_fixture


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    ra = sorted(map(tuple, a.select(*cols).collect()), key=repr)
    rb = sorted(map(tuple, b.select(*cols).collect()), key=repr)
    assert ra == rb


@pytest.fixture(scope="module")
def silver(spark):
    return M.silver(load_fixture(spark, SF_SMALL)).cache()


def test_blocked_delta_equals_plain_window(silver):
    same(M.fact(silver, skew="off"), M.fact(silver, skew="force", block_bits=3))


def test_auto_split_with_hot_key_equals_plain(spark):
    # one pseudo-entity holds most rows: many rows per date, ordered by track id
    rows = [("hot", d, t, d * 100 + t) for d in range(1, 6) for t in range(40)]
    rows += [(f"k{t}", d, t, d + t) for d in range(1, 6) for t in range(10)]
    df = spark.createDataFrame(rows, "k string, d int, tid long, c int")
    assert [r.k for r in hot_keys(df, ["k"], max_keys=4, min_rows=20, fraction=1.0).collect()] == ["hot"]
    plain = counter_delta(df, ["k"], "d", ["c"], tiebreak=["tid"], skew="off")
    auto = counter_delta(df, ["k"], "d", ["c"], tiebreak=["tid"], skew="auto",
                         hot_max_keys=4, hot_min_rows=20, block_bits=2, hot_sample=1.0)
    same(plain, auto)


def test_multi_column_hot_keys(spark):
    rows = [("lib1", "hot", d, t, d * 100 + t) for d in range(1, 4) for t in range(30)]
    rows += [("lib2", "hot", d, 0, d) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "lib string, k string, d int, tid long, c int")
    plain = counter_delta(df, ["lib", "k"], "d", ["c"], tiebreak=["tid"], skew="off")
    auto = counter_delta(df, ["lib", "k"], "d", ["c"], tiebreak=["tid"], hot_max_keys=3,
                         hot_min_rows=10, block_bits=3, hot_sample=1.0)
    same(plain, auto)


def test_hot_key_list_is_bounded(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("k"))
    assert hot_keys(df, ["k"], max_keys=3, min_rows=0, fraction=1.0).count() <= 6


def test_sampled_detection_finds_a_hot_key(spark):
    hot = spark.range(0, 200_000).select(F.lit("hot").alias("k"))
    cold = spark.range(0, 200_000).select(F.col("id").cast("string").alias("k"))
    got = hot_keys(hot.unionByName(cold), ["k"], max_keys=100, min_rows=50_000, fraction=0.05)
    assert [r.k for r in got.collect()] == ["hot"]


def test_latest_by_aggregate_equals_window(silver):
    same(M.dim_track(silver), M.dim_track(silver, method="aggregate"))


@pytest.mark.parametrize("part", [[], ["g"]])
def test_histogram_rank_equals_window_rank(spark, part):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 3), rnd.choice([1, 2, 2, 3, 5, 5, 5, 8])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g int, m int")
    same(competition_rank(df, "m", part), competition_rank(df, "m", part, method="window"))
    same(competition_rank(df, "m", part, max_rank=3),
         top_k(competition_rank(df, "m", part, method="window"), 3))


def test_rank_is_one_plus_strictly_greater(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 7, 7, 7, 1])], "id int, m int")
    got = {r.id: r.rank for r in competition_rank(df, "m").collect()}
    assert got == {0: 1, 1: 1, 2: 3, 3: 3, 4: 3, 5: 6}


def test_results_do_not_depend_on_partitioning(silver):
    a = M.fact(silver.repartition(1))
    b = M.fact(silver.repartition(7, "snapshot_date"))
    same(a, b)


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert [tuple(r) for r in key_violations(df, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in null_violations(df, ["k", "v"]).collect()] == [("v", 1)]
    with pytest.raises(ContractViolation):
        assert_contract(df, ["k"])
    with pytest.raises(ContractViolation):
        assert_contract(df, not_null=["v"])
    assert_contract(df.filter("v IS NOT NULL AND v = 'a' OR k = 2"), ["k"])


def test_order_and_distinct_rollup(spark):
    from snaptally.operators import order_by_rank, positive_rollup
    df = spark.createDataFrame([("a", 1, 2, "t1"), ("a", 2, -1, "t2"), ("b", 3, 5, "t1")],
                               "g string, id int, d int, t string")
    roll = {x.g: (x.plays, x.n_else, x.unique_tracks)
            for x in positive_rollup(df, ["g"], "d", distinct="t").collect()}
    assert roll == {"a": (2, 1, 2), "b": (5, 0, 1)}
    ranked = competition_rank(df, "d")
    assert [x.id for x in order_by_rank(ranked, tiebreak=[F.col("id")]).collect()] == [3, 1, 2]



def test_hot_null_key_and_text_tiebreak(spark):
    rows = [(None, d, f"t{t:03d}", d * 10 + t) for d in range(1, 4) for t in range(25)]
    rows += [("x", d, "t000", d) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "k string, d int, tb string, c int")
    plain = counter_delta(df, ["k"], "d", ["c"], tiebreak=["tb"], skew="off")
    auto = counter_delta(df, ["k"], "d", ["c"], tiebreak=["tb"], hot_max_keys=2,
                         hot_min_rows=10, hot_sample=1.0)
    same(plain, auto)
    same(plain, counter_delta(df, ["k"], "d", ["c"], tiebreak=["tb"], skew="force"))


def test_top_k_with_nine_tenths_tied_at_the_cut(spark):
    from pyspark.sql import functions as F

    from snaptally.operators.rank import competition_rank
    df = spark.range(20_000).select("id", F.when(F.col("id") < 2, 100 - F.col("id")).when(
        F.col("id") % 10 == 0, F.lit(1)).otherwise(F.lit(7)).alias("m")).repartition(8)
    top = competition_rank(df, "m", max_rank=3)
    assert {(r.rank, r.m): r["count"] for r in top.groupBy("rank", "m").count().collect()} == {
        (1, 100): 1, (2, 99): 1, (3, 7): 17_999}
    assert top.rdd.getNumPartitions() > 1  # the tied rows stay where they are
    sizes = top.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 4_000
