import duckdb
import pytest
from pyspark.sql import functions as F

from snaptally.functions.numeric import ms_to_minutes, round_half_away


def test_minutes_from_ms_match_fixed_cases(spark):
    df = spark.createDataFrame([(5100,), (8700,), (27900,), (None,)], "ms int")
    got = [r[0] for r in df.select(ms_to_minutes("ms")).collect()]
    assert got == [0.09, 0.14, 0.47, None]


def test_exact_half_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.5,), (1.25,), (-1.25,)], "x double")
    r = df.select(round_half_away("x", 0).alias("r0"), round_half_away("x", 1).alias("r1")).collect()
    assert [x.r0 for x in r] == [3.0, -3.0, 1.0, 1.0, -1.0]
    assert [x.r1 for x in r] == [2.5, -2.5, 0.5, 1.3, -1.3]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_rounding_equals_duckdb_on_many_values(spark, n):
    vals = [i / 7.0 + j * 0.005 for i in range(-300, 300) for j in range(3)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_away("x", n)).collect()]
    con = duckdb.connect()
    want = [r[0] for r in con.execute(
        f"SELECT ROUND(x, {n}) FROM (SELECT UNNEST(?::DOUBLE[]) AS x)", [vals]).fetchall()]
    assert got == want


def test_ms_rounding_equals_duckdb_full_range(spark):
    df = spark.range(0, 1_200_001).select(F.col("id").cast("int").alias("ms"))
    got = df.select("ms", ms_to_minutes("ms").alias("v")).toPandas().sort_values("ms")
    want = duckdb.sql("SELECT ms, ROUND(ms / 1000.0 / 60.0, 2) AS v FROM range(0, 1200001) t(ms) "
                      "ORDER BY ms").df()
    assert (got["v"].values == want["v"].values).all()
