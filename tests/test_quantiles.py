import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweir.operators.quantiles import exact_quantiles
from clickweir.operators.rollups import column_profile, histogram, numeric_histogram

PROBS = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99}


def check(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    row = exact_quantiles(df, "v", PROBS).first()
    known = np.array([v for v in values if v is not None], dtype=float)
    assert row.n == len(known)
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(known, p), rel=1e-12), name


def test_small(spark):
    check(spark, [3, 1, None, 2, 10])
    check(spark, [5])
    check(spark, [1, 2])


def test_heavy_tail(spark):
    rng = np.random.default_rng(3)
    check(spark, rng.exponential(1000, 60_000).round(2))


def test_large_with_a_hot_value(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1_000_000, 60_000)
    values[rng.random(60_000) < 0.34] = 42
    check(spark, values)


def test_signs_zeros_and_extremes(spark):
    rng = np.random.default_rng(5)
    check(spark, [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, 2.0, 4.0, np.nextafter(4.0, 0), *rng.normal(0, 1e-3, 3000)])
    check(spark, 1e6 + rng.integers(0, 9, 5000) * 1e-10)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    row = exact_quantiles(df, "v", {"m": 0.5}).first()
    assert (row.n, row.highest, row.m) == (2, 3.0, 2.0)
    ends = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,)], "v double")
    row = exact_quantiles(ends, "v", {"a": 0.0, "m": 0.5, "z": 1.0}).first()
    assert (row.a, row.m, row.z) == (float("-inf"), 1.0, float("inf"))


def test_values_are_exchanged_once_and_combined_first(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.rand(1).alias("v"))
    plan = exact_quantiles(df, "v", {"m": 0.5}, ["k"])._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.splitlines() if "Range (0, 1000" in line or "rand(1)" in line]
    assert "HashAggregate(keys=[_key" in plan and below
    scans = plan.split("Range (0, 1000")
    assert all("partial_count" in part for part in scans[:-1])


def test_constant(spark):
    check(spark, [7] * 30_000)


def test_none_at_all(spark):
    df = spark.createDataFrame([(None,)], "v double")
    row = exact_quantiles(df, "v", {"m": 0.5}).first()
    assert (row.n, row.m) == (0, None)


def test_per_key(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(10_007)).alias("v"))
    got = {r.k: r for r in exact_quantiles(df, "v", {"p95": 0.95, "p50": 0.5}, ["k"]).collect()}
    want = df.groupBy("k").agg(F.percentile("v", 0.95).alias("p95"), F.percentile("v", 0.5).alias("p50"))
    for row in want.collect():
        assert got[row.k].p95 == pytest.approx(row.p95) and got[row.k].p50 == pytest.approx(row.p50)


def test_null_keys_are_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "k string, v double")
    got = {r.k: r.m for r in exact_quantiles(df, "v", {"m": 0.5}, ["k"]).collect()}
    assert got == {"a": 1.0, None: 3.0}
    broadcast = exact_quantiles(df, "v", {"m": 0.5}, ["k"], few_keys=True).collect()
    assert {r.k: r.m for r in broadcast} == got


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)], "v double")
    assert [r["count"] for r in histogram(df, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 2]
    flat = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r["count"] for r in histogram(flat, "v", 3).orderBy("bin").collect()] == [2, 0, 0]
    none = spark.createDataFrame([(None,)], "v double")
    assert histogram(none, "v", 3).count() == 0


def test_profile_and_histogram_with_nan_and_two_zeros(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (4.0,), (None,)], "v double")
    row = column_profile(df).first()
    assert (row.nulls, row.distinct, row["max"], row["mean"], row["median"]) == (2, 2, 4.0, 4 / 3, 0.0)
    assert [r["count"] for r in numeric_histogram(df, "v").orderBy("bin").collect()] == [2, 1]
