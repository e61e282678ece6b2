"""Sliced ordering against brute force, with groups that hold a third of all rows."""

import random
from datetime import timedelta

import pytest
from support import at
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickweir.operators.ordering import number_in_group, slice_width, visits


def skewed(spark, n=3000, seed=7):
    rng, start = random.Random(seed), at("2024-01-01")
    rows = []
    for i in range(n):
        pick = rng.random()
        user = None if pick < 0.34 else ("hot" if pick < 0.67 else f"u{rng.randrange(200)}")
        # Coarse times, so that ties and exact gaps occur.
        rows.append((f"e{i:05d}", user, start + timedelta(minutes=10 * rng.randrange(3000))))
    return spark.createDataFrame(rows, "event_id string, user_id string, timestamp timestamp"), rows


@pytest.mark.parametrize("width", [60, 300, 86400])
def test_numbers_equal_a_plain_window(spark, width):
    df, _ = skewed(spark)
    plain = df.withColumn("want", F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "event_id")))
    got = number_in_group(plain, ["user_id"], "n", slice_seconds=width)
    assert got.count() == 3000 and got.filter("n <> want").count() == 0


def test_two_keys_and_empty_string_is_not_null(spark):
    rows = [("1", "", at("2024-01-01")), ("2", None, at("2024-01-01")), ("3", "", at("2024-01-02"))]
    df = spark.createDataFrame(rows, "event_id string, user_id string, timestamp timestamp")
    day = df.withColumn("day", F.to_date("timestamp").cast("string"))
    assert {r.event_id: r.n for r in number_in_group(df, ["user_id"], "n").collect()} == {"1": 1, "2": 1, "3": 2}
    assert {r.n for r in number_in_group(day, ["user_id", "day"], "n").collect()} == {1}


@pytest.mark.parametrize("width", [60, 300, 86400])
def test_visits_equal_brute_force(spark, width):
    df, rows = skewed(spark)
    want, last, number = {}, {}, {}
    for event_id, user, when in sorted(rows, key=lambda r: (r[2], r[0])):
        if user is None:
            want[event_id] = None
            continue
        if user not in last or (when - last[user]).total_seconds() >= 1800:
            number[user] = number.get(user, 0) + 1
        last[user] = when
        want[event_id] = f"{user}-{number[user]}"
    got = {r.event_id: r.session_id for r in visits(df, slice_seconds=width).collect()}
    assert got == want


def test_rows_without_time_are_kept(spark):
    rows = [("1", "u", None), ("2", "u", at("2024-01-01")), ("3", None, None)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, timestamp timestamp")
    assert {r.event_id: r.n for r in number_in_group(df, ["user_id"], "n").collect()} == {"1": 1, "2": 2, "3": 1}
    assert visits(df).count() == 3


def test_gap_is_strict(spark):
    rows = [("1", "u", at("2024-01-01 00:00:00")), ("2", "u", at("2024-01-01 00:29:59")),
            ("3", "u", at("2024-01-01 00:59:59"))]
    df = spark.createDataFrame(rows, "event_id string, user_id string, timestamp timestamp")
    assert {r.event_id: r.session_id for r in visits(df).collect()} == {"1": "u-1", "2": "u-1", "3": "u-2"}


def test_slice_width():
    assert slice_width(100_000, 86400) == 300
    assert slice_width(200_000_000_000, 86400) == pytest.approx(2.592)
    assert slice_width(10**13, 86400) == pytest.approx(0.05184)
    assert slice_width(10**13, 1) == 1e-6


def test_a_third_of_the_rows_in_one_second(spark):
    """Slices of a millisecond and shares of rows without a user give the same numbers as one window."""
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("u"), (F.col("id") % 4).cast("string"))).alias("user_id"),
        F.timestamp_micros(F.when(F.col("id") % 3 == 1, 1_700_000_000_000_000 + F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
                           .otherwise(1_700_000_000_000_000 + F.pmod(F.xxhash64("id"), F.lit(10**12)))).alias("timestamp"))
    for width in (0.001, 300):
        got = number_in_group(rows, ["user_id"], "n", slice_seconds=width)
        plain = F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "event_id"))
        assert got.withColumn("want", plain).filter("n <> want").count() == 0
        seen = visits(rows, gap_seconds=60, slice_seconds=width)
        assert seen.count() == 6000 and seen.filter("user_id is null and session_id is not null").count() == 0
    fine, coarse = (visits(rows, gap_seconds=60, slice_seconds=w).select("event_id", "session_id") for w in (0.001, 300))
    assert fine.exceptAll(coarse).count() == 0


def test_groups_that_are_not_cut(spark):
    """Rows without a time come first and NULL groups number as one, as with slices."""
    rows = spark.sql("""SELECT CAST(id AS string) AS event_id, IF(id % 3 = 0, NULL, CONCAT('s', id % 5)) AS user_id,
        IF(id % 7 = 0, NULL, TIMESTAMP_SECONDS(1700000000 + (id * 7919) % 4000)) AS timestamp FROM RANGE(500)""")
    whole, cut = (number_in_group(rows, ["user_id"], "n", slice_seconds=w) for w in (None, 60))
    assert whole.columns == cut.columns
    assert whole.exceptAll(cut).count() == cut.exceptAll(whole).count() == 0
