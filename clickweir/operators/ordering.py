"""Per-group ordering that survives hot groups.

A window partitioned by session or user puts all rows of that group into one task. Here each group
is cut into time slices. Rows are ordered inside ``(group, slice)``, which is the only wide shuffle;
one narrow summary row per slice carries the state (rows so far, last timestamp, visits so far)
from slice to slice, and is joined back on the same key, so the wide side is not moved again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.settings import SESSION_GAP_SECONDS, SLICE_SECONDS


_SHARES = 4096  # of rows without a user


def slice_width(rows: int, seconds: int, rows_per_slice: int = 2_000_000, widest: float = SLICE_SECONDS) -> float:
    """Slice width for an input of ``rows`` over ``seconds``, such that a group with a third of all
    rows has about ``rows_per_slice`` of them in each slice; at least a microsecond, at most ``widest``. The
    wider the slices, the fewer summary rows are shuffled: narrow ones hold hardly an event each."""
    per_second = rows / 3 / max(seconds, 1)
    return max(1e-6, min(float(widest), rows_per_slice / max(per_second, 1e-9)))


def _sliced(df: DataFrame, group: list[str], ts: str, slice_seconds: float) -> tuple[DataFrame, list[str]]:
    """Add key columns of the group (never NULL; NULLs form one group of their own) and ``_slice``;
    also returns the names of the key columns."""
    keys = {
        f"_key{i}": F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("~"))
        for i, name in enumerate(group)
    }
    # Rows without a time come first, as in any order by it; no row is lost to the join by slice.
    width = max(1, round(slice_seconds * 1_000_000))
    part = F.coalesce(F.floor(F.unix_micros(F.col(ts)) / F.lit(width)), F.lit(-(2**62)))
    return df.withColumns({**keys, "_slice": part}), list(keys)


def number_in_group(
    df: DataFrame,
    group: list[str],
    out: str,
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    slice_seconds: float | None = SLICE_SECONDS,
) -> DataFrame:
    """1, 2, 3, ... within each group by ``ts`` then ``tiebreak``; NULL groups number as one. Without ``slice_seconds`` groups are
    not cut: for those known to be small, whose rows are then asked for once, not again for the counts of their slices."""
    rows, keys = _sliced(df, group, ts, slice_seconds or SLICE_SECONDS)
    if slice_seconds is None:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(ts, tiebreak)).cast("bigint")).drop(*keys, "_slice")
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts, tiebreak)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only slices with earlier rows are joined back; most sessions lie within one slice.
    offsets = (
        rows.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_slice", F.sum("_rows").over(earlier).alias("_before"))
        .filter(F.col("_before") > 0)
    )
    return (
        rows.withColumn(out, F.row_number().over(inside).cast("bigint"))
        .join(offsets, [*keys, "_slice"], "left")
        .withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0)))
        .drop(*keys, "_slice", "_before")
    )


def visits(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    gap_seconds: int = SESSION_GAP_SECONDS,
    out: str = "session_id",
    slice_seconds: float = SLICE_SECONDS,
) -> DataFrame:
    """Sessions by silence: an event joins its user's open visit iff it comes less than
    ``gap_seconds`` after the one before. ``out`` becomes ``<user>-<n>``; NULL users get NULL, so
    their order does not matter and they are spread over shares of their own."""
    gap = gap_seconds * 1_000_000

    def breaks(previous, current):
        return F.unix_micros(current) - F.unix_micros(previous) >= gap

    rows, keys = _sliced(df, [user], ts, slice_seconds)
    share = F.pmod(F.xxhash64(F.col(ts), F.col(tiebreak)), F.lit(_SHARES))
    rows = rows.withColumn("_slice", F.when(F.col(user).isNull(), share).otherwise(F.col("_slice")))
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts, tiebreak)
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)

    # Breaks between the events of a slice, then the breaks between slices.
    opens = F.coalesce(breaks(F.lag(ts).over(inside), F.col(ts)), F.lit(False)).cast("int")
    marked = rows.withColumn("_opens", opens)
    head = F.coalesce(breaks(F.lag("_last").over(by_slice), F.col("_first")), F.lit(True)).cast("int")
    before = F.coalesce(F.sum(F.col("_head") + F.col("_inner")).over(earlier), F.lit(0))
    slices = (
        marked.groupBy(*keys, "_slice")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("_opens").alias("_inner"))
        .withColumn("_head", head)
        .select(*keys, "_slice", (F.col("_head") + before).alias("_base"))
    )
    return (
        marked.withColumn("_run", F.sum("_opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(slices, [*keys, "_slice"])
        .withColumn(out, F.concat(F.col(user), F.lit("-"), (F.col("_base") + F.col("_run")).cast("string")))
        .drop(*keys, "_slice", "_opens", "_run", "_base")
    )
