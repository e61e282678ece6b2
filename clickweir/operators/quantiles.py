"""Exact interpolated quantiles without gathering the values in one place.

Values are collapsed to ``(key, value, count)`` on the map side; that is the only exchange in which the
values take part. The double that holds a rank is then found digit by digit: first by sign, exponent
and the leading bits of the fraction, then by the bits after these, then by value. At each step
counts per cell are added up, the cells that hold a wanted rank are chosen, and only their values go
on. A cell's number follows from the value alone, so heavy tails and crowded ranges make cells no
larger than the digits allow, and all sizes of input go the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEADING, _NEXT = 64, 1 << 20  # cells per power of two, and cells within one of these
_SHIFT = 1100  # makes the exponents of all doubles positive


def discrete_quantile(value: str, p: float) -> Column:
    """An aggregate: the least value that a share ``p`` of the values does not exceed, as a double. It is exact; its
    state is a count per distinct value, so it is for values of which a group has thousands, such as whole
    milliseconds, however many rows there are. It also runs on a stream."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})")


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: list[str] = (), few_keys: bool = False
) -> DataFrame:
    """One row per key (one row in all without keys): ``n`` values, ``lowest``, ``highest``, then one
    double per entry of ``probs`` (name -> probability), interpolated linearly between neighbours.
    NULL and NaN are no values. A key without values has no row; without keys it gives ``n = 0`` and
    NULLs. ``few_keys`` promises that the number of keys is fixed (such as columns of a table), so
    one-row-per-key frames are broadcast; otherwise joins follow their measured size."""
    # As a struct, keys that are NULL or have NULL parts join like any other.
    number = F.col(value).cast("double") + F.lit(0.0)  # one zero
    values = df.select(*([F.struct(*keys).alias("_key")] if keys else []), number.alias("_v"))
    values = values.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    named, keys = list(keys), ["_key"] if keys else []
    small_side = F.broadcast if few_keys or not keys else (lambda side: side)
    counted = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_count")).withColumns(
        {"_lead": _leading("_v"), "_next": _following("_v")})

    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    cells = counted.groupBy(*keys, "_lead").agg(
        F.sum("_count").alias("_count"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    cells = cells.withColumns({
        "_n": F.sum("_count").over(whole), "_min": F.min("_min").over(whole), "_max": F.max("_max").over(whole),
        "_first": F.lit(0)})
    path, carried = [*keys], ["_n", "_min", "_max", "_first"]
    for digit in ("_lead", "_next"):
        chosen = _holding(cells, path, digit, probs)
        path = [*path, digit]
        chosen = chosen.select(*path, *carried)
        inside = counted.join(small_side(chosen), path)
        deeper = "_next" if digit == "_lead" else "_v"
        cells = inside.groupBy(*path, *carried, deeper).agg(F.sum("_count").alias("_count"))
    last = _holding(cells, path, "_v", probs)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_count")), F.col("_v")))

    picks = []
    for name, p in probs.items():
        lower, upper = _ranks(p, F.col("_n"))
        picks += [at(lower).alias(f"_{name}_lo"), at(upper).alias(f"_{name}_hi")]
    grouped = last.groupBy(*keys) if keys else last.groupBy()
    found = grouped.agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("n"), F.max("_min").alias("lowest"), F.max("_max").alias("highest"), *picks)
    shown = [F.col("_key")[name].alias(name) for name in named]
    return found.select(*shown, "n", "lowest", "highest", *[_between(name, p) for name, p in probs.items()])


def _holding(cells: DataFrame, path: list[str], digit: str, probs: dict[str, float]) -> DataFrame:
    """Cells that hold one of the ranks; ``_first`` becomes the rank of the first value in them."""
    order = Window.partitionBy(*(path or [F.lit(0)])).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_first", F.col("_first") + F.sum("_count").over(order) - F.col("_count"))
    ranks = [rank for p in probs.values() for rank in _ranks(p, F.col("_n"))]
    return placed.filter(reduce(
        lambda a, b: a | b, [(F.col("_first") <= r) & (r < F.col("_first") + F.col("_count")) for r in ranks]))


def _ranks(p: float, n: Column) -> tuple[Column, Column]:
    """The two neighbouring ranks, from 0, that a quantile lies between."""
    place = F.lit(p) * (n - 1)
    return F.floor(place), F.ceil(place)


def _between(name: str, p: float) -> Column:
    lower, upper = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
    place = F.lit(p) * (F.col("n") - 1)
    # Equal neighbours are the answer as they are, infinite ones too.
    return F.when(lower == upper, lower).otherwise(lower + (upper - lower) * (place - F.floor(place))).alias(name)


# Cell numbers are never NULL, and stated so: else the readers of the counts would get filters of
# their own, and the exchange behind them could not be shared.


def _parts(name: str) -> tuple[Column, Column, Column]:
    """Sign, exponent, and the fraction of a finite number other than zero, in units of leading cells. It
    is held to its range, so that an exponent that the logarithm rounds up or down keeps the order."""
    size = F.abs(name)
    exponent = F.floor(F.log2(size))
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * _LEADING
    return F.signum(name), exponent, F.greatest(F.least(fraction, F.lit(_LEADING - 1e-13)), F.lit(0.0))


def _leading(name: str) -> Column:
    sign, exponent, fraction = _parts(name)
    cell = F.floor(fraction)
    value = F.col(name)
    far = F.lit(10 * _SHIFT * _LEADING)
    code = (F.when(value == 0, 0).when(F.abs(value) == float("inf"), far * F.signum(value).cast("int"))
            .otherwise(sign.cast("int") * ((exponent + _SHIFT) * _LEADING + cell)))
    return F.coalesce(code.cast("int"), F.lit(0))


def _following(name: str) -> Column:
    sign, _, fraction = _parts(name)
    cell = F.floor((fraction - F.floor(fraction)) * _NEXT)
    value = F.col(name)
    code = F.when((value == 0) | (F.abs(value) == float("inf")), 0).otherwise(sign.cast("int") * cell)
    return F.coalesce(code.cast("int"), F.lit(0))
