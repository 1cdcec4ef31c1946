"""Ordered windows over readings and over the catalogue.

A key of the readings may hold a large share of all rows, so their window is cut by
calendar day, always: the rows are shuffled once by (key, day) and the window runs within
the day. What crosses midnight is the last value of the day before; it comes from one
row per key and day, which is taken from the same shuffle.

Everything else that is ranked has one row per show (or torrent) and week, season or episode. Its
groups are bounded by the catalogue, so plain windows do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.session import cut

DAY = "_day"


def lag_by_day(
    rows: DataFrame, key: str, at: str, value: str, out: str, dims: DataFrame | None = None
) -> DataFrame:
    """``lag(value)`` per key in order of ``at``; with ``dims`` (one row per key), only of its keys and
    with its columns, which travel with the rows per key and day."""
    # Spark adds these filters to one side of the join below; said for both, the shuffle is one.
    placed = rows.withColumn(DAY, F.to_date(at)).filter(F.col(key).isNotNull() & F.col(DAY).isNotNull())
    shuffled = placed.repartition(key, DAY)
    within = Window.partitionBy(key, DAY).orderBy(at)
    lagged = shuffled.withColumn(out, F.lag(value).over(within)).withColumn(
        "_first", F.row_number().over(within) == 1
    )
    last = shuffled.groupBy(key, DAY).agg(F.max_by(F.struct(F.col(value).alias("v")), at).alias("_last"))
    days = Window.partitionBy(key).orderBy(DAY)
    carried = last.select(key, DAY, F.lag("_last").over(days)["v"].alias("_carry"))
    if dims is not None:
        carried = carried.join(dims, key)
    joined = lagged.join(carried, [key, DAY])
    return joined.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out))).drop(
        "_first", "_carry", DAY
    )


def row_number_over(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, size: str | None = None
) -> DataFrame:
    """``row_number()`` per key in ``order``; ``size`` adds the rows per key."""
    group = Window.partitionBy(*keys)
    result = df.withColumn(out, F.row_number().over(group.orderBy(*order)).cast("bigint"))
    return result.withColumn(size, F.count(F.lit(1)).over(group)) if size else result


ROWS_PER_RANGE = 250_000
_WITHIN = (1 << 33) - 1


def position_in_order(df: DataFrame, order: Sequence[Column], out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Position of every row in one order over the whole table, 1 for the first.

    Rows are dealt over ranges of the order, whose bounds Spark takes from a sample of the rows themselves, sorted
    there and stored; a row's position is that in its range and the rows of the ranges before, of which there
    are as many as tasks. However the values are spread, a range holds about `rows_per_range` rows, if the order
    tells rows apart.
    """
    ranges = max(1, -(-df.count() // rows_per_range))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    position = (F.col("_before") + F.col("_place").bitwiseAND(F.lit(_WITHIN)) + 1).cast("bigint")
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(out, position).drop("_place", "_part", "_before")
