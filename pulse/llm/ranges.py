"""Places in a total order of all rows, without one task that holds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.session import cut

_WITHIN = (1 << 33) - 1


def ranked(df: DataFrame, order: list[Column], name: str = "rank", rows_per_task: int = 250_000) -> DataFrame:
    """Add 1, 2, 3, ... in the order given, which must tell all rows apart.

    Rows are dealt over ranges of the order and sorted there; a row's place is that in its range and the rows of
    the ranges before, of which there are as many as tasks.
    """
    parts = max(1, -(-df.count() // rows_per_task))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("place_", F.monotonically_increasing_id()))
    part = F.shiftright("place_", 33)
    counts = placed.groupBy(part.alias("part_")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part_", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_"))
    rank = F.col("before_") + F.col("place_").bitwiseAND(F.lit(_WITHIN)) + 1
    return placed.withColumn("part_", part).join(starts, "part_").withColumn(name, rank).drop("part_", "place_", "before_")
