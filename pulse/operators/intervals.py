"""Joins of intervals that overlap, as equi joins.

An interval's level is the smallest power of two that holds its length; at its own level and above it lies in one or
two bins. Each side is listed in its bins at its own level and at those higher levels that the other
side has; a pair meets at the higher of its two levels, in the bin in which the later of its starts
lies, and nowhere else. So an interval costs at most two rows for each level there is, however long it is,
and no side is broadcast or scanned for every row of the other.

Bounds are whole numbers, both inside the interval (a point starts and ends at one number). Intervals
with a null bound, or that end before they start, overlap nothing. Repeated rows pair as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.session import cut


def _level(start: Column, end: Column) -> Column:
    """Bits of the length: an interval of level n is shorter than 2^n."""
    return F.when(end > start, F.length(F.bin(end - start))).otherwise(0).cast("int")


def _side(rows: DataFrame, start: str, end: str, on: Sequence[str], name: str) -> DataFrame:
    kept = rows.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    level = _level(F.col(start).cast("bigint"), F.col(end).cast("bigint"))
    return cut(kept.select(
        *[F.col(c) for c in on], F.struct(*[F.col(c) for c in rows.columns if c not in on]).alias(name),
        F.col(start).cast("bigint").alias(f"_{name}_start"), F.col(end).cast("bigint").alias(f"_{name}_end"), level.alias(f"_{name}_level"),
    ))


def _in_bins(side: DataFrame, name: str, levels: list[int]) -> DataFrame:
    """One row for each bin at each of the levels from the interval's own on; a bin of level n is 2^n wide."""
    own = F.col(f"_{name}_level")
    wanted = F.filter(F.array(*[F.lit(n) for n in levels]), lambda n: n >= own)
    listed = side.withColumn("_level", F.explode(wanted))
    shift = lambda value: F.expr(f"shiftright({value}, _level)")
    return listed.withColumn("_bin", F.explode(F.sequence(shift(f"_{name}_start"), shift(f"_{name}_end"))))


def overlapping(
    left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], on: Sequence[str] = ()
) -> DataFrame:
    """Every pair of rows whose intervals share a number, and whose ``on`` columns are equal: the ``on`` columns once, and the
    other columns of each side, whose names must differ."""
    on = list(on)
    sides = _side(left, *left_bounds, on, "a"), _side(right, *right_bounds, on, "b")
    # At most 64 levels on either side.
    levels = sorted({r[0] for side, name in zip(sides, "ab", strict=True) for r in side.select(f"_{name}_level").distinct().collect()})
    if not levels:
        levels = [0]
    binned = [_in_bins(side, name, levels) for side, name in zip(sides, "ab", strict=True)]
    met = binned[0].join(binned[1], [*on, "_level", "_bin"])
    owner = F.expr("shiftright(greatest(_a_start, _b_start), _level)") == F.col("_bin")
    pairs = met.filter(
        (F.col("_level") == F.greatest("_a_level", "_b_level")) & owner
        & (F.col("_a_start") <= F.col("_b_end")) & (F.col("_b_start") <= F.col("_a_end"))
    )
    return pairs.select(*on, "a.*", "b.*")
