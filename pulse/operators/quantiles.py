"""Exact quantiles by position, per group.

Values are numbered in sort order and the needed positions picked, so no group
is gathered into an array or a per-group value map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.windows import row_number_over

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tie: Column,
    named: dict[str, float] = QUARTILES,
    method: str = "linear",
) -> DataFrame:
    """One row per group with a column per quantile.

    ``nearest`` takes the value at the rounded position (n-1)q, halves away from
    zero; ``linear`` interpolates between its neighbours. ``tie`` orders equal
    values, so that a group of equal values can still be split.
    """
    group = list(group)
    valued = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"), tie.alias("_t"))
    placed = row_number_over(valued, group, [F.col("_v"), F.col("_t")], "_n", size="_size")
    at = F.col("_n") - 1
    picks: list[Column] = []
    wanted = F.lit(False)
    outputs: list[Column] = []
    for name, q in named.items():
        position = (F.col("_size") - 1) * F.lit(q)
        low = F.floor(position + 0.5) if method == "nearest" else F.floor(position)
        high = low if method == "nearest" else F.ceil(position)
        wanted = wanted | (at == low) | (at == high)
        picks += [
            F.max(F.when(at == low, F.col("_v"))).alias(f"_{name}_low"),
            F.max(F.when(at == high, F.col("_v"))).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_part"),
        ]
        low_value, high_value = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        between = low_value + (high_value - low_value) * F.col(f"_{name}_part")
        outputs.append((low_value if method == "nearest" else between).alias(name))
    return placed.filter(wanted).groupBy(*group).agg(*picks).select(*group, *outputs)
