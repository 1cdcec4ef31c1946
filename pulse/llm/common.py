"""What the corpus operators share: saved tables, row numbers within groups, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.session import cut


def bounded_batches(spark: SparkSession) -> None:
    """Python tasks take their rows in batches of a few megabytes, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def plain(column: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, key: str, order: Sequence[str], rows_per_task: int = 250_000) -> DataFrame:
    """Add `rank`: 0, 1, 2, ... within each key, in no meaningful order.

    The rows of a key are dealt over salts, numbered within (key, salt), and moved by the
    rows of the salts before; the number of salts follows the number of rows, so that a
    key with a third of all rows stays far below one task's memory. `order` makes
    the numbers repeatable; rows equal in it are interchangeable.
    """
    salts = max(8, -(-df.count() // rows_per_task))
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = salted.groupBy(key, "salt").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(key).orderBy("salt")) - F.col("rows")
    starts = counts.select(key, "salt", before.alias("before"))
    within = F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order)) - 1
    return (
        salted.withColumn("within", within)
        .join(starts, [key, "salt"])
        .withColumn("rank", (F.col("before") + F.col("within")).cast("long"))
        .drop("salt", "before", "within")
    )


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of a partition sorted by the keys, cut where a group ends."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        at = len(frame) - int(last[::-1].argmin()) if not last.all() else 0
        if at:
            yield frame.iloc[:at].reset_index(drop=True)
        rest = frame.iloc[at:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every linked id: the smallest id that it is connected to.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until nothing
    changes. Each step keeps at most the links that came in; both are an aggregate
    and a join on the id, and each round is a written table.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select("v", F.col("v").alias("component")).distinct()
            )
        state = tuple(seen)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(least).distinct())
