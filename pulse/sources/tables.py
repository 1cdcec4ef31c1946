"""Reading the stored tables. Filters and columns reach the Parquet scan."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.times import utc
from pulse.schema import STATS, TORRENTS


def read_table(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Stored JSON lines or Parquet under a fixed schema. ``strict`` fails on a
    row that does not fit (JSON only)."""
    if path.rstrip("/").endswith((".json", ".jsonl")):
        mode = "FAILFAST" if strict else "PERMISSIVE"
        return spark.read.schema(schema).option("mode", mode).json(path)
    return spark.read.schema(schema).parquet(path)


def read_torrents(spark: SparkSession, path: str, min_date: date | datetime | None = None) -> DataFrame:
    return usable_torrents(read_table(spark, path, TORRENTS), min_date)


def usable_torrents(torrents: DataFrame, min_date: date | datetime | None = None) -> DataFrame:
    """Parsed torrents published on or after ``min_date``."""
    status = F.col("status")
    kept = torrents.filter(
        (status.isNull() | (status != "guessit_failed")) & F.col("guessit_data").isNotNull()
    )
    return kept if min_date is None else kept.filter(F.col("pubdate") >= F.lit(min_date).cast("timestamp"))


def read_stats(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    return stats_of(read_table(spark, path, STATS), keys)


def stats_of(stats: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Readings of the given keys; a semi join, so no key list passes the driver."""
    rows = stats.withColumn("timestamp", utc("timestamp"))
    if keys is None:
        return rows
    return rows.join(keys.select("infohash").distinct(), "infohash", "left_semi")
