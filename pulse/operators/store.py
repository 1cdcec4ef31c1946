"""Keyed writes on plain tables: first wins, last wins, update, skip.

Duplicates are reduced with aggregates (``min_by`` / ``max_by``), which combine
before the shuffle, so any number of copies of one key cost one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.session import cut


def _reduce(rows: DataFrame, key: Sequence[str], pick, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    rest = [c for c in columns if c not in key]
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    kept = rows.groupBy(*key).agg(pick(F.struct(*rest), at).alias("_row"))
    return kept.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*columns)


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _reduce(rows, key, F.min_by, order, rows.columns)


def last_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _reduce(rows, key, F.max_by, order, rows.columns)


def skip_existing(rows: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(target.select(*key), list(key), "left_anti")


def insert_if_absent(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The rows to append: keys the target lacks, the first row of each."""
    return skip_existing(first_per_key(rows, key, order), target, key)


def upsert(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The table after replacing or adding each key's last new row."""
    newest = last_per_key(rows, key, order).select(*target.columns)
    return target.join(newest.select(*key), list(key), "left_anti").unionByName(newest)


def with_partition(rows: DataFrame, key: Sequence[str], partition: Column, name: str) -> DataFrame:
    """Add the partition of each row, an expression of its key alone (any other column fails), so
    a key can never move from one partition to another."""
    rows.select(*key).select(partition)
    return rows.withColumn(name, partition)


def upsert_partitions(
    path: str, rows: DataFrame, key: Sequence[str], order: Sequence[Column], partition: Column, name: str
) -> None:
    """Upsert into a Parquet table that is partitioned by an expression of the key, rewriting only the
    partitions that the new rows fall into.

    The merged partitions are stored before the old ones are replaced, so the
    job never reads what it overwrites.
    """
    rows = with_partition(rows, key, partition, name)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    touched = rows.select(name).distinct()
    old = stored.join(touched, name, "left_semi").select(*rows.columns)
    merged = cut(upsert(old, rows, key, order))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def is_done(spark: SparkSession, root: str, batch: int) -> bool:
    """Whether a numbered step on stored tables has been finished."""
    try:
        return spark.read.schema("id bigint").parquet(f"{root}/_done/{batch}").count() > 0
    except AnalysisException:
        return False


def mark_done(spark: SparkSession, root: str, batch: int) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{root}/_done/{batch}")


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The newest ``limit`` rows per key, numbered from 1. Spark's group limit
    keeps ``limit`` rows per key in each task before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*[c.desc() for c in order])
    return rows.withColumn("recency", F.row_number().over(window)).filter(F.col("recency") <= limit)


def mark_status(target: DataFrame, keys: DataFrame, status: str, key: str = "infohash") -> DataFrame:
    """Set the status of the listed keys; the others keep theirs."""
    marked = keys.select(key).distinct().withColumn("_status", F.lit(status))
    return target.join(marked, key, "left").withColumn(
        "status", F.coalesce("_status", "status")
    ).select(*target.columns)


def feed_to_tables(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ingested rows as a torrent row and a first reading taken at publication."""
    torrents = rows.select(
        "infohash", "filename", "pubdate", "size_bytes", "source_id", "trusted", "remake",
        F.lit("active").alias("status"), "guessit_data",
    )
    stats = rows.select(
        "infohash", F.col("pubdate").alias("timestamp"), F.col("seeders").cast("int"),
        F.col("leechers").cast("int"), "downloads",
    )
    return torrents, stats
