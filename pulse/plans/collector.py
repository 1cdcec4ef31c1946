"""The collection run on stored tables: ingest, pick what is due, take results in.

Fetching is outside: feeds and scrape results arrive as files or tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators import schedule, store
from pulse.schema import STATS, TORRENTS
from pulse.session import cut
from pulse.sources.feed import failed_names


# Stored tables: torrents and their newest readings by the first digit of the key, readings by day.
def _digit() -> Column:
    return F.substring(F.sha1("infohash"), 1, 1)


def _day() -> Column:
    return F.to_date("timestamp")


def ingest(torrents: DataFrame, stats: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add unseen torrents and their first readings; a stored torrent whose name
    cannot be parsed is marked failed. The rows are stored first, as four steps read them. Returns the two tables."""
    rows = cut(rows)
    new_torrents, first_stats = store.feed_to_tables(rows)
    order = [F.col("pubdate"), F.col("filename")]
    torrents = store.mark_status(torrents, failed_names(rows), "guessit_failed")
    all_torrents = torrents.unionByName(
        store.insert_if_absent(torrents, new_torrents, ["infohash"], order).select(*torrents.columns)
    )
    key = ["infohash", "timestamp"]
    all_stats = stats.unionByName(
        store.insert_if_absent(stats, first_stats, key, [F.col("downloads")]).select(*stats.columns)
    )
    return all_torrents, all_stats


def plan_scrape(
    torrents: DataFrame, stats: DataFrame, now: datetime, window_minutes: int = 0,
    batch_size: int = schedule.SCRAPE_BATCH,
) -> DataFrame:
    """(batch, infohash) of what is due, longest unread first."""
    due = schedule.due_items(torrents, stats, now, window_minutes)
    return schedule.batches(due, batch_size).select("batch", "position", "infohash")


def take_results(
    torrents: DataFrame, stats: DataFrame, requested: DataFrame, results: DataFrame,
    succeeded: DataFrame, now: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Store the answered batches at ``now`` and mark dead torrents."""
    filled = schedule.fill_missing(requested, results, succeeded).select(
        "infohash",
        F.timestamp_seconds(F.bround(F.unix_micros(F.lit(now).cast("timestamp")) / 1e6)).alias("timestamp"),
        F.col("seeders").cast("int").alias("seeders"),
        F.col("leechers").cast("int").alias("leechers"),
        F.col("downloads").cast("bigint").alias("downloads"),
    )
    return schedule.collect(torrents, stats, filled)


def create(root: str, torrents: DataFrame, stats: DataFrame) -> None:
    """Write the stored tables: all torrents, all readings, and the newest readings of each torrent."""
    store.with_partition(torrents, ["infohash"], _digit(), "digit").write.partitionBy("digit").parquet(f"{root}/torrents")
    keyed = ["infohash", "timestamp"]
    store.with_partition(stats, keyed, _day(), "day").write.partitionBy("day").parquet(f"{root}/stats")
    newest = store.latest_per_key(stats, ["infohash"], [F.col("timestamp")], schedule.DEAD_AFTER).drop("recency")
    store.with_partition(newest, ["infohash"], _digit(), "digit").write.partitionBy("digit").parquet(f"{root}/newest")


def _stored(spark: SparkSession, root: str, name: str, schema: str, partition: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {partition}").parquet(f"{root}/{name}")


def stored_torrents(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "torrents", TORRENTS, "digit string").drop("digit")


def stored_stats(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "stats", STATS, "day date").drop("day")


def store_readings(root: str, scraped: DataFrame, batch: int | None = None) -> None:
    """Add a batch of readings to the stored tables and mark the torrents that have gone dead.

    Only the days of the readings are rewritten, and of the torrents the partitions of those that died.
    Whether a torrent is dead follows from its newest readings, which are a small table of their own. Each of
    the three steps gives the same when it is run again, so a batch that broke off is finished by another run;
    a batch with a number is noted when it is stored, and another run of it then does nothing.
    """
    spark = scraped.sparkSession
    if batch is not None and store.is_done(spark, root, batch):
        return
    newest = _add_readings(root, scraped)
    _set_status(root, cut(schedule.dead_keys(newest)), "dead")
    if batch is not None:
        store.mark_done(spark, root, batch)


def _add_readings(root: str, scraped: DataFrame) -> DataFrame:
    """Store the readings; the newest readings of their torrents."""
    spark = scraped.sparkSession
    scraped = cut(store.last_per_key(scraped, ["infohash", "timestamp"], [F.col("downloads")]))
    store.upsert_partitions(f"{root}/stats", scraped, ["infohash", "timestamp"], [F.col("downloads")], _day(), "day")
    touched = scraped.select("infohash").distinct()
    newest = _stored(spark, root, "newest", STATS, "digit string")
    # All readings of the partitions that are rewritten: those of other torrents stay as they are.
    digits = touched.select(_digit().alias("digit")).distinct()
    pool = store.upsert(
        newest.join(digits, "digit", "left_semi").select(*scraped.columns), scraped, ["infohash", "timestamp"], [F.col("downloads")]
    )
    kept = cut(store.latest_per_key(pool, ["infohash"], [F.col("timestamp")], schedule.DEAD_AFTER).drop("recency"))
    (
        store.with_partition(kept, ["infohash"], _digit(), "digit")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("digit").parquet(f"{root}/newest")
    )
    return kept.join(touched, "infohash", "left_semi")


def _set_status(root: str, keys: DataFrame, status: str) -> None:
    stored = _stored(keys.sparkSession, root, "torrents", TORRENTS, "digit string")
    digits = keys.select("infohash", _digit().alias("digit"))
    changed = stored.join(digits, ["infohash", "digit"], "left_semi").drop("digit").withColumn("status", F.lit(status))
    store.upsert_partitions(f"{root}/torrents", cut(changed), ["infohash"], [F.col("pubdate")], _digit(), "digit")


def store_feed(root: str, rows: DataFrame) -> None:
    """Add the torrents of a feed that are not stored, with their first readings, and mark stored ones whose
    name can't be parsed. What is stored already stays as it is."""
    spark = rows.sparkSession
    new_torrents, first_stats = store.feed_to_tables(cut(rows))
    torrents = stored_torrents(spark, root)
    failed = cut(failed_names(rows).join(torrents.select("infohash"), "infohash", "left_semi"))
    added = cut(
        store.insert_if_absent(torrents, new_torrents, ["infohash"], [F.col("pubdate"), F.col("filename")]).select(*torrents.columns)
    )
    stats = stored_stats(spark, root).select("infohash", "timestamp")
    first = cut(store.insert_if_absent(stats, first_stats, ["infohash", "timestamp"], [F.col("downloads")]))
    _set_status(root, failed, "guessit_failed")
    store.upsert_partitions(f"{root}/torrents", added, ["infohash"], [F.col("pubdate")], _digit(), "digit")
    _add_readings(root, first)
