"""What to read next, and how the collection is doing. ``now`` is an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import is_infohash
from pulse.functions.times import utc
from pulse.operators.store import latest_per_key, mark_status, upsert
from pulse.operators.windows import ROWS_PER_RANGE, position_in_order

_HOUR, _DAY = 3600, 86400
# Fixed values: (age up to, class, gap between readings), in seconds.
AGE_CLASSES = (
    (2 * _DAY, "hourly", 1 * _HOUR),
    (7 * _DAY, "every_4_hours", 4 * _HOUR),
    (30 * _DAY, "daily", 1 * _DAY),
    (180 * _DAY, "weekly", 7 * _DAY),
)
DEAD_AFTER = 3
SCRAPE_BATCH = 20


def _seconds(now: datetime) -> Column:
    return F.unix_seconds(F.lit(now).cast("timestamp"))


def _age(now: datetime) -> Column:
    return _seconds(now) - F.unix_seconds(utc("pubdate"))


def age_class(now: datetime) -> Column:
    result = F.when(F.col("last_scrape").isNull(), "never_scraped")
    for limit, name, _ in AGE_CLASSES:
        result = result.when(_age(now) <= limit, name)
    return result.otherwise("never")


def is_due(now: datetime, window_minutes: int = 0) -> Column:
    """Never read, or the gap of its age class has passed; a window brings the
    next readings forward."""
    gap = _seconds(now) - F.unix_seconds("last_scrape") + window_minutes * 60
    result = F.when(F.col("last_scrape").isNull(), F.lit(True))
    for limit, _, needed in AGE_CLASSES:
        result = result.when(_age(now) <= limit, gap >= needed)
    return result.otherwise(F.lit(False))


def last_scrapes(stats: DataFrame) -> DataFrame:
    return stats.groupBy("infohash").agg(F.max(utc("timestamp")).alias("last_scrape"))


def with_last_scrape(torrents: DataFrame, stats: DataFrame) -> DataFrame:
    return torrents.join(last_scrapes(stats), "infohash", "left")


def due_items(torrents: DataFrame, stats: DataFrame, now: datetime, window_minutes: int = 0) -> DataFrame:
    """Active items due within the window, unordered; see :func:`in_scrape_order`."""
    return with_last_scrape(torrents.filter(F.col("status") == "active"), stats).filter(
        is_due(now, window_minutes)
    )


def in_scrape_order(due: DataFrame) -> DataFrame:
    return due.orderBy(F.col("last_scrape").asc_nulls_first(), F.asc("infohash"))


def schedule_of(torrents: DataFrame, stats: DataFrame, now: datetime) -> DataFrame:
    """Age, class and due flag of every item, whatever its status."""
    return with_last_scrape(torrents, stats).select(
        "infohash",
        "pubdate",
        "status",
        "last_scrape",
        (_age(now) / _DAY).alias("age_days"),
        age_class(now).alias("schedule_type"),
        is_due(now).alias("is_due"),
    )


def schedule_summary(torrents: DataFrame, stats: DataFrame, now: datetime) -> DataFrame:
    """Counts per class; items that are not active count under their status."""
    kind = F.when(F.col("status") != "active", F.col("status")).otherwise(age_class(now))
    return with_last_scrape(torrents, stats).groupBy(kind.alias("schedule_type")).agg(
        F.count(F.lit(1)).alias("items")
    )


def system_metrics(torrents: DataFrame, stats: DataFrame, now: datetime) -> DataFrame:
    """One row of counts. Each table is aggregated once; the two results are
    stacked and summed."""
    status = F.col("status")
    of_torrents = with_last_scrape(torrents, stats).agg(
        F.count(F.lit(1)).alias("torrents_total"),
        F.count_if(status == "active").alias("torrents_active"),
        F.count_if(status == "dead").alias("torrents_dead"),
        F.count_if(status == "guessit_failed").alias("torrents_guessit_failed"),
        F.count_if((status == "active") & is_due(now)).alias("queue_depth"),
    )
    of_stats = stats.agg(
        F.count(F.lit(1)).alias("stats_total"),
        F.count_if(_seconds(now) - F.unix_seconds(utc("timestamp")) <= _DAY).alias("stats_recent"),
    )
    both = of_torrents.unionByName(of_stats, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def feed_status(torrents: DataFrame, now: datetime, interval_hours: int = 1) -> DataFrame:
    """Newest publication, when the feed is next due, and whether it is due now."""
    latest = F.max(utc("pubdate")).alias("last_feed")
    wait = F.expr(f"INTERVAL {interval_hours} HOURS")
    elapsed = _seconds(now) - F.unix_seconds("last_feed")
    return torrents.agg(latest).select(
        "last_feed",
        (F.col("last_feed") + wait).alias("next_feed"),
        (F.col("last_feed").isNull() | (elapsed >= interval_hours * _HOUR)).alias("should_fetch"),
    )


def batches(due: DataFrame, size: int = SCRAPE_BATCH, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number the due items in scrape order, those never read first, and cut them into batches. An hourly run finds
    most items last read in one hour, so they are numbered in ranges of (last_scrape, infohash), not of time."""
    order = [F.col("last_scrape").asc_nulls_first(), F.col("infohash").asc_nulls_first()]
    numbered = position_in_order(due, order, "position", rows_per_range)
    return numbered.withColumn(
        "batch", (F.floor((F.col("position") - 1) / size) + 1).cast("bigint")
    )


def fill_missing(requested: DataFrame, results: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Readings of the batches that answered: what a result lacks counts as 0.
    A batch that failed yields nothing, so it cannot make an item look dead."""
    counters = ("seeders", "leechers", "downloads")
    asked = requested.filter(is_infohash(F.col("infohash"))).join(
        succeeded.select("batch").distinct(), "batch", "left_semi"
    )
    answered = results.select("infohash", *counters)
    return asked.join(answered, "infohash", "left").select(
        "batch", "infohash", *[F.coalesce(c, F.lit(0)).alias(c) for c in counters]
    )


def dead_keys(stats: DataFrame) -> DataFrame:
    """Keys whose three newest readings exist and are all zero."""
    recent = latest_per_key(stats, ["infohash"], [utc("timestamp")], DEAD_AFTER)
    total = F.sum(F.abs("seeders") + F.abs("leechers") + F.abs("downloads"))
    return (
        recent.groupBy("infohash")
        .agg(F.count(F.lit(1)).alias("_n"), total.alias("_sum"))
        .filter((F.col("_n") == DEAD_AFTER) & (F.col("_sum") == 0))
        .select("infohash")
    )


def collect(torrents: DataFrame, stats: DataFrame, scraped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Store a batch of readings (infohash, timestamp, counters) and mark the
    touched keys that have gone dead. Returns the two tables."""
    stored = upsert(stats, scraped, ["infohash", "timestamp"], [F.col("downloads")])
    touched = scraped.select("infohash").distinct()
    dead = dead_keys(stored.join(touched, "infohash", "left_semi"))
    return mark_status(torrents, dead, "dead"), stored
