"""Movie downloads: 7-day buckets since the first release, no episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.times import week_start_date, weeks_since
from pulse.operators.series import with_first_release
from pulse.sources.tables import usable_torrents


def movie_torrents(torrents: DataFrame, matches: DataFrame, min_date=None) -> DataFrame:
    """Matched torrents; an episode number is not required."""
    return usable_torrents(torrents, min_date).join(
        matches.select("infohash", "anilist_id"), "infohash"
    )


def movie_dims(torrents: DataFrame) -> DataFrame:
    """What the deltas of a torrent need for its movie's series."""
    return with_first_release(torrents, ("anilist_id",)).select("infohash", "anilist_id", "first_datetime")


def movie_series(deltas: DataFrame) -> DataFrame:
    """Downloads per movie and week since release, with the running total, from deltas with the
    columns of :func:`movie_dims`. A movie has one row per week of history."""
    weekly = deltas.groupBy(
        "anilist_id",
        "first_datetime",
        weeks_since(F.col("timestamp"), F.col("first_datetime")).alias("weeks_since_release"),
    ).agg(
        F.sum("downloads_delta").alias("downloads_weekly"),
        F.min(week_start_date(F.col("timestamp"))).alias("week_start"),
    )
    running = Window.partitionBy("anilist_id").orderBy("weeks_since_release").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return weekly.withColumn("downloads_cumulative", F.sum("downloads_weekly").over(running))


def movie_totals(series: DataFrame) -> DataFrame:
    """Final total and first release date per movie."""
    return series.groupBy("anilist_id").agg(
        F.max_by("downloads_cumulative", "weeks_since_release").alias("total_downloads"),
        F.date_format(F.min("first_datetime"), "yyyy-MM-dd").alias("first_torrent_date"),
        F.count(F.lit(1)).alias("weeks"),
    )


def torrent_counts(torrents: DataFrame) -> DataFrame:
    return torrents.groupBy("anilist_id").agg(F.count(F.lit(1)).alias("torrent_count"))
