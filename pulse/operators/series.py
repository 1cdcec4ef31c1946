"""Counter readings to download series.

Readings are cumulative; a key's first reading is its baseline and counts 0,
and after a drop the lower value is the next baseline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.metadata import aggregation_episode
from pulse.functions.times import hours_since, time_bucket, utc, week_label
from pulse.operators.windows import lag_by_day
from pulse.sources.tables import usable_torrents

SHOW_FIELDS = ("title", "title_romaji", "cover_image_url", "cover_image_color")


def counter_deltas(readings: DataFrame, torrents: DataFrame | None = None) -> DataFrame:
    """infohash, timestamp, downloads_delta; of the given torrents only and with their columns, if given.

    The readings are read and shuffled once, by key and day.
    """
    narrow = readings.select("infohash", utc("timestamp").alias("timestamp"), "downloads")
    lagged = lag_by_day(narrow, "infohash", "timestamp", "downloads", "_previous", torrents)
    grown = F.col("downloads") - F.col("_previous")
    own = [] if torrents is None else [c for c in torrents.columns if c != "infohash"]
    return lagged.select("infohash", "timestamp", F.when(grown > 0, grown).otherwise(0).alias("downloads_delta"), *own)


def matched_torrents(torrents: DataFrame, matches: DataFrame, min_date=None) -> DataFrame:
    """Torrents of one episode whose title was resolved, with their show."""
    return (
        usable_torrents(torrents, min_date)
        .withColumn("episode", aggregation_episode(F.col("guessit_data")))
        .filter(F.col("episode").isNotNull())
        .join(matches.select("infohash", "anilist_id"), "infohash")
    )


def first_release(torrents: DataFrame, by=("anilist_id", "episode")) -> DataFrame:
    return torrents.groupBy(*by).agg(F.min(utc("pubdate")).alias("first_datetime"))


def with_first_release(torrents: DataFrame, by=("anilist_id", "episode")) -> DataFrame:
    return torrents.join(first_release(torrents, by), list(by), "left")


def bucket_deltas(deltas: DataFrame) -> DataFrame:
    """Sum per (show, episode, age bucket); ``deltas`` carry ``first_datetime``.

    Partial sums are formed before the shuffle, so a show with a large share of
    the readings sends no more than its buckets from each task.
    """
    bucket = time_bucket(hours_since(F.col("timestamp"), F.col("first_datetime")))
    return (
        deltas.withColumn("time_bucket_hours", bucket)
        .groupBy("anilist_id", "episode", "time_bucket_hours", "first_datetime")
        .agg(
            F.sum("downloads_delta").alias("downloads_daily"),
            F.min("timestamp").alias("period_start"),
        )
    )


def episode_dims(torrents: DataFrame) -> DataFrame:
    """What the deltas of a torrent need for its episode's series and its own weeks."""
    return with_first_release(torrents).select("infohash", "anilist_id", "episode", "filename", "first_datetime")


def episode_series(deltas: DataFrame) -> DataFrame:
    """Buckets with the running total per episode, from deltas with the columns of :func:`episode_dims`.

    An episode has at most 168 hourly buckets and one per day after, so its
    window partition is bounded by the length of the history.
    """
    buckets = bucket_deltas(deltas)
    running = Window.partitionBy("anilist_id", "episode").orderBy("time_bucket_hours").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return buckets.select(
        "anilist_id",
        "episode",
        "time_bucket_hours",
        "first_datetime",
        "period_start",
        "downloads_daily",
        F.sum("downloads_daily").over(running).alias("downloads_cumulative"),
        (F.col("time_bucket_hours") / 24).alias("days_since_first_torrent"),
        F.to_date("period_start").alias("date"),
    )


def show_labels(shows: DataFrame) -> DataFrame:
    """Display names: English, or romaji when there is none."""
    english = F.when(F.coalesce("title_english", F.lit("")) != "", F.col("title_english"))
    return shows.select(
        "anilist_id",
        F.coalesce(english, F.col("title_romaji")).alias("title"),
        "title_romaji",
        "cover_image_url",
        "cover_image_color",
    )


def with_show_labels(df: DataFrame, shows: DataFrame) -> DataFrame:
    """Names for a frame already aggregated per show; ``Unknown`` if not listed."""
    unknown = F.lit("Unknown")
    return (
        df.join(show_labels(shows), "anilist_id", "left")
        .withColumn("title", F.coalesce("title", unknown))
        .withColumn("title_romaji", F.coalesce("title_romaji", unknown))
    )


def weekly_totals(series: DataFrame) -> DataFrame:
    """Downloads per (week, show); a bucket belongs to the week of its earliest
    reading."""
    return (
        series.groupBy(week_label(F.col("period_start")).alias("week"), "anilist_id")
        .agg(F.sum("downloads_daily").alias("downloads"))
    )


def episode_span(torrents: DataFrame) -> DataFrame:
    """Lowest and highest episode per parsed title, batches left out."""
    json = F.col("guessit_data")
    title = F.get_json_object(json, "$.title")
    episode = F.get_json_object(json, "$.episode")
    return (
        torrents.select(title.alias("title"), episode.alias("_episode"))
        .filter(F.col("_episode").isNotNull() & ~F.contains(F.col("_episode"), F.lit("[")))
        .groupBy("title")
        .agg(
            F.min(F.col("_episode").try_cast("bigint")).alias("min_ep"),
            F.max(F.col("_episode").try_cast("bigint")).alias("max_ep"),
        )
    )
