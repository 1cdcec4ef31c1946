"""Counter series, time buckets, weekly totals, movies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulse.functions.metadata import aggregation_episode, matching_fields
from pulse.operators import movies as movie_ops
from pulse.operators import series as ops
from pulse.operators.ranking import weekly_rankings
from pulse.plans import incremental, reports
from pulse.queries import registry
from pulse.queries import views as v
from pulse.session import cut, ensure_checkpoint_dir
from pulse.sources.tables import stats_of, usable_torrents


@registry.add(f"""WITH {v.DELTAS}
SELECT infohash, epoch_us(ts) AS at, CAST(delta AS BIGINT) AS downloads_delta FROM deltas""")
def counter_deltas(spark, sf_dir):
    return ops.counter_deltas(v.readings(spark, sf_dir)).select(
        "infohash", v.micros("timestamp").alias("at"), "downloads_delta"
    )


@registry.add(f"""WITH {v.READINGS}
SELECT anilist_id, episode, epoch_us(min(ts)) AS first_at FROM readings GROUP BY ALL""")
def first_release(spark, sf_dir):
    return ops.first_release(v.torrents(spark, sf_dir)).select(
        "anilist_id", "episode", v.micros("first_datetime").alias("first_at")
    )


def series_of(spark, sf_dir):
    dims = ops.episode_dims(v.torrents(spark, sf_dir).withColumn("filename", F.lit(None).cast("string")))
    return ops.episode_series(ops.counter_deltas(v.readings(spark, sf_dir), dims))


@registry.add(f"""WITH {v.SERIES}
SELECT anilist_id, episode, bucket AS time_bucket_hours, epoch_us(period_start) AS period_at,
       daily AS downloads_daily, cumulative AS downloads_cumulative, days AS days_since_first_torrent,
       strftime(period_start, '%Y-%m-%d') AS day
FROM series""")
def episode_series(spark, sf_dir):
    return series_of(spark, sf_dir).select(
        "anilist_id", "episode", "time_bucket_hours", v.micros("period_start").alias("period_at"),
        "downloads_daily", "downloads_cumulative", "days_since_first_torrent",
        F.date_format("date", "yyyy-MM-dd").alias("day"),
    )


@registry.add(f"WITH {v.WEEKLY} SELECT week, anilist_id, downloads FROM weekly")
def weekly_totals(spark, sf_dir):
    return ops.weekly_totals(series_of(spark, sf_dir))


def rankings_of(spark, sf_dir):
    return weekly_rankings(ops.weekly_totals(series_of(spark, sf_dir)))


def stored_series(spark, sf_dir):
    """The series checkpointed, for queries that read it more than once."""
    return cut(series_of(spark, sf_dir))


def stored_rankings(spark, sf_dir):
    return cut(rankings_of(spark, sf_dir))


@registry.add(f"WITH {v.WEEKLY} SELECT week, anilist_id, downloads, rank FROM rankings")
def top_shows_per_week(spark, sf_dir):
    return rankings_of(spark, sf_dir)


@registry.add(f"WITH {v.WEEKLY} SELECT week, anilist_id, downloads, rank FROM rankings")
def incremental_rankings(spark, sf_dir):
    """The same after three updates, of which the last brings a stretch of time that lies before the second's."""
    root = f"{ensure_checkpoint_dir(spark)}/weekly-{uuid.uuid4().hex}"
    readings = v.readings(spark, sf_dir)
    bounds = readings.select(F.unix_micros("timestamp").alias("t")).approxQuantile("t", [0.4, 0.8], 0.01)
    part = sum([(F.unix_micros("timestamp") >= b).cast("int") for b in bounds], F.lit(0))
    readings = cut(readings.withColumn("part", part))
    before = None
    for number, parts in enumerate(([0], [0, 2], [0, 1, 2])):
        known = readings.filter(F.col("part").isin(parts))
        torrents = known.groupBy("infohash", "anilist_id", "episode", "user_id").agg(F.min("timestamp").alias("pubdate"))
        dims = ops.episode_dims(torrents.withColumn("filename", F.lit(None).cast("string")))
        deltas = cut(ops.counter_deltas(known))
        changes = deltas if before is None else deltas.join(before, deltas.columns, "left_anti")
        incremental.update(spark, root, number, dims, changes.withColumn("version", F.lit(number).cast("bigint")))
        before = deltas
    return incremental.rankings(spark, root)


@registry.add(f"""WITH {v.WEEKLY}, {v.SHOWS}
SELECT week, anilist_id, rank, coalesce(title_english, title_romaji, 'Unknown') AS title,
       coalesce(title_romaji, 'Unknown') AS title_romaji
FROM rankings LEFT JOIN shows USING (anilist_id)""")
def rankings_with_titles(spark, sf_dir):
    labelled = ops.with_show_labels(rankings_of(spark, sf_dir), v.shows(spark, sf_dir))
    return labelled.select("week", "anilist_id", "rank", "title", "title_romaji")


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT infohash, epoch_us(pubdate) AS at FROM named
WHERE pubdate >= TIMESTAMP '2024-01-02' AND (status IS NULL OR status <> 'guessit_failed') AND guessit_data IS NOT NULL""")
def usable_torrents_since(spark, sf_dir):
    from datetime import datetime

    rows = usable_torrents(v.named_torrents(spark, sf_dir), datetime(2024, 1, 2))
    return rows.select("infohash", v.micros("pubdate").alias("at"))


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT r.infohash, epoch_us(r.ts) AS at, r.downloads FROM readings r
WHERE r.infohash IN (SELECT infohash FROM named WHERE (status IS NULL OR status <> 'guessit_failed') AND guessit_data IS NOT NULL)""")
def stats_of_usable_torrents(spark, sf_dir):
    keys = usable_torrents(v.named_torrents(spark, sf_dir))
    rows = stats_of(v.readings(spark, sf_dir), keys)
    return rows.select("infohash", v.micros("timestamp").alias("at"), "downloads")


_COUNTED = """CASE WHEN guessit_data = 'not json' OR guessit_data IS NULL OR user_id % 7 IN (0, 3) THEN NULL ELSE number END"""


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT infohash, {_COUNTED} AS episode FROM named""")
def counted_episode(spark, sf_dir):
    """Episode for counting: lists and unreadable text are null."""
    return v.named_torrents(spark, sf_dir).select(
        "infohash", aggregation_episode(F.col("guessit_data")).alias("episode")
    )


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT infohash,
       json_extract_string(j, '$.title') AS title,
       CASE WHEN json_type(j, '$.season') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(j, '$.season') AS BIGINT) END AS season,
       CASE json_type(j, '$.episode')
            WHEN 'UBIGINT' THEN CAST(json_extract_string(j, '$.episode') AS BIGINT)
            WHEN 'ARRAY' THEN CAST(json_extract_string(j, '$.episode[0]') AS BIGINT) END AS episode
FROM (SELECT infohash, CASE WHEN guessit_data = 'not json' THEN NULL ELSE guessit_data END AS j FROM named)""")
def matching_metadata(spark, sf_dir):
    """Title, season and episode for matching: integers only."""
    return v.named_torrents(spark, sf_dir).select(
        "infohash", matching_fields(F.col("guessit_data")).alias("m")
    ).select("infohash", "m.title", "m.season", "m.episode")


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT json_extract_string(j, '$.title') AS title,
       min(TRY_CAST(e AS BIGINT)) AS min_ep, max(TRY_CAST(e AS BIGINT)) AS max_ep
FROM (SELECT j, CASE WHEN contains(json_extract_string(j, '$.episode'), '.') THEN NULL ELSE json_extract_string(j, '$.episode') END AS e,
             json_extract_string(j, '$.episode') AS raw
      FROM (SELECT guessit_data AS j FROM named WHERE guessit_data <> 'not json'))
WHERE raw IS NOT NULL AND NOT contains(raw, '[') GROUP BY ALL""")
def episode_span(spark, sf_dir):
    return ops.episode_span(v.named_torrents(spark, sf_dir))


MOVIES = v.DELTAS + f""",
movie_starts AS (SELECT anilist_id, min(ts) AS first_ts FROM readings GROUP BY anilist_id),
movie_weeks AS (
  SELECT anilist_id, first_ts, CAST(floor(((epoch_us(ts) - epoch_us(first_ts)) // 1000000) / 604800.0) AS BIGINT) AS weeks_since_release,
         CAST(sum(delta) AS BIGINT) AS downloads_weekly, min({v.week_sql('ts')}) AS week_start
  FROM deltas JOIN movie_starts USING (anilist_id) GROUP BY ALL),
movie_series AS (
  SELECT *, CAST(sum(downloads_weekly) OVER (PARTITION BY anilist_id ORDER BY weeks_since_release) AS BIGINT) AS downloads_cumulative
  FROM movie_weeks)"""


def movie_series_of(spark, sf_dir):
    dims = movie_ops.movie_dims(v.torrents(spark, sf_dir))
    return movie_ops.movie_series(ops.counter_deltas(v.readings(spark, sf_dir), dims))


@registry.add(f"""WITH {MOVIES}
SELECT anilist_id, weeks_since_release, downloads_weekly, week_start, downloads_cumulative FROM movie_series""")
def movie_series(spark, sf_dir):
    return movie_series_of(spark, sf_dir).select(
        "anilist_id", "weeks_since_release", "downloads_weekly",
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "downloads_cumulative",
    )


@registry.add(f"""WITH {MOVIES}
SELECT anilist_id, max(downloads_cumulative) AS total_downloads,
       strftime(min(first_ts), '%Y-%m-%d') AS first_torrent_date, count(*) AS weeks
FROM movie_series GROUP BY anilist_id""")
def movie_totals(spark, sf_dir):
    return movie_ops.movie_totals(movie_series_of(spark, sf_dir))


@registry.add(f"""WITH {v.NAMED_TORRENTS}
SELECT anilist_id, count(*) AS torrent_count FROM named
WHERE (status IS NULL OR status <> 'guessit_failed') AND guessit_data IS NOT NULL GROUP BY ALL""")
def movie_torrent_counts(spark, sf_dir):
    named = v.named_torrents(spark, sf_dir)
    matches = named.select("infohash", "anilist_id")
    torrents = movie_ops.movie_torrents(named.drop("anilist_id"), matches)
    return movie_ops.torrent_counts(torrents)


@registry.add(f"""WITH {MOVIES},
totals AS (
  SELECT anilist_id, max(downloads_cumulative) AS total_downloads, strftime(min(first_ts), '%Y-%m-%d') AS first_torrent_date
  FROM movie_series GROUP BY anilist_id)
SELECT anilist_id, total_downloads, first_torrent_date, weeks_since_release, week_start, downloads_weekly, downloads_cumulative
FROM movie_series JOIN totals USING (anilist_id)""")
def movies_report(spark, sf_dir):
    """The movie report, flattened again."""
    nested = reports.movies_report(movie_series_of(spark, sf_dir), v.shows(spark, sf_dir))
    keep = ["anilist_id", "total_downloads", "first_torrent_date"]
    return reports.flattened(nested, "weekly_downloads", keep)
