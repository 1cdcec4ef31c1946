"""Nested report rows and their JSON sinks.

A report is a set of JSON lines, one object per week, show and week, movie or season, whatever
its size. The child arrays hold shows of a week or season, weeks of a show, or torrents of a show, so
they are bounded by the catalogue, not by the readings.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.metadata import json_or_error, report_fields
from pulse.functions.text import normalize_title, season_slug
from pulse.functions.times import week_label
from pulse.operators.movies import movie_totals, torrent_counts
from pulse.operators.ranking import grown_shows, top_ranked, without_week_of
from pulse.operators.reception import rank_deltas
from pulse.operators.season import (
    episode_totals,
    nearest_bands,
    retention,
    rounded_retention,
    running_totals,
    season_totals,
)
from pulse.operators.series import show_labels, with_show_labels
from pulse.operators.windows import row_number_over
from pulse.session import cut

_LABELS = ("title", "title_romaji", "cover_image_url", "cover_image_color")


def nested(
    rows: DataFrame, group: Sequence[str], position: str, fields: Sequence[str | Column], name: str
) -> DataFrame:
    """Group rows into one array per group in ``position`` order (1, 2, .. within the group)."""
    child = F.struct(F.col(position).alias("_at"), F.struct(*fields).alias("_child"))
    ordered = F.transform(F.array_sort(F.collect_list(child)), lambda s: s["_child"])
    return rows.groupBy(*group).agg(ordered.alias(name))


def flattened(report: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """The child rows of a nested report with columns of their parent."""
    return report.select(*keep, F.inline(name))


def write_json(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition).json(path, ignoreNullFields=False)


def rankings_report(rankings: DataFrame, now: datetime) -> DataFrame:
    """Finished weeks with their rankings."""
    fields = ["anilist_id", "rank", "downloads", *_LABELS]
    weeks = nested(without_week_of(rankings, now), ["week"], "rank", fields, "rankings")
    return weeks.select("week", F.col("week").alias("start_date"), "rankings")


def season_weeks_report(rankings: DataFrame) -> DataFrame:
    """``rankings`` are those of the seasons' own shows."""
    running = row_number_over(running_totals(rankings), ["season", "week"], [F.col("rank")], "_at")
    fields = ["anilist_id", "rank", "downloads", "downloads_cumulative", *_LABELS]
    weeks = nested(running, ["season", "week"], "_at", fields, "rankings")
    return weeks.select(
        season_slug(F.col("season")).alias("slug"), "season", "week",
        F.col("week").alias("start_date"), "rankings",
    )


def season_shows_report(
    rankings: DataFrame, series: DataFrame, shows: DataFrame, metrics: DataFrame
) -> DataFrame:
    """One row per season and show, with retention, ratings and rank deltas.
    The rows are ranked on four metrics, so they are stored once first."""
    totals = season_totals(rankings)
    aired = rounded_retention(retention(episode_totals(series)))
    rows = (
        totals.join(aired, "anilist_id", "left")
        .join(show_labels(shows), "anilist_id", "left")
        .join(metrics, "anilist_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("episodes_aired", "ep1_downloads")})
    )
    return rank_deltas(cut(rows)).withColumn("slug", season_slug(F.col("season")))


def season_percentiles_report(rankings: DataFrame, series: DataFrame) -> DataFrame:
    """Quartiles per week and per episode, as values of the data."""
    weekly = nearest_bands(rankings, ["season", "week"], "downloads", F.col("anilist_id"))
    in_season = rankings.select("season", "anilist_id").distinct()
    episodes = episode_totals(series).join(in_season, "anilist_id")
    by_episode = nearest_bands(episodes, ["season", "episode"], "downloads_total", F.col("anilist_id"))
    quartiles = ("p25", "p50", "p75")

    def rows(df: DataFrame, kind: str, at: str) -> DataFrame:
        return df.select(
            season_slug(F.col("season")).alias("slug"), "season", F.lit(kind).alias("kind"),
            F.col(at).cast("string").alias("at"), *quartiles,
        )

    return rows(weekly, "weekly_downloads", "week").unionByName(
        rows(by_episode, "episode_downloads", "episode")
    )


def season_documents(weeks: DataFrame, shows: DataFrame, percentiles: DataFrame) -> DataFrame:
    """One object per season: its weeks in order, its shows by total downloads, and its percentiles. A season has the rows
    of its catalogue."""
    key = ["slug", "season"]

    def listed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
        fields = [c for c in rows.columns if c not in key]
        return nested(row_number_over(rows, key, order, "_at"), key, "_at", fields, name)

    bands = lambda kind: percentiles.filter(F.col("kind") == kind).drop("kind")
    return (
        listed(weeks, [F.col("week")], "weeks")
        .join(listed(shows, [F.col("total_downloads").desc_nulls_last(), F.col("anilist_id")], "shows"), key, "left")
        .join(listed(bands("weekly_downloads"), [F.col("at")], "weekly_percentiles"), key, "left")
        .join(listed(bands("episode_downloads"), [F.col("at").cast("bigint")], "episode_percentiles"), key, "left")
    )


def movies_report(series: DataFrame, shows: DataFrame) -> DataFrame:
    """Movies with their weekly series. A movie has one entry per week."""
    weekly = series.groupBy("anilist_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "weeks_since_release",
                    F.date_format("week_start", "yyyy-MM-dd").alias("week_start"),
                    "downloads_weekly",
                    "downloads_cumulative",
                )
            )
        ).alias("weekly_downloads")
    )
    joined = movie_totals(series).join(weekly, "anilist_id")
    return (
        with_show_labels(joined, shows)
        .select("anilist_id", *_LABELS, "total_downloads", "first_torrent_date", "weekly_downloads")
        .orderBy(F.desc("total_downloads"), F.asc("anilist_id"))
    )


def movie_match_report(torrents: DataFrame, matches: DataFrame, shows: DataFrame) -> DataFrame:
    """Per movie the torrents matched to it, in release order; metadata that is
    not JSON is kept as raw text."""
    match_fields = ("method", "score", "matched_title", "season_matched")
    info = matches.select("infohash", F.struct(*match_fields).alias("match"))
    numbered = row_number_over(
        torrents.join(info, "infohash", "left"),
        ["anilist_id"],
        [F.coalesce("pubdate", F.lit(0).cast("timestamp")), F.coalesce("filename", F.lit("")), F.col("infohash")],
        "_at",
    )
    json = json_or_error(F.col("guessit_data"))
    fields = [
        "infohash", "filename", "pubdate",
        F.coalesce("trusted", F.lit(False)).alias("trusted"),
        F.coalesce("remake", F.lit(False)).alias("remake"),
        json.alias("guessit"),
        *[F.get_json_object(json, f"$.{f}").alias(f"guessit_{f}") for f in ("title", "season", "episode")],
        "match",
    ]
    movies = nested(numbered, ["anilist_id"], "_at", fields, "torrents").join(
        torrent_counts(torrents), "anilist_id"
    )
    return with_show_labels(movies, shows).select(
        "anilist_id", "title", "title_romaji", "torrent_count", "torrents"
    ).orderBy(F.desc("torrent_count"), F.asc("anilist_id"))


def torrent_weeks(deltas: DataFrame, now: datetime) -> DataFrame:
    """Downloads per torrent and week, by each reading's own time, from deltas that carry the torrent's
    show, episode and file name."""
    return (
        without_week_of(deltas.withColumn("week", week_label(F.col("timestamp"))), now)
        .groupBy("anilist_id", "week", "infohash", "episode", "filename")
        .agg(F.sum("downloads_delta").alias("downloads"))
    )


def noteworthy_shows(per_torrent: DataFrame, rankings: DataFrame, top: int = 30) -> DataFrame:
    """Shows in the top 30 of any week, or that more than doubled week on week."""
    weekly = per_torrent.groupBy("anilist_id", "week").agg(F.sum("downloads").alias("downloads"))
    ranked = top_ranked(rankings, top).select("anilist_id").distinct()
    return ranked.union(grown_shows(weekly)).distinct()


def diagnostics_report(
    per_torrent: DataFrame, rankings: DataFrame, matches: DataFrame, shows: DataFrame
) -> DataFrame:
    """Per show and week the torrents behind the total, largest first."""
    kept = per_torrent.join(noteworthy_shows(per_torrent, rankings), "anilist_id", "left_semi")
    info = matches.select(
        "infohash", F.col("method").alias("match_method"), F.col("score").alias("match_score")
    )
    numbered = row_number_over(
        kept.join(info, "infohash", "left"),
        ["anilist_id", "week"],
        [-F.col("downloads"), F.col("infohash")],
        "_at",
    )
    fields = ["infohash", "filename", "episode", "match_method", "match_score", "downloads"]
    totals = kept.groupBy("anilist_id", "week").agg(F.sum("downloads").alias("total_downloads"))
    title = F.coalesce(F.nullif("title_romaji", F.lit("")), F.col("title_english"), F.lit(""))
    names = shows.select("anilist_id", title.alias("title"))
    return (
        nested(numbered, ["anilist_id", "week"], "_at", fields, "torrents")
        .join(totals, ["anilist_id", "week"])
        .join(names, "anilist_id", "left")
        .select(
            "anilist_id", F.coalesce("title", F.lit("Unknown")).alias("title"),
            "week", "total_downloads", "torrents",
        )
    )


def unmatched_titles(misses: DataFrame) -> DataFrame:
    """Titles without a match, the nearest misses first: how many torrents, and the best ratio with any name."""
    return misses.groupBy("normalized").agg(
        F.min("title").alias("title"), F.count(F.lit(1)).alias("torrents"), F.max("best_score").alias("best_score")
    ).orderBy(F.desc_nulls_last("best_score"), F.asc("normalized")).select("title", "normalized", "torrents", "best_score")


def unmatched_report(
    misses: DataFrame, torrents: DataFrame, stats: DataFrame, ignored: DataFrame, limit: int = 100
) -> DataFrame:
    """The unmatched torrents read highest. The limit comes before the ignored
    titles are taken out, so the report may be shorter."""
    open_torrents = torrents.join(misses.select("infohash"), "infohash", "left_semi")
    read = stats.groupBy("infohash").agg(
        F.max("downloads").alias("max_downloads"), F.count(F.lit(1)).alias("stat_count")
    )
    top = (
        open_torrents.join(read, "infohash", "left")
        .withColumn("stat_count", F.coalesce("stat_count", F.lit(0)))
        .orderBy(F.desc_nulls_last("max_downloads"), F.asc("infohash"))
        .limit(limit)
    )
    named = top.withColumn("_f", report_fields(F.col("guessit_data"))).select(
        "infohash", "filename", F.col("_f.parsed_title").alias("guessit_title"),
        F.col("_f.season").alias("season"), F.col("_f.episode").alias("episode"),
        "max_downloads", "stat_count",
    )
    shown = named.withColumn("normalized", normalize_title(F.col("guessit_title"))).join(
        ignored, "normalized", "left_anti"
    )
    return shown.drop("normalized").orderBy(F.desc_nulls_last("max_downloads"), F.asc("infohash"))
