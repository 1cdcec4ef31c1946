"""The weekly recompute: titles resolved, downloads counted, reports written.

One lazy plan per report. What several reports read (matches, the episode
series, weekly rankings) is checkpointed once in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse import rules
from pulse.functions.metadata import matching_fields
from pulse.operators.movies import movie_dims, movie_series, movie_torrents
from pulse.operators.ranking import weekly_rankings
from pulse.operators.reception import show_metrics
from pulse.operators.resolve import best_scores, matched, resolve, stored_with_summary, unmatched
from pulse.operators.season import season_episodes, season_index, season_rankings
from pulse.functions.text import season_slug
from pulse.operators.series import (
    counter_deltas,
    episode_dims,
    episode_series,
    matched_torrents,
    weekly_totals,
    with_show_labels,
)
from pulse.operators.surveys import title_map
from pulse.plans import reception, reports
from pulse.session import cut
from pulse.sources.catalogue import movie_shows
from pulse.sources.tables import usable_torrents


@dataclass(frozen=True)
class Inputs:
    """Stored tables. ``shows`` carries ``show_seq``; ``members`` lists
    (season, anilist_id); ``movies`` is the movie catalogue. An export of surveys and responses of ratings fetched for this
    run, if any, are taken into the stored ones."""

    torrents: DataFrame
    stats: DataFrame
    shows: DataFrame
    members: DataFrame
    ratings: DataFrame
    surveys: DataFrame
    movies: DataFrame
    seasons: DataFrame
    survey_rows: DataFrame | None = None
    survey_source: str = ""
    rating_responses: DataFrame | None = None


def titles_of(torrents: DataFrame) -> DataFrame:
    """infohash with title, season and episode for matching; no title, no row."""
    fields = torrents.select("infohash", matching_fields(F.col("guessit_data")).alias("m"))
    return fields.select("infohash", "m.title", "m.season", "m.episode").filter(
        F.col("title").isNotNull()
    )


def run(inputs: Inputs, out: str, now: datetime, first_day, threshold: int = rules.MATCH_THRESHOLD) -> None:
    spark = inputs.torrents.sparkSession
    usable = usable_torrents(inputs.torrents, first_day)
    titles = titles_of(usable)
    ranges = rules.episode_ranges(spark)
    resolved, summary = stored_with_summary(resolve(titles, inputs.shows, rules.overrides(spark), ranges, threshold))
    reports.write_json(summary, f"{out}/match_summary")
    matches = matched(resolved)
    misses = best_scores(unmatched(resolved), inputs.shows)
    reports.write_json(reports.unmatched_titles(misses), f"{out}/unmatched_titles")

    ignored = rules.titles(spark, rules.IGNORED_TITLES)
    reports.write_json(
        reports.unmatched_report(unmatched(resolved), usable, inputs.stats, ignored).drop("infohash"),
        f"{out}/unmatched_torrents_report",
    )

    torrents = cut(matched_torrents(usable, matches))
    films, catalogue = run_movie_matches(inputs, titles, out, threshold)
    # One pass over the readings counts the deltas of all matched torrents, for three readers.
    deltas = cut(counter_deltas(inputs.stats, delta_dims(torrents, films)))
    by_episode = deltas.filter("episode_of IS NOT NULL").select("infohash", "timestamp", "downloads_delta", "episode_of.*")
    by_movie = deltas.filter("movie_of IS NOT NULL").select("infohash", "timestamp", "downloads_delta", "movie_of.*")

    series = cut(episode_series(by_episode))
    rankings = cut(with_show_labels(weekly_rankings(weekly_totals(series)), inputs.shows))
    per_torrent = cut(reports.torrent_weeks(by_episode, now))
    reports.write_json(
        reports.diagnostics_report(per_torrent, rankings, matches, inputs.shows), f"{out}/torrent_downloads_report"
    )
    reports.write_json(reports.rankings_report(rankings, now), f"{out}/rankings")

    in_season = cut(season_rankings(rankings, inputs.seasons, inputs.members))
    ratings, surveys = kept_answers(inputs, now)
    metrics = show_metrics(inputs.shows, ratings, surveys)
    weeks = cut(reports.season_weeks_report(in_season))
    shows = cut(reports.season_shows_report(in_season, series, inputs.shows, metrics))
    percentiles = cut(reports.season_percentiles_report(in_season, series))
    reports.write_json(weeks, f"{out}/season_weeks", ["slug"])
    reports.write_json(shows, f"{out}/season_shows", ["slug"])
    reports.write_json(percentiles, f"{out}/season_percentiles", ["slug"])
    reports.write_json(reports.season_documents(weeks, shows, percentiles), f"{out}/season", ["slug"])
    reports.write_json(
        season_episodes(series, inputs.seasons, inputs.members).withColumn(
            "slug", season_slug(F.col("season"))
        ),
        f"{out}/season_episodes", ["slug"],
    )
    reports.write_json(
        season_index(in_season, inputs.seasons, inputs.members, now), f"{out}/seasons"
    )
    reports.write_json(reports.movies_report(cut(movie_series(by_movie)), catalogue), f"{out}/movies")


def kept_answers(inputs: Inputs, now: datetime) -> tuple[DataFrame, DataFrame]:
    """Ratings and surveys with what this run has fetched."""
    ratings, surveys = inputs.ratings, inputs.surveys
    if inputs.rating_responses is not None:
        ratings = cut(reception.update_ratings(ratings, inputs.rating_responses))
    if inputs.survey_rows is not None:
        seasons = inputs.seasons
        listed = title_map(seasons.sparkSession)
        surveys = cut(reception.update_surveys(surveys, inputs.survey_rows, seasons, inputs.shows, listed, now, inputs.survey_source))
    return ratings, surveys


def delta_dims(torrents: DataFrame, films: DataFrame) -> DataFrame:
    """One row per torrent that is matched to an episode, a movie or both, with what each reader needs."""
    episodes = episode_dims(torrents)
    movies = movie_dims(films)
    rest = lambda df: F.struct(*[c for c in df.columns if c != "infohash"])
    return episodes.select("infohash", rest(episodes).alias("episode_of")).join(
        movies.select("infohash", rest(movies).alias("movie_of")), "infohash", "full"
    )


def run_movie_matches(
    inputs: Inputs, titles: DataFrame, out: str, threshold: int, min_date=rules.MOVIE_DATES[0]
) -> tuple[DataFrame, DataFrame]:
    """The same titles against the movie catalogue with its own overrides: the torrents of movies,
    and the catalogue."""
    spark = inputs.torrents.sparkSession
    overrides = rules.overrides(spark, rules.MOVIE_OVERRIDES)
    catalogue = movie_shows(
        inputs.movies, rules.ids(spark, rules.MOVIE_EXCLUDED), overrides, inputs.shows
    )
    resolved = resolve(titles, catalogue, overrides, rules.episode_ranges(spark), threshold)
    matches = cut(matched(resolved))
    torrents = cut(movie_torrents(inputs.torrents, matches, min_date))
    reports.write_json(
        reports.movie_match_report(torrents, matches, catalogue), f"{out}/movie_match_report"
    )
    return torrents, catalogue
