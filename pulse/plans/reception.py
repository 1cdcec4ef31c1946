"""Keeping surveys and ratings: what is due, and what new answers change.

Fetching is outside: survey exports and rating responses arrive as tables or files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions.times import utc
from pulse.operators.store import upsert
from pulse.operators.surveys import match_surveys
from pulse.rules import SURVEY_MATCH_THRESHOLD, SURVEY_TTL_DAYS
from pulse.sources.catalogue import rating_rows, stale_shows
from pulse.sources.surveys import of_seasons


def surveys_due(surveys: DataFrame, now: datetime, ttl_days: int = SURVEY_TTL_DAYS) -> DataFrame:
    """One row: when surveys were last stored, and whether the export is to be fetched again."""
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("last_fetch")
    return surveys.agg(F.max(utc("fetched_at")).alias("last_fetch")).select(
        "last_fetch", (F.col("last_fetch").isNull() | (age >= ttl_days * 86400)).alias("due")
    )


def update_surveys(
    surveys: DataFrame,
    rows: DataFrame,
    seasons: DataFrame,
    shows: DataFrame,
    title_map: DataFrame,
    now: datetime,
    source_url: str,
    threshold: int = SURVEY_MATCH_THRESHOLD,
) -> DataFrame:
    """The stored surveys after an export: its rows of the given seasons, matched to shows, replace what is
    stored for their (show, episode)."""
    matched = match_surveys(of_seasons(rows, seasons), shows, title_map, threshold)
    new = matched.withColumns({"source_url": F.lit(source_url), "fetched_at": F.lit(now).cast("timestamp")})
    return upsert(surveys, new, ["anilist_id", "episode"], [F.col("fetched_at")])


def update_ratings(ratings: DataFrame, responses: DataFrame, source: str = "mal") -> DataFrame:
    """The stored ratings after a run's responses; one without data leaves what is stored."""
    rows = rating_rows(responses, source).withColumn("fetched_at", F.col("fetched_at").try_cast("timestamp"))
    return upsert(ratings, rows, ["source", "anilist_id"], [F.col("fetched_at")])


def ratings_due(shows: DataFrame, ratings: DataFrame, now: datetime) -> DataFrame:
    return stale_shows(shows, ratings, now)
