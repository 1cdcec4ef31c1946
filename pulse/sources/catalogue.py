"""Catalogue media records and rating payloads (JSON lines) as flat rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.times import fuzzy_date
from pulse.operators.store import first_per_key
from pulse.rules import MOVIE_DATES, MOVIE_FORMATS, MOVIE_STATUSES, RATING_TTL_DAYS
from pulse.schema import MEDIA, RATING_PAYLOAD


def read_media(spark: SparkSession, path: str) -> DataFrame:
    return media_rows(spark.read.schema(MEDIA).option("mode", "FAILFAST").json(path))


def media_rows(media: DataFrame) -> DataFrame:
    """One row per show; empty text and lists where the record has none."""
    start = F.col("startDate")
    known = F.coalesce(start["year"], F.lit(0)) != 0
    schedule = F.transform(
        F.coalesce("airingSchedule.nodes", F.array().cast("array<struct<episode:int,airingAt:bigint>>")),
        lambda n: F.struct(n["episode"].alias("episode"), n["airingAt"].alias("airing_at")),
    )
    return media.select(
        F.col("id").alias("anilist_id"),
        F.coalesce("title.romaji", F.lit("")).alias("title_romaji"),
        F.col("title.english").alias("title_english"),
        F.col("title.native").alias("title_native"),
        F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"),
        "episodes",
        F.coalesce("status", F.lit("")).alias("status"),
        schedule.alias("airing_schedule"),
        F.col("coverImage.large").alias("cover_image_url"),
        F.col("coverImage.color").alias("cover_image_color"),
        F.when(known, F.struct(start["year"], start["month"], start["day"])).alias("start_date"),
        "format",
        F.col("idMal").alias("mal_id"),
        F.col("averageScore").alias("average_score"),
        F.col("meanScore").alias("mean_score"),
        "popularity",
        "favourites",
    )


def with_order(shows: DataFrame, *order: str) -> DataFrame:
    """Add ``show_seq``, the catalogue order that breaks ties between matches.

    Any sortable value serves; ids are unique, so they make the order total.
    """
    return shows.withColumn("show_seq", F.struct(*order, "anilist_id"))


def season_catalogues(catalogues: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Season catalogues in order, as (shows, members). A show listed in several
    seasons is one show and a member of each; it keeps its first place."""
    stacked = None
    for place, (season, shows) in enumerate(catalogues.items()):
        part = shows.withColumns({"_place": F.lit(place), "season": F.lit(season)})
        stacked = part if stacked is None else stacked.unionByName(part)
    members = stacked.select("season", "anilist_id").distinct()
    shows = first_per_key(stacked, ["anilist_id"], [F.col("_place"), F.col("show_seq")])
    return shows.withColumn("show_seq", F.struct("_place", "show_seq")).drop("_place", "season"), members


def movie_shows(
    shows: DataFrame,
    excluded: DataFrame,
    overrides: DataFrame,
    tv_shows: DataFrame,
) -> DataFrame:
    """Released single-episode entries, minus exclusions, plus override targets
    that only the TV catalogue has. Additions come last in catalogue order."""
    kept = released(single_episode(shows)).join(excluded, "anilist_id", "left_anti")
    targets = overrides.select(F.col("override_id").alias("anilist_id")).distinct()
    added = tv_shows.join(targets, "anilist_id", "left_semi").join(
        kept.select("anilist_id"), "anilist_id", "left_anti"
    )
    own, other = (df.schema["show_seq"].dataType for df in (shows, tv_shows))

    def placed(df: DataFrame, first: Column, second: Column) -> DataFrame:
        last = second.isNotNull().alias("last")
        return df.withColumn("show_seq", F.struct(last, first.alias("own"), second.alias("added")))

    return placed(kept, F.col("show_seq"), F.lit(None).cast(other)).unionByName(
        placed(added, F.lit(None).cast(own), F.col("show_seq"))
    )


def single_episode(shows: DataFrame) -> DataFrame:
    return shows.filter(F.col("episodes").isNull() | (F.col("episodes") <= 1))


def released(shows: DataFrame) -> DataFrame:
    return shows.filter(F.col("status").isin(*MOVIE_STATUSES))


def in_movie_query(
    shows: DataFrame,
    start: date = MOVIE_DATES[0],
    end: date = MOVIE_DATES[1],
    formats=MOVIE_FORMATS,
) -> DataFrame:
    """Formats of interest with a start date strictly inside the range."""
    begun = fuzzy_date(F.col("start_date.year"), F.col("start_date.month"), F.col("start_date.day"))

    def number(d: date) -> int:
        return d.year * 10000 + d.month * 100 + d.day

    return shows.filter(
        F.col("format").isin(*formats) & (begun > number(start)) & (begun < number(end))
    )


def rating_rows(raw: DataFrame, source: str = "mal", body: str = "body") -> DataFrame:
    """Rating responses (anilist_id, mal_id, body, fetched_at) to cache rows
    holding only the captured fields."""
    payload = F.from_json(F.col(body), f"data {RATING_PAYLOAD}")["data"]
    return raw.select(
        F.lit(source).alias("source"), "anilist_id", "mal_id", payload.alias("payload"), "fetched_at"
    ).filter(F.col("payload").isNotNull())


def stale_shows(
    shows: DataFrame, ratings: DataFrame, now: datetime, source: str = "mal", ttl_days: int = RATING_TTL_DAYS
) -> DataFrame:
    """Shows with an external id and no rating younger than the lifetime."""
    cached = ratings.filter(F.col("source") == source).select(
        "anilist_id",
        F.unix_seconds(F.col("fetched_at").try_cast("timestamp")).alias("_at"),
    )
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.col("_at")
    return (
        shows.filter(F.col("mal_id").isNotNull())
        .join(cached, "anilist_id", "left")
        .filter(F.col("_at").isNull() | (age >= ttl_days * 86400))
        .drop("_at")
    )

