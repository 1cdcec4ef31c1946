"""Weekly rankings and their movement."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.text import ranking_line
from pulse.functions.times import week_label
from pulse.operators.windows import row_number_over


def weekly_rankings(totals: DataFrame) -> DataFrame:
    """Position within the week: downloads descending, then id."""
    return row_number_over(totals, ["week"], [-F.col("downloads"), F.col("anilist_id")], "rank")


def without_week_of(df: DataFrame, now: datetime) -> DataFrame:
    """Leave out the week that contains ``now``."""
    return df.filter(F.col("week") != week_label(F.lit(now).cast("timestamp")))


def numbered_weeks(rankings: DataFrame) -> DataFrame:
    """Distinct weeks, newest first: at most 53 rows per year of history, hence
    the single-partition window and the broadcasts of this table."""
    weeks = rankings.select("week").distinct()
    return weeks.withColumn("weeks_ago", F.row_number().over(Window.orderBy(F.desc("week"))) - 1)


def recent_weeks(rankings: DataFrame, count: int) -> DataFrame:
    """Rows of the newest ``count`` weeks, with ``weeks_ago`` counted from 0."""
    newest = numbered_weeks(rankings).filter(F.col("weeks_ago") < count)
    return rankings.join(F.broadcast(newest), "week")


def week_over_week(rankings: DataFrame, count: int | None = None) -> DataFrame:
    """Change against the previous week listed. A show that the previous week
    lacks is new even if it was ranked earlier; the oldest week has no changes."""
    weeks = numbered_weeks(rankings)
    if count is not None:
        weeks = weeks.filter(F.col("weeks_ago") < count)
    placed = rankings.join(F.broadcast(weeks), "week")
    step = (
        weeks.alias("a")
        .join(weeks.alias("b"), F.col("b.weeks_ago") == F.col("a.weeks_ago") + 1, "left")
        .select("a.week", F.col("b.week").alias("_previous_week"))
    )
    before = placed.select(
        F.col("week").alias("_previous_week"),
        "anilist_id",
        F.col("rank").alias("previous_rank"),
        F.col("downloads").alias("previous_downloads"),
    )
    joined = placed.join(F.broadcast(step), "week").join(
        before, ["_previous_week", "anilist_id"], "left"
    )
    change = F.col("downloads") - F.col("previous_downloads")
    return joined.select(
        "week",
        "weeks_ago",
        "anilist_id",
        "rank",
        "downloads",
        *[c for c in ("title", "title_romaji") if c in rankings.columns],
        "previous_downloads",
        (F.col("previous_rank") - F.col("rank")).alias("rank_change"),
        change.alias("download_change"),
        F.when(F.col("previous_downloads") > 0, change / F.col("previous_downloads")).alias(
            "download_change_pct"
        ),
        F.col("previous_rank").isNull().alias("is_new"),
        F.col("_previous_week").isNull().alias("is_oldest"),
    )


def ranking_lines(movement: DataFrame, html: bool = False) -> DataFrame:
    """The movement as one line of text per show."""
    title = F.coalesce(F.nullif("title_romaji", F.lit("")), F.col("title"))
    line = ranking_line(
        F.col("rank"),
        F.col("rank_change"),
        F.col("downloads"),
        F.col("previous_downloads"),
        F.col("is_new"),
        F.col("is_oldest"),
        title,
        html,
    )
    return movement.select("week", "rank", "anilist_id", line.alias("line"))


def top_ranked(rankings: DataFrame, limit: int) -> DataFrame:
    return rankings.filter(F.col("rank") <= limit)


def clamped_rank(limit: int = 40) -> Column:
    return F.least(F.col("rank"), F.lit(limit))


def grown_shows(totals: DataFrame, factor: float = 2.0, total: str = "downloads") -> DataFrame:
    """Shows with a week above ``factor`` times their previous listed week.
    A show's partition holds one row per week."""
    window = Window.partitionBy("anilist_id").orderBy("week")
    previous = F.lag(total).over(window)
    return (
        totals.withColumn("_previous", previous)
        .filter((F.col("_previous") > 0) & (F.col(total) / F.col("_previous") > factor))
        .select("anilist_id")
        .distinct()
    )


def search(shows: DataFrame, score: Column, rank: str = "season_rank") -> DataFrame:
    """Best matches first, season rank among equals."""
    return shows.withColumn("score", score).orderBy(F.desc("score"), F.asc(rank))


def ordered_by_metric(df: DataFrame, metric: str, rank: str = "season_rank") -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), F.asc(rank))
