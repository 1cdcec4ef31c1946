"""Ratings and surveys against downloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.numbers import round_binary

# Output column and the reception metric it compares with.
RANK_DELTAS = {
    "rank_delta_dl_vs_mal": "mal_score",
    "rank_delta_dl_vs_anilist": "average_score",
    "rank_delta_dl_vs_niconico": "niconico_very_good_pct",
}


def survey_rollup(surveys: DataFrame) -> DataFrame:
    """Mean of the answered episodes' best-answer share, 2 places."""
    mean = F.avg("very_good_pct")
    return (
        surveys.groupBy("anilist_id")
        .agg(mean.alias("_mean"))
        .select("anilist_id", round_binary(F.col("_mean"), 2).alias("niconico_very_good_pct"))
    )


def survey_series(surveys: DataFrame) -> DataFrame:
    """Answered episodes in order: one entry per episode of a show."""
    answered = surveys.filter(F.col("very_good_pct").isNotNull() & F.col("episode").isNotNull())
    return answered.groupBy("anilist_id").agg(
        F.array_sort(F.collect_list(F.struct("episode", "very_good_pct"))).alias("niconico_episodes")
    )


def survey_summary(surveys: DataFrame) -> DataFrame:
    """The rollup and the series of every surveyed show, from one aggregation."""
    answered = F.col("very_good_pct").isNotNull() & F.col("episode").isNotNull()
    entries = F.collect_list(F.when(answered, F.struct("episode", "very_good_pct")))
    summed = surveys.groupBy("anilist_id").agg(F.avg("very_good_pct").alias("_mean"), F.array_sort(entries).alias("_entries"))
    return summed.select(
        "anilist_id",
        round_binary(F.col("_mean"), 2).alias("niconico_very_good_pct"),
        F.when(F.size("_entries") > 0, F.col("_entries")).alias("niconico_episodes"),
    )


def show_metrics(shows: DataFrame, ratings: DataFrame, surveys: DataFrame) -> DataFrame:
    """Catalogue scores, external rating and survey summary per show; sources a
    show lacks stay null."""
    rating = ratings.filter(F.col("source") == "mal").select(
        "anilist_id",
        F.col("payload.score").alias("mal_score"),
        F.col("payload.scored_by").alias("mal_scored_by"),
        F.col("payload.rank").alias("mal_rank"),
    )
    return (
        shows.select(
            "anilist_id", "average_score", "mean_score", "popularity", "favourites", "mal_id"
        )
        .join(rating, "anilist_id", "left")
        .join(survey_summary(surveys), "anilist_id", "left")
    )


def rank_deltas(
    shows: DataFrame, deltas: dict[str, str] = RANK_DELTAS, by=("season",), total: str = "total_downloads"
) -> DataFrame:
    """Download rank minus reception rank within the season; positive means
    better received than downloaded, null without the metric.

    Positions run 1..n among the shows that have the metric, equal values by total
    descending, then id. The shows of a season are shuffled once and ranked on every metric there.
    """

    def position(metric: str) -> Column:
        order = Window.partitionBy(*by).orderBy(
            F.col(metric).desc_nulls_last(), F.col(total).desc_nulls_last(), F.col("anilist_id")
        )
        return F.when(F.col(metric).isNotNull(), F.row_number().over(order).cast("bigint"))

    ranked = shows.withColumns({"_dl": position(total)} | {name: position(m) for name, m in deltas.items()})
    return ranked.withColumns({name: F.col("_dl") - F.col(name) for name in deltas}).drop("_dl")
