"""Season metrics: totals, retention, cohorts and trend lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.numbers import round_binary
from pulse.functions.text import season_slug
from pulse.operators.quantiles import QUARTILES, quantiles
from pulse.operators.windows import row_number_over

# Ordinals that count as one season, and the days an episode has
# to be followed before it counts for retention.
LAST_ORDINAL = 14
MATURE_DAYS = 7
# Premiere-size quantiles.
PREMIERE_CUTS = {"small_until": 0.33, "medium_until": 0.66}


def season_weeks(seasons: DataFrame) -> DataFrame:
    """Every Sunday-to-Saturday week that shares a day with the season.

    Listing a season's weeks turns the interval overlap into an equi join; the
    table has at most 53 rows per season and year.
    """

    def sunday(day: Column) -> Column:
        return F.date_sub(day, F.dayofweek(day) - 1)

    starts = F.sequence(sunday(F.col("start_date")), sunday(F.col("end_date")), F.expr("INTERVAL 7 DAYS"))
    return seasons.select(
        F.col("name").alias("season"), F.explode(starts).alias("_start")
    ).select("season", F.date_format("_start", "yyyy-MM-dd").alias("week"))


def season_rankings(rankings: DataFrame, seasons: DataFrame, members: DataFrame) -> DataFrame:
    """Rankings of a season's weeks, limited to the season's own shows.

    ``members`` lists (season, anilist_id); a week on the boundary belongs to
    both seasons, membership tells their shows apart.
    """
    of_show = rankings.join(members.select("season", "anilist_id"), "anilist_id")
    return of_show.join(season_weeks(seasons), ["season", "week"], "left_semi")


def running_totals(rankings: DataFrame) -> DataFrame:
    """Downloads so far in the season. A show has one row per week."""
    window = Window.partitionBy("season", "anilist_id").orderBy("week").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rankings.withColumn("downloads_cumulative", F.sum("downloads").over(window))


def season_totals(rankings: DataFrame) -> DataFrame:
    """Total and latest weekly rank per show."""
    return rankings.groupBy("season", "anilist_id").agg(
        F.sum("downloads").alias("total_downloads"), F.max_by("rank", "week").alias("current_rank")
    )


def episode_totals(series: DataFrame) -> DataFrame:
    """Per episode: total, followed days, share within the first week, ordinal.
    A show has one row per episode."""
    window = Window.partitionBy("anilist_id")
    return (
        series.groupBy("anilist_id", "episode")
        .agg(
            F.sum("downloads_daily").alias("downloads_total"),
            F.max("days_since_first_torrent").alias("max_days"),
            F.sum(
                F.when(F.col("days_since_first_torrent") <= MATURE_DAYS, F.col("downloads_daily")).otherwise(0)
            ).alias("downloads_early"),
        )
        .withColumn("episode_ordinal", F.col("episode") - F.min("episode").over(window) + 1)
    )


def retention(episodes: DataFrame) -> DataFrame:
    """Per show: episodes aired, first-episode downloads, endurance (average of
    mature episodes 2..14 over the first) and late starters (the first episode's
    share after a week). Unrounded."""
    first = F.col("episode_ordinal") == 1
    later = (
        F.col("episode_ordinal").between(2, LAST_ORDINAL) & (F.col("max_days") >= MATURE_DAYS)
    )
    summed = episodes.groupBy("anilist_id").agg(
        F.count(F.lit(1)).alias("episodes_aired"),
        F.max(F.when(first, F.col("downloads_total"))).alias("ep1_downloads"),
        F.max(F.when(first, F.col("downloads_early"))).alias("_early"),
        F.avg(F.when(later, F.col("downloads_total"))).alias("_later"),
    )
    started = F.col("ep1_downloads") > 0
    return summed.select(
        "anilist_id",
        "episodes_aired",
        F.when(started, F.col("_later") / F.col("ep1_downloads")).alias("endurance"),
        F.when(started, (F.col("ep1_downloads") - F.col("_early")) / F.col("ep1_downloads")).alias(
            "late_starters"
        ),
        F.coalesce("ep1_downloads", F.lit(0)).alias("ep1_downloads"),
    )


def rounded_retention(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {c: round_binary(F.col(c), 3) for c in ("endurance", "late_starters")}
    )


def season_index(rankings: DataFrame, seasons: DataFrame, members: DataFrame, now: datetime) -> DataFrame:
    """One row per season; ``rankings`` come from :func:`season_rankings`."""
    seen = rankings.groupBy("season").agg(
        F.countDistinct("week").alias("weeks_count"), F.max("week").alias("latest_week")
    )
    listed = members.groupBy("season").agg(F.count(F.lit(1)).alias("shows_count"))
    return (
        seasons.select("name", season_slug(F.col("name")).alias("slug"), F.col("season").alias("_part"),
                       "year", "start_date", "end_date")
        .join(seen.withColumnRenamed("season", "name"), "name", "left")
        .join(listed.withColumnRenamed("season", "name"), "name", "left")
        .select(
            "name", "slug", F.col("_part").alias("season"), "year",
            F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
            F.date_format("end_date", "yyyy-MM-dd").alias("end_date"),
            F.when(F.col("end_date") < F.lit(now).cast("date"), "complete").otherwise("in-progress").alias("status"),
            F.coalesce("shows_count", F.lit(0)).alias("shows_count"),
            F.coalesce("weeks_count", F.lit(0)).alias("weeks_count"),
            "latest_week",
            F.col("latest_week").alias("latest_week_start"),
        )
    )


def season_episodes(series: DataFrame, seasons: DataFrame, members: DataFrame) -> DataFrame:
    """Episode totals from readings dated within the season, both ends included.

    The season's dates travel with its members, so this is an equi join on the
    show, pre-aggregated to one row per episode and day.
    """
    daily = series.groupBy("anilist_id", "episode", "date").agg(F.sum("downloads_daily").alias("_day"))
    dated = members.join(
        seasons.select(F.col("name").alias("season"), "start_date", "end_date"), "season"
    )
    return (
        daily.join(dated, "anilist_id")
        .filter(F.col("date").between(F.col("start_date"), F.col("end_date")))
        .groupBy("season", "anilist_id", "episode")
        .agg(F.sum("_day").alias("downloads_cumulative"))
    )


def season_rank(df: DataFrame, by=("season",), total: str = "total_downloads") -> DataFrame:
    return row_number_over(df, list(by), [-F.col(total), F.col("anilist_id")], "season_rank")


def ordinals(episodes: DataFrame, by=("anilist_id",)) -> DataFrame:
    """Episode ordinal from the lowest episode. A show has one row per episode."""
    lowest = F.min("episode").over(Window.partitionBy(*by))
    return episodes.withColumn("episode_ordinal", F.col("episode") - lowest + 1)


def first_episode_share(episodes: DataFrame, by=("anilist_id",), value: str = "downloads_cumulative") -> DataFrame:
    """Ordinals 1..14 as a share of the first; shows without one are left out."""
    window = Window.partitionBy(*by)
    first = F.max(F.when(F.col("episode_ordinal") == 1, F.col(value))).over(window)
    return (
        ordinals(episodes, by)
        .withColumn("_first", first)
        .filter((F.col("episode_ordinal") <= LAST_ORDINAL) & (F.col("_first") > 0))
        .withColumn("downloads_pct", F.col(value) / F.col("_first"))
        .drop("_first")
    )


def retention_series(shares: DataFrame, by=("anilist_id",)) -> DataFrame:
    """The shares as an array in episode order: at most 14 entries."""
    return shares.groupBy(*by).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("episode_ordinal", "downloads_pct"))),
            lambda s: s["downloads_pct"],
        ).alias("retention")
    )


def sparkline_series(episodes: DataFrame, rankings: DataFrame) -> DataFrame:
    """Per show: downloads in episode order and weekly ranks (clamped to 40) in
    week order: one entry per episode and per week."""
    downloads = episodes.groupBy("anilist_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("episode", "downloads_cumulative"))),
            lambda s: s["downloads_cumulative"],
        ).alias("downloads_by_episode")
    )
    ranks = rankings.groupBy("anilist_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("week", F.least("rank", F.lit(40)).alias("rank")))),
            lambda s: s["rank"],
        ).alias("rank_by_week")
    )
    return downloads.join(ranks, "anilist_id", "full")


def ordinal_bands(episodes: DataFrame, value: str, by=()) -> DataFrame:
    """Linear quartiles per episode ordinal."""
    shown = episodes.filter(F.col("episode_ordinal") <= LAST_ORDINAL)
    return quantiles(shown, [*by, "episode_ordinal"], value, F.col("anilist_id"), QUARTILES, "linear")


def nearest_bands(df: DataFrame, group, value: str, tie: Column) -> DataFrame:
    """Quartiles that are values of the data."""
    return quantiles(df, group, value, tie, QUARTILES, "nearest")


def premiere_size(shows: DataFrame, by=("season",), value: str = "ep1_downloads") -> DataFrame:
    """small / medium / big by the 0.33 and 0.66 quantiles of positive premieres.
    A show without one is small."""
    cuts = quantiles(
        shows.filter(F.col(value) > 0), by, value, F.col("anilist_id"), PREMIERE_CUTS, "linear"
    )
    small, medium = F.coalesce("small_until", F.lit(0.0)), F.coalesce("medium_until", "small_until", F.lit(0.0))
    size = (
        F.when(F.col(value).isNull() | (F.col(value) == 0) | (F.col(value) <= small), "small")
        .when(F.col(value) <= medium, "medium")
        .otherwise("big")
    )
    return (
        shows.join(cuts, list(by), "left")
        .withColumn("premiere_size", size)
        .drop(*PREMIERE_CUTS)
    )


def medians(df: DataFrame, group, value: str) -> DataFrame:
    return quantiles(df, group, value, F.col("anilist_id"), {"median": 0.5}, "linear")


def scaling_maxima(shows: DataFrame, by=("season",)) -> DataFrame:
    """Scale ends for charts, with their fallbacks when nothing is there."""
    return shows.groupBy(*by).agg(
        F.coalesce(F.nullif(F.max("total_downloads"), F.lit(0)), F.lit(1)).alias("max_downloads"),
        F.coalesce(F.max(F.when(F.col("endurance") > 0, F.col("endurance"))), F.lit(1.0)).alias("max_endurance"),
        F.coalesce(F.nullif(F.max("late_starters"), F.lit(0.0)), F.lit(0.5)).alias("max_late_starters"),
    )


def download_trend(shows: DataFrame, score: str, by=("season",)) -> DataFrame:
    """Least squares of log10(downloads) on a score, per season. Slope and
    intercept are null below three shows or when all scores are equal."""
    y = F.log10("total_downloads")
    usable = shows.filter(F.col(score).isNotNull() & (F.col("total_downloads") > 0))
    x = F.col(score).cast("double")
    fit = usable.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.count(F.lit(1)).alias("shows"),
        F.min(x).alias("_low"),
        F.max(x).alias("_high"),
    )
    fitted = (F.col("shows") >= 3) & (F.col("_low") < F.col("_high"))
    return fit.select(
        *by, "shows", *[F.when(fitted, F.col(c)).alias(c) for c in ("slope", "intercept")]
    )


def trend_residuals(shows: DataFrame, score: str, by=("season",)) -> DataFrame:
    """Fitted downloads and the residual in log space (0 without a fit)."""
    usable = shows.filter(F.col(score).isNotNull() & (F.col("total_downloads") > 0))
    line = F.col("intercept") + F.col("slope") * F.col(score)
    return (
        usable.join(download_trend(shows, score, by).drop("shows"), list(by), "left")
        .withColumn("fitted_downloads", F.pow(F.lit(10.0), line))
        .withColumn("residual", F.coalesce(F.log10("total_downloads") - line, F.lit(0.0)))
        .drop("slope", "intercept")
    )


def outliers(residuals: DataFrame, by=("season",), limit: int = 8) -> DataFrame:
    """The largest residuals per season. Spark keeps ``limit`` rows per season
    in each task before it shuffles."""
    window = Window.partitionBy(*by).orderBy(F.desc(F.abs("residual")), F.asc("anilist_id"))
    return residuals.withColumn("outlier_rank", F.row_number().over(window)).filter(
        F.col("outlier_rank") <= limit
    )


def normalised_rank(df: DataFrame, metrics, by=("season",)) -> DataFrame:
    """1 for the best, 0 for the worst and for a missing value, per metric; equal values by id.
    The shows of a season are shuffled once and ranked on every metric there."""
    season = Window.partitionBy(*by)

    def share(metric: str) -> Column:
        value = F.col(metric).cast("double")
        place = F.row_number().over(season.orderBy(value.desc_nulls_last(), F.col("anilist_id")))
        count = F.count(value).over(season)
        scaled = F.when(count > 1, 1 - (place - 1) / (count - 1)).otherwise(1.0)
        return F.when(value.isNotNull(), scaled).otherwise(0.0)

    return df.withColumns({f"{metric}_norm": share(metric) for metric in metrics})
