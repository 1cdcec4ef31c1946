"""Ratings, surveys and trends. See ``views.rated`` for what stands for a show."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions.numbers import weighted_mean
from pulse.operators import ranking, reception, season
from pulse.operators.windows import position_in_order
from pulse.queries import registry
from pulse.queries import views as v
from pulse.session import cut
from pulse.sources.surveys import PERCENTAGES


def _rank_sql(metric: str) -> str:
    return (
        f"CASE WHEN {metric} IS NOT NULL THEN row_number() OVER (PARTITION BY season, {metric} IS NOT NULL "
        f"ORDER BY {metric} DESC, total_downloads DESC, anilist_id) END"
    )


@registry.add(f"""WITH {v.RATED},
ranked AS (
  SELECT *, {_rank_sql('total_downloads')} AS d, {_rank_sql('mal_score')} AS m,
         {_rank_sql('average_score')} AS a, {_rank_sql('niconico_very_good_pct')} AS n FROM rated)
SELECT season, anilist_id, d - m AS rank_delta_dl_vs_mal, d - a AS rank_delta_dl_vs_anilist, d - n AS rank_delta_dl_vs_niconico
FROM ranked""")
def rank_deltas(spark, sf_dir):
    return reception.rank_deltas(cut(v.rated(spark, sf_dir))).select(
        "season", "anilist_id", *reception.RANK_DELTAS
    )


@registry.add(f"""WITH {v.RATED}
SELECT season, anilist_id, total_downloads, mal_score,
       row_number() OVER (PARTITION BY season ORDER BY total_downloads DESC, anilist_id) AS season_rank FROM rated""")
def shows_by_score(spark, sf_dir):
    """Cards in score order, missing scores last, season rank among equals."""
    ranked = season.season_rank(v.rated(spark, sf_dir)).select(
        "season", "anilist_id", "total_downloads", "mal_score", "season_rank"
    )
    return ranking.ordered_by_metric(ranked, "mal_score")


@registry.add(f"""WITH {v.RATED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY total_downloads DESC, anilist_id) AS season_rank FROM rated)
SELECT season, anilist_id, row_number() OVER (ORDER BY mal_score DESC NULLS LAST, season_rank, season) AS position FROM ranked""")
def positions_by_score(spark, sf_dir):
    """The place of every card in that order, over all seasons."""
    ranked = season.season_rank(v.rated(spark, sf_dir))
    order = [F.col("mal_score").desc_nulls_last(), F.col("season_rank"), F.col("season")]
    return position_in_order(ranked, order, "position").select("season", "anilist_id", "position")


@registry.add(f"""WITH {v.RATED}
SELECT season, anilist_id, {', '.join(f'''
  coalesce(CASE WHEN {m} IS NOT NULL THEN CASE WHEN count({m}) OVER (PARTITION BY season) > 1 THEN
    1 - (row_number() OVER (PARTITION BY season, {m} IS NOT NULL ORDER BY {m} DESC, anilist_id) - 1)
      / CAST(count({m}) OVER (PARTITION BY season) - 1 AS DOUBLE) ELSE 1.0 END END, 0.0) AS {m}_norm'''
  for m in ('total_downloads', 'mal_score'))}
FROM rated""")
def normalised_rank(spark, sf_dir):
    rows = season.normalised_rank(cut(v.rated(spark, sf_dir)), ["total_downloads", "mal_score"])
    return rows.select("season", "anilist_id", "total_downloads_norm", "mal_score_norm")


TREND = v.RATED + """,
usable AS (SELECT *, log10(total_downloads) AS y FROM rated WHERE mal_score IS NOT NULL AND total_downloads > 0),
trend AS (
  SELECT season, count(*) AS shows,
         CASE WHEN count(*) >= 3 AND min(mal_score) < max(mal_score) THEN regr_slope(y, mal_score) END AS slope,
         CASE WHEN count(*) >= 3 AND min(mal_score) < max(mal_score) THEN regr_intercept(y, mal_score) END AS intercept
  FROM usable GROUP BY season),
residuals AS (
  SELECT season, anilist_id, pow(10, intercept + slope * mal_score) AS fitted,
         coalesce(y - (intercept + slope * mal_score), 0) AS residual FROM usable JOIN trend USING (season))"""


@registry.add(f"WITH {TREND} SELECT season, shows, round(slope, 12) AS slope, round(intercept, 8) AS intercept FROM trend")
def download_trend(spark, sf_dir):
    rows = season.download_trend(v.rated(spark, sf_dir), "mal_score")
    return rows.withColumns({"slope": F.round("slope", 12), "intercept": F.round("intercept", 8)})


@registry.add(f"""WITH {TREND}
SELECT season, anilist_id, round(fitted, 2) AS fitted_downloads, round(residual, 8) AS residual FROM residuals""")
def trend_residuals(spark, sf_dir):
    rows = season.trend_residuals(v.rated(spark, sf_dir), "mal_score")
    return rows.select(
        "season", "anilist_id", F.round("fitted_downloads", 2).alias("fitted_downloads"),
        F.round("residual", 8).alias("residual"),
    )


@registry.add(f"""WITH {TREND}
SELECT season, anilist_id, outlier_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY abs(residual) DESC, anilist_id) AS outlier_rank FROM residuals)
WHERE outlier_rank <= 8""")
def trend_outliers(spark, sf_dir):
    rows = season.outliers(season.trend_residuals(v.rated(spark, sf_dir), "mal_score"))
    return rows.select("season", "anilist_id", F.col("outlier_rank").cast("bigint").alias("outlier_rank"))


@registry.add(f"""WITH {v.RATED},
cut AS (
  SELECT season, quantile_cont(CAST(total_downloads AS DOUBLE), 0.33) AS q1, quantile_cont(CAST(total_downloads AS DOUBLE), 0.66) AS q2
  FROM rated WHERE total_downloads > 0 GROUP BY season)
SELECT season, CASE WHEN total_downloads <= q1 THEN 'small' WHEN total_downloads <= q2 THEN 'medium' ELSE 'big' END AS premiere_size,
       count(*) AS shows
FROM rated JOIN cut USING (season) GROUP BY ALL""")
def premiere_sizes_by_nation(spark, sf_dir):
    sized = season.premiere_size(v.rated(spark, sf_dir), ("season",), "total_downloads")
    return sized.groupBy("season", "premiere_size").agg(F.count(F.lit(1)).alias("shows"))


@registry.add(f"""WITH {v.RATED}
SELECT season, round(quantile_cont(mal_score, 0.5), 9) AS median FROM rated WHERE mal_score IS NOT NULL GROUP BY season""")
def median_score_by_nation(spark, sf_dir):
    rows = season.medians(v.rated(spark, sf_dir), ["season"], "mal_score")
    return rows.withColumn("median", F.round("median", 9))


@registry.add(f"""WITH {v.RATED},
ranked AS (SELECT *, {_rank_sql('total_downloads')} - {_rank_sql('mal_score')} AS delta FROM rated)
SELECT season, max(abs(delta)) AS max_abs_delta FROM ranked GROUP BY season""")
def largest_rank_delta(spark, sf_dir):
    name = "rank_delta_dl_vs_mal"
    rows = reception.rank_deltas(v.rated(spark, sf_dir), {name: "mal_score"})
    return rows.groupBy("season").agg(F.max(F.abs(name)).alias("max_abs_delta"))


# Parts as shows, order years as episodes: the shares of five quantity bands of
# their line items, in whole per cent, are the survey answers.
SURVEYS = """
surveys AS (
  SELECT l_partkey AS anilist_id, CAST(year(l_shipdate) AS BIGINT) AS episode,
         CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE floor(count(CASE WHEN l_quantity <= 10 THEN 1 END) * 100.0 / count(*)) END AS very_good_pct,
         floor(count(CASE WHEN l_quantity > 10 AND l_quantity <= 20 THEN 1 END) * 100.0 / count(*)) AS good_pct,
         floor(count(CASE WHEN l_quantity > 20 AND l_quantity <= 30 THEN 1 END) * 100.0 / count(*)) AS normal_pct,
         floor(count(CASE WHEN l_quantity > 30 AND l_quantity <= 40 THEN 1 END) * 100.0 / count(*)) AS bad_pct,
         floor(count(CASE WHEN l_quantity > 40 THEN 1 END) * 100.0 / count(*)) AS very_bad_pct
  FROM lineitem GROUP BY l_partkey, year(l_shipdate))"""


def _surveys(spark, sf_dir):
    quantity = F.col("l_quantity")
    limits = (0, 10, 20, 30, 40, 10**9)
    bands = [
        F.floor(F.count_if((quantity > low) & (quantity <= high)) * 100.0 / F.count(F.lit(1)))
        .cast("double")
        .alias(name)
        for name, low, high in zip(PERCENTAGES, limits[:-1], limits[1:], strict=True)
    ]
    rows = v.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").alias("anilist_id"), F.year("l_shipdate").cast("bigint").alias("episode")
    ).agg(*bands)
    answered = F.when(F.col("anilist_id") % 11 != 0, F.col("very_good_pct"))
    return rows.withColumn("very_good_pct", answered)


@registry.add(f"""WITH {SURVEYS}, summed AS (
  SELECT *, 0.0 + coalesce(very_good_pct, 0) + good_pct + normal_pct + bad_pct + very_bad_pct AS total,
         0.0 + 5 * coalesce(very_good_pct, 0) + 4 * good_pct + 3 * normal_pct + 2 * bad_pct + very_bad_pct AS weighted FROM surveys)
SELECT anilist_id, episode, CASE WHEN total > 0 THEN CAST(format('{{:.3f}}', CAST(weighted / total AS DOUBLE)) AS DOUBLE) END AS mean_score FROM summed""")
def survey_means(spark, sf_dir):
    mean = weighted_mean([F.col(p) for p in PERCENTAGES]).alias("mean_score")
    return _surveys(spark, sf_dir).select("anilist_id", "episode", mean)


@registry.add(f"""WITH {SURVEYS}
SELECT anilist_id, CAST(format('{{:.2f}}', avg(CAST(very_good_pct AS DOUBLE))) AS DOUBLE) AS niconico_very_good_pct FROM surveys GROUP BY anilist_id""")
def survey_rollup(spark, sf_dir):
    return reception.survey_rollup(_surveys(spark, sf_dir))


@registry.add(f"""WITH {SURVEYS}
SELECT anilist_id, episode, row_number() OVER (PARTITION BY anilist_id ORDER BY episode) - 1 AS pos, CAST(very_good_pct AS DOUBLE) AS very_good_pct
FROM surveys WHERE very_good_pct IS NOT NULL""")
def survey_series(spark, sf_dir):
    arrays = reception.survey_series(_surveys(spark, sf_dir))
    flat = arrays.select("anilist_id", F.posexplode("niconico_episodes"))
    return flat.select("anilist_id", "col.episode", F.col("pos").cast("bigint").alias("pos"), "col.very_good_pct")


@registry.add(f"""WITH {SURVEYS}, answered AS (SELECT anilist_id, count(very_good_pct) AS n FROM surveys GROUP BY anilist_id)
SELECT p_partkey AS anilist_id, p_size AS average_score, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END AS mal_score,
       CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 2 END AS mal_scored_by, nullif(coalesce(n, 0), 0) AS surveyed
FROM part LEFT JOIN answered ON anilist_id = p_partkey""")
def show_metrics(spark, sf_dir):
    """Scores, external ratings and surveys of every show."""
    part = v.table(spark, sf_dir, "part")
    none = F.lit(None).cast("bigint")
    shows = part.select(
        F.col("p_partkey").alias("anilist_id"), F.col("p_size").alias("average_score"),
        none.alias("mean_score"), none.alias("popularity"), none.alias("favourites"), none.alias("mal_id"),
    )
    ratings = part.filter(F.col("p_partkey") % 3 == 0).select(
        F.lit("mal").alias("source"), F.col("p_partkey").alias("anilist_id"),
        F.struct(
            F.col("p_retailprice").alias("score"), (F.col("p_partkey") * 2).alias("scored_by"),
            F.lit(1).alias("rank"),
        ).alias("payload"),
    )
    rows = reception.show_metrics(shows, ratings, _surveys(spark, sf_dir))
    return rows.select(
        "anilist_id", "average_score", "mal_score", "mal_scored_by",
        F.size("niconico_episodes").cast("bigint").alias("surveyed"),
    )
