"""Season membership, totals, retention and bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse import rules
from pulse.functions.numbers import round_binary
from pulse.operators import intervals
from pulse.operators import season as ops
from pulse.operators.ranking import weekly_rankings
from pulse.operators.reception import RANK_DELTAS
from pulse.operators.series import weekly_totals, with_show_labels
from pulse.plans import reports
from pulse.queries import registry
from pulse.queries import views as v
from pulse.queries.series import rankings_of, series_of, stored_series
from pulse.session import cut

IN_SEASON = v.WEEKLY + "," + v.SEASONS + """,
in_season AS (
  SELECT s.name AS season, r.* FROM rankings r
  JOIN members m USING (anilist_id) JOIN seasons s ON s.name = m.season
   AND CAST(r.week AS DATE) <= s.end_date AND CAST(r.week AS DATE) + 6 >= s.start_date),
totals AS (
  SELECT season, anilist_id, CAST(sum(downloads) AS BIGINT) AS total_downloads, arg_max(rank, week) AS current_rank
  FROM in_season GROUP BY ALL),
episodes AS (
  SELECT anilist_id, episode, CAST(sum(daily) AS BIGINT) AS downloads_total, max(days) AS max_days,
         CAST(sum(CASE WHEN days <= 7 THEN daily ELSE 0 END) AS BIGINT) AS downloads_early,
         episode - min(episode) OVER (PARTITION BY anilist_id) + 1 AS episode_ordinal
  FROM series GROUP BY anilist_id, episode),
kept AS (
  SELECT anilist_id, count(*) AS episodes_aired,
         coalesce(max(CASE WHEN episode_ordinal = 1 THEN downloads_total END), 0) AS ep1_downloads,
         max(CASE WHEN episode_ordinal = 1 THEN downloads_early END) AS early,
         CAST(sum(CASE WHEN episode_ordinal BETWEEN 2 AND 14 AND max_days >= 7 THEN downloads_total END) AS DOUBLE)
           / count(CASE WHEN episode_ordinal BETWEEN 2 AND 14 AND max_days >= 7 THEN 1 END) AS later
  FROM episodes GROUP BY anilist_id),
retained AS (
  SELECT anilist_id, episodes_aired, ep1_downloads,
         CASE WHEN ep1_downloads > 0 THEN later / ep1_downloads END AS endurance,
         CASE WHEN ep1_downloads > 0 THEN (ep1_downloads - early) / CAST(ep1_downloads AS DOUBLE) END AS late_starters
  FROM kept)"""


def seasons(spark):
    return rules.seasons(spark, v.SEASON_ROWS)


def in_season(spark, sf_dir, series=None):
    rankings = (
        rankings_of(spark, sf_dir) if series is None else weekly_rankings(weekly_totals(series))
    )
    return ops.season_rankings(rankings, seasons(spark), v.members(spark, sf_dir))


@registry.add(f"""WITH {IN_SEASON}
SELECT season, week, anilist_id, rank, downloads,
       CAST(sum(downloads) OVER (PARTITION BY season, anilist_id ORDER BY week) AS BIGINT) AS downloads_cumulative
FROM in_season""")
def season_running_totals(spark, sf_dir):
    return ops.running_totals(in_season(spark, sf_dir))


@registry.add(f"WITH {IN_SEASON} SELECT * FROM totals")
def season_totals(spark, sf_dir):
    return ops.season_totals(in_season(spark, sf_dir))


@registry.add(f"""WITH {IN_SEASON}
SELECT *, row_number() OVER (PARTITION BY season ORDER BY total_downloads DESC, anilist_id) AS season_rank FROM totals""")
def season_rank(spark, sf_dir):
    return ops.season_rank(ops.season_totals(in_season(spark, sf_dir)))


@registry.add(f"WITH {IN_SEASON} SELECT * FROM episodes")
def episode_totals(spark, sf_dir):
    return ops.episode_totals(series_of(spark, sf_dir))


@registry.add(f"WITH {IN_SEASON} SELECT * FROM retained")
def retention(spark, sf_dir):
    return ops.retention(ops.episode_totals(series_of(spark, sf_dir)))


@registry.add(f"""WITH {IN_SEASON}
SELECT s.name, replace(lower(s.name), ' ', '-') AS slug, s.season, s.year,
       strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date,
       CASE WHEN end_date < DATE '2024-01-30' THEN 'complete' ELSE 'in-progress' END AS status,
       (SELECT count(*) FROM members m WHERE m.season = s.name) AS shows_count,
       (SELECT count(DISTINCT week) FROM in_season i WHERE i.season = s.name) AS weeks_count,
       (SELECT max(week) FROM in_season i WHERE i.season = s.name) AS latest_week,
       (SELECT max(week) FROM in_season i WHERE i.season = s.name) AS latest_week_start
FROM seasons s""")
def season_index(spark, sf_dir):
    return ops.season_index(cut(in_season(spark, sf_dir)), seasons(spark), v.members(spark, sf_dir), v.READ_NOW)


EPISODES = IN_SEASON + """,
dated AS (
  SELECT m.season, anilist_id, episode, CAST(sum(daily) AS BIGINT) AS downloads_cumulative
  FROM series JOIN members m USING (anilist_id) JOIN seasons s ON s.name = m.season
  WHERE CAST(period_start AS DATE) BETWEEN start_date AND end_date GROUP BY ALL),
ordinals AS (
  SELECT *, episode - min(episode) OVER (PARTITION BY season, anilist_id) + 1 AS episode_ordinal FROM dated),
shares AS (
  SELECT o.*, o.downloads_cumulative / CAST(f.downloads_cumulative AS DOUBLE) AS downloads_pct
  FROM ordinals o JOIN ordinals f ON f.season = o.season AND f.anilist_id = o.anilist_id AND f.episode_ordinal = 1
  WHERE o.episode_ordinal <= 14 AND f.downloads_cumulative > 0)"""


def _dated(spark, sf_dir, series=None):
    series = series_of(spark, sf_dir) if series is None else series
    return ops.season_episodes(series, seasons(spark), v.members(spark, sf_dir))


def _shares(spark, sf_dir):
    return ops.first_episode_share(_dated(spark, sf_dir), ("season", "anilist_id"))


@registry.add(f"WITH {EPISODES} SELECT * FROM dated")
def season_episodes(spark, sf_dir):
    return _dated(spark, sf_dir)


@registry.add(f"WITH {EPISODES} SELECT * FROM shares")
def first_episode_share(spark, sf_dir):
    return _shares(spark, sf_dir)


@registry.add(f"""WITH {EPISODES}
SELECT season, anilist_id, row_number() OVER (PARTITION BY season, anilist_id ORDER BY episode_ordinal) - 1 AS pos, downloads_pct AS share
FROM shares""")
def retention_series(spark, sf_dir):
    arrays = ops.retention_series(_shares(spark, sf_dir), ("season", "anilist_id"))
    flat = arrays.select("season", "anilist_id", F.posexplode("retention").alias("pos", "share"))
    return flat.withColumn("pos", F.col("pos").cast("bigint"))


@registry.add(f"""WITH {EPISODES}
SELECT anilist_id, 'downloads' AS kind, row_number() OVER (PARTITION BY anilist_id ORDER BY episode) - 1 AS pos, downloads_cumulative AS value FROM dated
UNION ALL
SELECT anilist_id, 'rank', row_number() OVER (PARTITION BY anilist_id ORDER BY week) - 1, least(rank, 40) FROM in_season""")
def sparkline_series(spark, sf_dir):
    series = stored_series(spark, sf_dir)
    arrays = cut(ops.sparkline_series(_dated(spark, sf_dir, series), in_season(spark, sf_dir, series)))

    def flat(kind, column):
        rows = arrays.select("anilist_id", F.lit(kind).alias("kind"), F.posexplode(column).alias("pos", "value"))
        return rows.withColumns({c: F.col(c).cast("bigint") for c in ("pos", "value")})

    return flat("downloads", "downloads_by_episode").unionByName(flat("rank", "rank_by_week"))


def _linear(value: str, q: float, group: str) -> str:
    return f"quantile_cont(CAST({value} AS DOUBLE), {q})"


@registry.add(f"""WITH {EPISODES}
SELECT season, episode_ordinal, round({_linear('downloads_cumulative', .25, '')}, 6) AS p25,
       round({_linear('downloads_cumulative', .5, '')}, 6) AS p50, round({_linear('downloads_cumulative', .75, '')}, 6) AS p75
FROM ordinals WHERE episode_ordinal <= 14 GROUP BY ALL""")
def ordinal_bands(spark, sf_dir):
    shown = ops.ordinals(_dated(spark, sf_dir), ("season", "anilist_id"))
    bands = ops.ordinal_bands(shown, "downloads_cumulative", ("season",))
    return bands.withColumns({p: F.round(p, 6) for p in ("p25", "p50", "p75")})


@registry.add(f"""WITH {EPISODES}
SELECT season, episode_ordinal, round({_linear('downloads_pct', .25, '')}, 6) AS p25,
       round({_linear('downloads_pct', .5, '')}, 6) AS p50, round({_linear('downloads_pct', .75, '')}, 6) AS p75
FROM shares GROUP BY ALL""")
def share_bands(spark, sf_dir):
    bands = ops.ordinal_bands(_shares(spark, sf_dir), "downloads_pct", ("season",))
    return bands.withColumns({p: F.round(p, 6) for p in ("p25", "p50", "p75")})


def _nearest_sql(rows: str, group: str, value: str) -> str:
    pick = ", ".join(
        f"max(CASE WHEN n - 1 = floor((size - 1) * {q} + 0.5) THEN v END) AS {name}"
        for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT {group}, {pick} FROM (
      SELECT {group}, CAST({value} AS DOUBLE) AS v, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS n,
             count(*) OVER (PARTITION BY {group}) AS size FROM {rows}) GROUP BY ALL"""


@registry.add(f"WITH {IN_SEASON} {_nearest_sql('in_season', 'season, week', 'downloads')}")
def weekly_percentiles(spark, sf_dir):
    return ops.nearest_bands(in_season(spark, sf_dir), ["season", "week"], "downloads", F.col("anilist_id"))


@registry.add(f"""WITH {IN_SEASON},
weekly_bands AS ({_nearest_sql('in_season', 'season, week', 'downloads')}),
season_eps AS (SELECT season, episode, downloads_total FROM episodes JOIN (SELECT DISTINCT season, anilist_id FROM in_season) USING (anilist_id)),
episode_bands AS ({_nearest_sql('season_eps', 'season, episode', 'downloads_total')})
SELECT replace(lower(season), ' ', '-') AS slug, season, 'weekly_downloads' AS kind, week AS at, p25, p50, p75 FROM weekly_bands
UNION ALL
SELECT replace(lower(season), ' ', '-'), season, 'episode_downloads', CAST(episode AS VARCHAR), p25, p50, p75 FROM episode_bands""")
def season_percentiles_report(spark, sf_dir):
    series = stored_series(spark, sf_dir)
    return reports.season_percentiles_report(in_season(spark, sf_dir, series), series)


@registry.add(f"""WITH {IN_SEASON}, {v.SHOWS}
SELECT replace(lower(season), ' ', '-') AS slug, week, anilist_id, rank, downloads,
       CAST(sum(downloads) OVER (PARTITION BY season, anilist_id ORDER BY week) AS BIGINT) AS downloads_cumulative,
       coalesce(title_romaji, 'Unknown') AS title_romaji
FROM in_season LEFT JOIN shows USING (anilist_id)""")
def season_weeks_report(spark, sf_dir):
    labelled = with_show_labels(in_season(spark, sf_dir), v.shows(spark, sf_dir))
    nested = reports.season_weeks_report(labelled)
    return reports.flattened(nested, "rankings", ["slug", "week"]).select(
        "slug", "week", "anilist_id", "rank", "downloads", "downloads_cumulative", "title_romaji"
    )


def _fmt(value: str) -> str:
    """Exact binary rounding to three places."""
    return f"CAST(format('{{:.3f}}', {value}) AS DOUBLE)"


@registry.add(f"""WITH {IN_SEASON},
scored AS (
  SELECT t.*, r.episodes_aired, r.ep1_downloads, {_fmt('endurance')} AS endurance, {_fmt('late_starters')} AS late_starters,
         CASE WHEN t.anilist_id % 4 <> 0 THEN (t.anilist_id * 37 % 100) / 10.0 END AS mal_score
  FROM totals t JOIN retained r USING (anilist_id))
SELECT s.* EXCLUDE (mal_score), mal_score,
       row_number() OVER (PARTITION BY season ORDER BY total_downloads DESC, anilist_id)
       - CASE WHEN mal_score IS NOT NULL THEN row_number() OVER (PARTITION BY season, mal_score IS NOT NULL ORDER BY mal_score DESC, total_downloads DESC, anilist_id) END AS rank_delta_dl_vs_mal
FROM scored s""")
def season_shows_report(spark, sf_dir):
    """Season shows with rounded metrics and a rank delta."""
    members = v.members(spark, sf_dir).select("anilist_id").distinct()
    score = F.when(F.col("anilist_id") % 4 != 0, (F.col("anilist_id") * 37 % 100) / 10)
    empty = {c: F.lit(None).cast("double") for c in RANK_DELTAS.values()}
    metrics = members.withColumns(empty).withColumn("mal_score", score)
    series = stored_series(spark, sf_dir)
    report = reports.season_shows_report(
        in_season(spark, sf_dir, series), series, v.shows(spark, sf_dir), metrics
    )
    return report.select(
        "season", "anilist_id", "total_downloads", "current_rank", "episodes_aired", "ep1_downloads",
        "endurance", "late_starters", "mal_score", "rank_delta_dl_vs_mal",
    )


@registry.add(f"""WITH {IN_SEASON}
SELECT lower(replace(season, ' ', '-')) AS slug, anilist_id, total_downloads,
       row_number() OVER (PARTITION BY season ORDER BY total_downloads DESC, anilist_id) AS position,
       (SELECT count(DISTINCT week) FROM in_season i WHERE i.season = totals.season) AS weeks
FROM totals""")
def season_documents(spark, sf_dir):
    """Each season as one object; its shows in the order they have there."""
    series = stored_series(spark, sf_dir)
    rows = cut(with_show_labels(in_season(spark, sf_dir, series), v.shows(spark, sf_dir)))
    metrics = v.members(spark, sf_dir).select("anilist_id").distinct().withColumns(
        {c: F.lit(None).cast("double") for c in (*RANK_DELTAS.values(), "mal_score")}
    )
    shows = reports.season_shows_report(rows, series, v.shows(spark, sf_dir), metrics)
    documents = cut(reports.season_documents(reports.season_weeks_report(rows), shows, reports.season_percentiles_report(rows, series)))
    listed = documents.select("slug", F.size("weeks").cast("bigint").alias("weeks"), F.posexplode("shows").alias("at", "show"))
    return listed.select("slug", "show.anilist_id", "show.total_downloads", (F.col("at") + 1).cast("bigint").alias("position"), "weeks")


COHORTS = IN_SEASON + """,
cut AS (
  SELECT season, quantile_cont(CAST(ep1_downloads AS DOUBLE), 0.33) AS q1, quantile_cont(CAST(ep1_downloads AS DOUBLE), 0.66) AS q2
  FROM totals JOIN retained USING (anilist_id) WHERE ep1_downloads > 0 GROUP BY season),
cohorts AS (
  SELECT t.*, r.* EXCLUDE (anilist_id),
         CASE WHEN ep1_downloads = 0 OR ep1_downloads <= coalesce(q1, 0) THEN 'small'
              WHEN ep1_downloads <= coalesce(q2, q1, 0) THEN 'medium' ELSE 'big' END AS premiere_size
  FROM totals t JOIN retained r USING (anilist_id) LEFT JOIN cut USING (season))"""


def _cohorts(spark, sf_dir):
    series = stored_series(spark, sf_dir)
    shows = ops.season_totals(in_season(spark, sf_dir, series)).join(
        ops.retention(ops.episode_totals(series)), "anilist_id"
    )
    return ops.premiere_size(cut(shows))


@registry.add(f"WITH {COHORTS} SELECT season, anilist_id, ep1_downloads, premiere_size FROM cohorts")
def premiere_size(spark, sf_dir):
    return _cohorts(spark, sf_dir).select("season", "anilist_id", "ep1_downloads", "premiere_size")


@registry.add(f"""WITH {COHORTS}
SELECT season, premiere_size, round(median(endurance), 9) AS median FROM cohorts WHERE endurance > 0 GROUP BY ALL""")
def median_endurance(spark, sf_dir):
    rows = _cohorts(spark, sf_dir).filter(F.col("endurance") > 0)
    return ops.medians(rows, ["season", "premiere_size"], "endurance").withColumn("median", F.round("median", 9))


@registry.add(f"""WITH {COHORTS}
SELECT season, premiere_size, round(median(late_starters), 9) AS median FROM cohorts WHERE late_starters > 0.01 GROUP BY ALL""")
def median_late_starters(spark, sf_dir):
    rows = _cohorts(spark, sf_dir).filter(F.col("late_starters") > 0.01)
    return ops.medians(rows, ["season", "premiere_size"], "late_starters").withColumn("median", F.round("median", 9))


@registry.add(f"""WITH {COHORTS}
SELECT season, max(total_downloads) AS max_downloads, max(endurance) AS max_endurance, max(late_starters) AS max_late_starters
FROM cohorts GROUP BY season""")
def scaling_maxima(spark, sf_dir):
    return ops.scaling_maxima(_cohorts(spark, sf_dir))


@registry.add(f"""SELECT l_orderkey, l_linenumber, l_partkey, {_fmt('l_extendedprice / l_quantity')} AS unit_price FROM lineitem""")
def rounded_unit_price(spark, sf_dir):
    """Three places, halves to even on the binary value."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", round_binary(price, 3).alias("unit_price")
    )


@registry.add("""WITH spans AS (
  SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS start_day,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 400 AS end_day
  FROM orders)
SELECT a.o_custkey, a.o_orderkey AS one, b.o_orderkey AS two FROM spans a JOIN spans b ON a.o_custkey = b.o_custkey
  AND a.start_day <= b.end_day AND b.start_day <= a.end_day AND a.o_orderkey < b.o_orderkey""")
def overlapping_spans(spark, sf_dir):
    """Spans of up to 400 days that share a day, within a customer: two large sides."""
    start = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    spans = v.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", start.alias("s"), (start + F.col("o_orderkey") % 400).alias("e"))
    one = spans.select("o_custkey", F.col("o_orderkey").alias("one"), F.col("s").alias("s1"), F.col("e").alias("e1"))
    two = spans.select("o_custkey", F.col("o_orderkey").alias("two"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    met = intervals.overlapping(one, two, ("s1", "e1"), ("s2", "e2"), ["o_custkey"])
    return met.filter("one < two").select("o_custkey", "one", "two")


@registry.add(f"""WITH {IN_SEASON}
SELECT name AS season, week, count(*) AS shows FROM rankings JOIN seasons
  ON CAST(week AS DATE) <= end_date AND CAST(week AS DATE) + 6 >= start_date GROUP BY ALL""")
def ranked_in_season_weeks(spark, sf_dir):
    """Rows of the rankings in the weeks that share a day with a season, whatever their show's season."""
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("bigint")
    weeks = rankings_of(spark, sf_dir).select("week", day("week").alias("first_day"), (day("week") + 6).alias("last_day"))
    spans = seasons(spark).select(F.col("name").alias("season"), day("start_date").alias("begins"), day("end_date").alias("ends"))
    met = intervals.overlapping(weeks, spans, ("first_day", "last_day"), ("begins", "ends"))
    return met.groupBy("season", "week").agg(F.count(F.lit(1)).alias("shows"))
