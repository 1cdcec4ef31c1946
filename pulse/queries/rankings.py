"""Weekly movement, recent weeks, report selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.operators import ranking as ops
from pulse.operators.series import counter_deltas, episode_dims, weekly_totals, with_show_labels
from pulse.plans import reports
from pulse.queries import registry
from pulse.queries import views as v
from pulse.queries.series import rankings_of, series_of, stored_rankings
from pulse.session import cut

MOVEMENT = v.WEEKLY + """,
weeks AS (SELECT week, row_number() OVER (ORDER BY week DESC) - 1 AS weeks_ago FROM (SELECT DISTINCT week FROM rankings)),
placed AS (SELECT * FROM rankings JOIN weeks USING (week) WHERE weeks_ago < 4),
movement AS (
  SELECT c.week, c.weeks_ago, c.anilist_id, c.rank, c.downloads, p.downloads AS previous_downloads,
         p.rank - c.rank AS rank_change, c.downloads - p.downloads AS download_change,
         CASE WHEN p.downloads > 0 THEN (c.downloads - p.downloads) / CAST(p.downloads AS DOUBLE) END AS download_change_pct,
         p.rank IS NULL AS is_new, c.weeks_ago = (SELECT max(weeks_ago) FROM placed) AS is_oldest
  FROM placed c LEFT JOIN placed p ON p.anilist_id = c.anilist_id AND p.weeks_ago = c.weeks_ago + 1)"""


@registry.add(f"WITH {MOVEMENT} SELECT * FROM movement")
def week_over_week(spark, sf_dir):
    moved = ops.week_over_week(stored_rankings(spark, sf_dir), 4)
    return moved.withColumn("weeks_ago", F.col("weeks_ago").cast("bigint"))


@registry.add(f"WITH {MOVEMENT} SELECT week, weeks_ago, anilist_id, rank FROM placed WHERE weeks_ago < 2")
def recent_weeks(spark, sf_dir):
    rows = ops.recent_weeks(stored_rankings(spark, sf_dir), 2)
    return rows.select("week", F.col("weeks_ago").cast("bigint").alias("weeks_ago"), "anilist_id", "rank")


def _line_sql(html: bool) -> str:
    def span(css: str, text: str) -> str:
        return f"""concat('<span class="{css}">', {text}, '</span>')""" if html else text

    number = "CAST(abs(rank_change) AS VARCHAR)"
    arrow = f"concat('%s', repeat(' ', greatest(0, 2 - length({number}))), {number})"
    percent = "CAST(floor((downloads - previous_downloads) / CAST(previous_downloads AS DOUBLE) * 100 + 0.5) AS BIGINT)"
    digits = f"CAST(abs({percent}) AS VARCHAR)"
    percent_text = (
        f"concat(CASE WHEN {percent} >= 0 THEN '+' ELSE '-' END, repeat(' ', greatest(0, 3 - length({digits}))), {digits}, '%')"
    )
    thousands = "format('{:,}', downloads)"
    blank = " " * (5 if html else 6)
    return f"""concat('#', repeat(' ', greatest(0, 2 - length(CAST(rank AS VARCHAR)))), rank, ' (',
      CASE WHEN is_oldest THEN '   ' WHEN is_new THEN {span('rank-new', "'NEW'")}
           WHEN rank_change > 0 THEN {span('rank-up', arrow % '↑')} WHEN rank_change < 0 THEN {span('rank-down', arrow % '↓')}
           ELSE {span('rank-same', "' — '")} END, ') ',
      repeat(' ', greatest(0, 6 - length({thousands}))), {thousands}, ' (',
      CASE WHEN NOT is_oldest AND previous_downloads > 0 THEN
        CASE WHEN {percent} > 0 THEN {span('dl-up', percent_text)} WHEN {percent} < 0 THEN {span('dl-down', percent_text)}
             ELSE {span('dl-same', percent_text)} END
      ELSE '{blank}' END, ') ', coalesce(title_romaji, 'Unknown'))"""


def _lines(spark, sf_dir, html):
    labelled = with_show_labels(stored_rankings(spark, sf_dir), v.shows(spark, sf_dir))
    return ops.ranking_lines(ops.week_over_week(labelled, 4), html)


@registry.add(f"""WITH {MOVEMENT}, {v.SHOWS}
SELECT week, rank, anilist_id, {_line_sql(False)} AS line FROM movement LEFT JOIN shows USING (anilist_id)""")
def ranking_lines(spark, sf_dir):
    return _lines(spark, sf_dir, False)


@registry.add(f"""WITH {MOVEMENT}, {v.SHOWS}
SELECT week, rank, anilist_id, {_line_sql(True)} AS line FROM movement LEFT JOIN shows USING (anilist_id)""")
def ranking_lines_html(spark, sf_dir):
    return _lines(spark, sf_dir, True)


_CURRENT_WEEK = v.week_sql("TIMESTAMP '2024-01-30 12:00:00'")


@registry.add(f"WITH {v.WEEKLY} SELECT week, anilist_id, rank FROM rankings WHERE week <> {_CURRENT_WEEK}")
def finished_weeks(spark, sf_dir):
    return ops.without_week_of(rankings_of(spark, sf_dir), v.READ_NOW).select("week", "anilist_id", "rank")


@registry.add(f"""WITH {v.WEEKLY}
SELECT week, anilist_id, rank, least(rank, 10) AS shown_rank FROM rankings WHERE rank <= 25""")
def top_25_with_clamped_rank(spark, sf_dir):
    top = ops.top_ranked(rankings_of(spark, sf_dir), 25)
    return top.select(
        "week", "anilist_id", "rank", ops.clamped_rank(10).cast("bigint").alias("shown_rank")
    )


@registry.add(f"""WITH {v.WEEKLY}
SELECT DISTINCT anilist_id FROM (
  SELECT anilist_id, downloads, lag(downloads) OVER (PARTITION BY anilist_id ORDER BY week) AS before FROM weekly)
WHERE before > 0 AND downloads / CAST(before AS DOUBLE) > 1.05""")
def grown_shows(spark, sf_dir):
    return ops.grown_shows(weekly_totals(series_of(spark, sf_dir)), 1.05)


@registry.add(f"""WITH {v.WEEKLY}, {v.SHOWS}
SELECT week, anilist_id, rank, downloads, coalesce(title_english, title_romaji, 'Unknown') AS title
FROM rankings LEFT JOIN shows USING (anilist_id) WHERE week <> {_CURRENT_WEEK}""")
def rankings_report(spark, sf_dir):
    """The nested report, flattened again."""
    labelled = with_show_labels(rankings_of(spark, sf_dir), v.shows(spark, sf_dir))
    nested = reports.rankings_report(labelled, v.READ_NOW)
    return reports.flattened(nested, "rankings", ["week"]).select(
        "week", "anilist_id", "rank", "downloads", "title"
    )


TORRENT_WEEKS = v.DELTAS + f""",
per_torrent AS (
  SELECT anilist_id, {v.week_sql('ts')} AS week, infohash, episode, CAST(sum(delta) AS BIGINT) AS downloads
  FROM deltas WHERE {v.week_sql('ts')} <> {_CURRENT_WEEK} GROUP BY ALL)"""


def _named(spark, sf_dir):
    return v.torrents(spark, sf_dir).withColumn("filename", F.concat("infohash", F.lit(".mkv")))


def _deltas(spark, sf_dir, torrents):
    return counter_deltas(v.readings(spark, sf_dir), episode_dims(torrents))


@registry.add(f"WITH {TORRENT_WEEKS} SELECT * FROM per_torrent")
def torrent_weeks(spark, sf_dir):
    rows = reports.torrent_weeks(_deltas(spark, sf_dir, _named(spark, sf_dir)), v.READ_NOW)
    return rows.drop("filename")


@registry.add(f"""WITH {TORRENT_WEEKS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY downloads DESC, anilist_id) AS rank
  FROM (SELECT week, anilist_id, sum(downloads) AS downloads FROM per_torrent GROUP BY ALL)),
kept AS (
  SELECT anilist_id FROM ranked WHERE rank <= 30
  UNION
  SELECT anilist_id FROM (SELECT anilist_id, downloads, lag(downloads) OVER (PARTITION BY anilist_id ORDER BY week) AS before FROM ranked)
  WHERE before > 0 AND downloads / CAST(before AS DOUBLE) > 2)
SELECT week, anilist_id, infohash, episode, downloads, CAST(sum(downloads) OVER (PARTITION BY anilist_id, week) AS BIGINT) AS total_downloads,
       row_number() OVER (PARTITION BY anilist_id, week ORDER BY downloads DESC, infohash) AS position,
       CASE WHEN anilist_id % 2 = 0 THEN 'fuzzy' ELSE 'manual_override' END AS match_method
FROM per_torrent WHERE anilist_id IN (SELECT anilist_id FROM kept)""")
def torrent_diagnostics(spark, sf_dir):
    """Torrents behind the totals of noteworthy shows; flattened."""
    named = _named(spark, sf_dir)
    per_torrent = cut(reports.torrent_weeks(_deltas(spark, sf_dir, named), v.READ_NOW))
    weekly = per_torrent.groupBy("week", "anilist_id").agg(F.sum("downloads").alias("downloads"))
    matches = named.select(
        "infohash",
        F.when(F.col("anilist_id") % 2 == 0, "fuzzy").otherwise("manual_override").alias("method"),
        F.lit(100.0).alias("score"),
    )
    nested = reports.diagnostics_report(
        per_torrent, ops.weekly_rankings(weekly), matches, v.shows(spark, sf_dir)
    )
    flat = nested.select("week", "anilist_id", "total_downloads", F.posexplode("torrents"))
    return flat.select(
        "week", "anilist_id", "total_downloads",
        (F.col("pos") + 1).cast("bigint").alias("position"),
        "col.infohash", "col.episode", "col.downloads", "col.match_method",
    )
