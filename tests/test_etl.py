"""The whole recompute on a handful of torrents, with results worked by hand."""

import json
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse import rules
from pulse.operators import season as season_ops
from pulse.operators.reception import rank_deltas, survey_rollup, survey_series
from pulse.operators.series import counter_deltas, episode_dims, episode_series
from pulse.plans import etl, reports
from pulse.schema import RATINGS, STATS, SURVEYS, TORRENTS

START = datetime(2025, 10, 5, 6)  # a Sunday, 01:00 at UTC-5
NOW = datetime(2025, 11, 1)
CATALOGUE = (
    "anilist_id bigint, show_seq bigint, title_romaji string, title_english string, title_native string, synonyms array<string>, "
    "episodes int, status string, format string, cover_image_url string, cover_image_color string, average_score int, mean_score int, "
    "popularity bigint, favourites bigint, mal_id bigint"
)


def show(key, romaji, english=None, episodes=12, kind="TV", score=None):
    return (key, key, romaji, english, None, [], episodes, "FINISHED", kind, f"u{key}", None, score, None, 1, 2, None)


def name(title, episode, **more):
    return json.dumps({"title": title, "episode": episode, **more})


@pytest.fixture(scope="module")
def inputs(spark):
    week = timedelta(days=7)
    torrents = [
        ("a1", "alpha 1", START, name("Alpha Show", 1)), ("a1b", "alpha 1 v2", START + timedelta(hours=2), name("Alpha Show", "1")),
        ("a2", "alpha 2", START + week, name("Alpha Show", 2)), ("ab", "alpha batch", START, name("Alpha Show", [1, 2])),
        ("b1", "beta 1", START, name("Beta Story", 1)), ("m1", "movie", START, name("Gamma Movie", None)),
        ("x1", "other", START, name("Unheard Of Thing", 1)), ("x2", "ignored", START, name("One Piece", 1)),
        ("bad", "bad", START, "{oops"),
    ]
    rows = [(k, f, at, 1, 1, True, False, "active", data) for k, f, at, data in torrents]

    def reads(key, *points):
        return [(key, START + timedelta(hours=h), 1, 1, d) for h, d in points]

    stats = (
        reads("a1", (0, 100), (1, 150), (168, 250), (200, 240), (201, 290))  # 50, 100, 0, 50
        + reads("a1b", (2, 0), (3, 30)) + reads("a2", (168, 10), (170, 70), (340, 90)) + reads("ab", (0, 5), (1, 999))
        + reads("b1", (0, 0), (5, 500)) + reads("m1", (0, 0), (24, 40), (192, 100)) + reads("x1", (0, 7), (1, 77)) + reads("x2", (0, 900))
    )
    shows = spark.createDataFrame([show(1, "Alpha Show", "The Alpha", score=70), show(2, "Beta Story", score=90)], CATALOGUE)
    return etl.Inputs(
        torrents=spark.createDataFrame(rows, TORRENTS),
        stats=spark.createDataFrame(stats, STATS),
        shows=shows,
        members=spark.createDataFrame([("Fall 2025", 1), ("Fall 2025", 2)], "season string, anilist_id bigint"),
        ratings=spark.createDataFrame([("mal", 1, 5, (8.5, 10, 3, None, None, None), NOW)], RATINGS),
        surveys=spark.createDataFrame([(1, 2, 60.0, *[1.0] * 5, "u", NOW), (1, 1, 80.0, *[1.0] * 5, "u", NOW), (2, 1, None, *[1.0] * 5, "u", NOW)], SURVEYS),
        movies=spark.createDataFrame([show(9, "Gamma Movie", episodes=1, kind="MOVIE"), show(10, "Serial", episodes=5)], CATALOGUE),
        seasons=rules.seasons(spark),
    )


def load(out, report):
    lines = []
    for path in sorted(Path(out, report).rglob("*.json")):
        lines += [json.loads(line) for line in path.read_text().splitlines()]
    return lines


@pytest.fixture(scope="module")
def out(inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    etl.run(inputs, folder, NOW, datetime(2025, 10, 1))
    return folder


def test_rankings(out):
    weeks = {w["week"]: [(r["rank"], r["anilist_id"], r["downloads"], r["title"]) for r in w["rankings"]] for w in load(out, "rankings")}
    # Hour 168 after the first release is in the next week: a1 counts 100 + 50
    # there and a2 60; a2's last reading is in the week after.
    assert weeks == {
        "2025-10-05": [(1, 2, 500, "Beta Story"), (2, 1, 80, "The Alpha")],
        "2025-10-12": [(1, 1, 210, "The Alpha")],
        "2025-10-19": [(1, 1, 20, "The Alpha")],
    }


def test_season_shows(out):
    rows = {r["anilist_id"]: r for r in load(out, "season_shows")}
    alpha = rows[1]
    assert (alpha["total_downloads"], alpha["episodes_aired"], alpha["ep1_downloads"], alpha["current_rank"]) == (310, 2, 230, 1)
    # Episode 1: 50 + 30 + 100 in the first 7 days (hour 168 included), 50 later.
    assert alpha["late_starters"] == round(50 / 230, 3)
    assert alpha["endurance"] == round(80 / 230, 3)
    assert (alpha["mal_score"], alpha["niconico_very_good_pct"]) == (8.5, 70.0)
    assert [e["episode"] for e in alpha["niconico_episodes"]] == [1, 2]
    assert (alpha["rank_delta_dl_vs_mal"], alpha["rank_delta_dl_vs_anilist"], alpha["rank_delta_dl_vs_niconico"]) == (1, 0, 1)
    assert rows[2]["endurance"] is None and rows[2]["rank_delta_dl_vs_mal"] is None


def test_season_files(out):
    index = {r["slug"]: r for r in load(out, "seasons")}
    assert (index["fall-2025"]["status"], index["fall-2025"]["shows_count"], index["spring-2026"]["weeks_count"]) == ("in-progress", 2, 0)
    episodes = {(r["anilist_id"], r["episode"]): r["downloads_cumulative"] for r in load(out, "season_episodes")}
    assert episodes == {(1, 1): 230, (1, 2): 80, (2, 1): 500}
    bands = {(r["kind"], r["at"]): (r["p25"], r["p50"], r["p75"]) for r in load(out, "season_percentiles")}
    # Nearest of two: positions 0.25, 0.5 and 0.75 round to 0, 1 and 1.
    assert bands[("weekly_downloads", "2025-10-05")] == (80.0, 500.0, 500.0)
    cumulative = {(w["week"], r["anilist_id"]): r["downloads_cumulative"] for w in load(out, "season_weeks") for r in w["rankings"]}
    assert cumulative[("2025-10-05", 1)] == 80 and max(cumulative.values()) == 500


def test_other_reports(out):
    unmatched = load(out, "unmatched_torrents_report")
    assert {r["guessit_title"] for r in unmatched} == {"Unheard Of Thing", "Gamma Movie"}
    diagnostics = {(r["anilist_id"], r["week"]): r for r in load(out, "torrent_downloads_report")}
    first = diagnostics[(1, "2025-10-05")]
    assert [(t["infohash"], t["downloads"]) for t in first["torrents"]] == [("a1", 50), ("a1b", 30)]
    assert first["torrents"][0]["match_method"] == "fuzzy"
    movies = load(out, "movies")
    assert [(m["anilist_id"], m["total_downloads"], m["first_torrent_date"]) for m in movies] == [(9, 100, "2025-10-05")]
    assert [w["downloads_weekly"] for w in movies[0]["weekly_downloads"]] == [40, 60]
    matches = load(out, "movie_match_report")
    assert matches[0]["torrent_count"] == 1 and matches[0]["torrents"][0]["match"]["score"] == 100.0


def test_series_of_one_episode(spark, inputs):
    torrents = inputs.torrents.filter("infohash like 'a_'").selectExpr(
        "infohash", "pubdate", "filename", "cast(1 as bigint) anilist_id", "cast(1 as bigint) episode"
    )
    got = episode_series(counter_deltas(inputs.stats, episode_dims(torrents)))
    assert got.agg(F.sum("downloads_daily")).first()[0] == 50 + 100 + 50 + 60 + 20 + 994


def test_deltas(spark, inputs):
    rows = counter_deltas(inputs.stats.filter("infohash = 'a1'")).orderBy("timestamp").collect()
    assert [r["downloads_delta"] for r in rows] == [0, 50, 100, 0, 50]


def test_readings_are_read_and_shuffled_once(spark, tmp_path):
    """Of a stored table in which one key has a third of the rows, with and without torrents."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", START + timedelta(hours=i), i) for i in range(900)]
    folder = str(tmp_path / "stats")
    spark.createDataFrame(rows, "infohash string, timestamp timestamp, downloads bigint").write.parquet(folder)
    torrents = spark.createDataFrame([("hot", 1), ("k1", 2)], "infohash string, anilist_id bigint").hint("merge")
    for dims in (None, torrents):
        deltas = counter_deltas(spark.read.parquet(folder), dims)
        deltas.write.format("noop").mode("overwrite").save()
        plan = deltas._jdf.queryExecution().executedPlan()
        deltas.collect()  # the plan that ran
        executed = plan.toString().split("== Initial Plan ==")[0]
        scans = [line for line in executed.splitlines() if "Scan parquet" in line]
        by_day = [line for line in executed.splitlines() if re.search(r"Exchange hashpartitioning\(infohash#\d+, _day#", line) and "Reused" not in line]
        assert len(scans) == 1 and len(by_day) == 1, executed
    window = Window.partitionBy("infohash").orderBy("timestamp")
    plain = spark.read.parquet(folder).withColumn("d", F.col("downloads") - F.lag("downloads").over(window))
    expected = {(r["infohash"], r["timestamp"]): max(r["d"] or 0, 0) for r in plain.collect()}
    got = counter_deltas(spark.read.parquet(folder)).collect()
    assert {(r["infohash"], r["timestamp"]): r["downloads_delta"] for r in got} == expected


def test_groups_are_one_object(spark):
    rows = spark.range(1, 26).selectExpr("id AS n", "id * 2 AS v", "'g' AS g")
    found = reports.nested(rows, ["g"], "n", ["v"], "items").collect()
    assert [[i["v"] for i in p["items"]] for p in found] == [list(range(2, 51, 2))]


def test_season_with_too_few_points_has_no_trend(spark):
    rows = spark.createDataFrame([("s", 1, 10, 5.0), ("s", 2, 100, 6.0), ("t", 1, 10, 5.0), ("t", 2, 20, 5.0), ("t", 3, 30, 5.0)],
                                 "season string, anilist_id bigint, total_downloads bigint, score double")
    assert [r["slope"] for r in season_ops.download_trend(rows, "score").collect()] == [None, None]
    assert {r["residual"] for r in season_ops.trend_residuals(rows, "score").collect()} == {0.0}


def test_rank_deltas_and_survey_nulls(spark):
    rows = spark.createDataFrame([("s", 1, 300, 7.0), ("s", 2, 200, 9.0), ("s", 3, 100, None)],
                                 "season string, anilist_id bigint, total_downloads bigint, mal_score double")
    got = rank_deltas(rows, {"d": "mal_score"}).orderBy("anilist_id").collect()
    assert [r["d"] for r in got] == [-1, 1, None]
    surveys = spark.createDataFrame([(1, 1, None)], "anilist_id bigint, episode bigint, very_good_pct double")
    assert survey_rollup(surveys).first()["niconico_very_good_pct"] is None
    assert survey_series(surveys).count() == 0


def test_seasons_are_one_object_each_in_order(out):
    documents = load(out, "season")
    assert [d["season"] for d in documents] == ["Fall 2025"]
    document = documents[0]
    assert [w["week"] for w in document["weeks"]] == sorted(w["week"] for w in document["weeks"])
    totals = [s["total_downloads"] for s in document["shows"]]
    assert totals == sorted(totals, reverse=True) and len(totals) == 2
    assert document["weekly_percentiles"] and document["episode_percentiles"]


def test_run_reports_counts_and_near_misses(out):
    summary = {r["method"]: r["items"] for r in load(out, "match_summary")}
    assert sum(summary.values()) > 0 and summary.get("unmatched", 0) == sum(t["torrents"] for t in load(out, "unmatched_titles"))
