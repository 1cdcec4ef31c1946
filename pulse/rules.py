"""Rule tables of title resolution, fixed in the code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pulse.session import literal_rows

# Seasons (name, season, year, first day, last day).
SEASONS = (
    ("Fall 2025", "FALL", 2025, date(2025, 10, 1), date(2025, 12, 31)),
    ("Winter 2026", "WINTER", 2026, date(2026, 1, 1), date(2026, 3, 31)),
    ("Spring 2026", "SPRING", 2026, date(2026, 4, 1), date(2026, 6, 30)),
)

# Normalised title to catalogue id.
TITLE_OVERRIDES = {
    "oshi no ko": 182587,
    "yuushakei ni shosu": 167152,
    "spy x family": 177937,
    "jujutsu kaisen": 172463,
    "jigokuraku": 166613,
    "mushoku no eiyuu": 169969,
    "mikata ga yowasugite hojo mahou": 188487,
    "akujiki reijou to kyouketsu koushaku": 183291,
    "enen no shouboutai": 179062,
    "kaguyasama wa kokurasetai": 194884,
    "kizoku tensei": 185993,
    "kanteishi": 200769,
    "honzuki no gekokujou": 171110,
    "dr stone": 199221,
    "shunkashuutou daikousha": 190143,
    "dorohedoro": 173172,
    "re zero kara hajimeru isekai seikatsu": 189046,
    "kirei ni shite moraemasu ka": 194028,
    "vigilante": 195322,
    "jojos bizarre adventure": 190327,
    "golden kamuy": 166521,
    "toumei otoko to ningen onna": 185039,
    "mf ghost": 185753,
    "kingdom": 190840,
    "ranma": 185731,
}

# Fixed values: (normalised title, first episode, last episode, catalogue id).
EPISODE_RANGES = (
    ("spy x family", 26, 50, 177937),
    ("jujutsu kaisen", 48, 75, 172463),
)

# Normalised titles left out of the unmatched report.
IGNORED_TITLES = ("gachiakuta", "silent witch", "secrets of the silent witch", "one piece")

# Misread title to corrected title.
TITLE_CORRECTIONS = {"oshi no": "oshi no ko"}

# Movies.
MOVIE_DATES = (date(2025, 6, 1), date(2026, 3, 31))
MOVIE_FORMATS = ("MOVIE", "ONA", "SPECIAL")
MOVIE_STATUSES = ("FINISHED", "RELEASING")
MOVIE_OVERRIDES = {
    "demon slayer kimetsu no yaiba infinity castle": 178788,
    "kimetsu no yaiba": 178788,
    "chainsaw man the movie reze arc": 171627,
    "gekijouban chainsaw man reze hen": 171627,
    "chainsaw man movie rezehen": 171627,
    "chainsaw man the movie": 171627,
    "cosmic princess kaguya": 201903,
}
MOVIE_EXCLUDED = (191205, 185993, 185753, 190327, 133007, 177687)

# Thresholds and cache lifetimes.
MATCH_THRESHOLD = 85
SEASON_BONUS = 10
SURVEY_MATCH_THRESHOLD = 90
RATING_TTL_DAYS = 7
SURVEY_TTL_DAYS = 1


def seasons(spark: SparkSession, rows=SEASONS) -> DataFrame:
    return literal_rows(
        spark, rows, "name string, season string, year int, start_date date, end_date date"
    )


def overrides(spark: SparkSession, rules: dict[str, int] | None = None) -> DataFrame:
    """An empty rule set means the defaults."""
    return literal_rows(
        spark, (rules or TITLE_OVERRIDES).items(), "normalized string, override_id bigint"
    )


def episode_ranges(spark: SparkSession, rows=EPISODE_RANGES) -> DataFrame:
    return literal_rows(
        spark,
        [(i, *row) for i, row in enumerate(rows)],
        "rule_seq int, normalized string, min_episode bigint, max_episode bigint, range_id bigint",
    )


def titles(spark: SparkSession, rows) -> DataFrame:
    return literal_rows(spark, [(r,) for r in rows], "normalized string")


def ids(spark: SparkSession, rows) -> DataFrame:
    return literal_rows(spark, [(r,) for r in rows], "anilist_id bigint")
