import pytest

from pulse import rules
from pulse.operators import resolve as ops
from pulse.operators.surveys import match_surveys, title_map
from pulse.sources.surveys import PERCENTAGES

SHOWS = "anilist_id bigint, show_seq bigint, title_romaji string, title_english string, title_native string, synonyms array<string>, format string"


@pytest.fixture(scope="module")
def shows(spark):
    return spark.createDataFrame(
        [
            (101, 0, "Spy x Family", None, "スパイファミリー", [], "TV"),
            (177937, 1, "Spy x Family Season 3", None, "スパイファミリー Season 3", ["2"], "TV"),
            (103, 2, "Hero Story 2nd Season", "Hero Story Two", "ヒーロー物語 第二期", [], "TV"),
            (104, 3, "Hero Story", None, "ヒーロー物語", [], "TV"),
            (105, 4, "Kizoku", "Noble", "貴族転生アニメーション", ["Kizoku Tensei Extra"], None),
            (172463, 5, "Jujutsu Kaisen: Shimetsu Kaiyuu", None, None, None, "TV"),
        ],
        SHOWS,
    )


def resolve(spark, shows, cases, overrides=None):
    """Resolve (title, season, episode) cases in one run, in their order."""
    rows = [(str(i), *case) for i, case in enumerate(cases)]
    titles = spark.createDataFrame(rows, "infohash string, title string, season bigint, episode bigint")
    listed = rules.overrides(spark, overrides or {"nothing": 1})
    found = {}
    for row in ops.resolve(titles, shows, listed, rules.episode_ranges(spark)).collect():
        match = (row["anilist_id"], row["method"], row["score"], row["season_matched"], row["matched_title"])
        found[int(row["infohash"])] = None if row["anilist_id"] is None else match
    return [found[i] for i in range(len(cases))]


CASES = [
    (("Spy x Family", None, 30), (177937, "episode_range", 100.0, None, "Spy x Family Season 3")),
    (("Spy x Family", None, 5), (101, "fuzzy", 100.0, None, "Spy x Family")),
    (("Hero Story", None, None), (104, "fuzzy", 100.0, None, "Hero Story")),
    (("Hero Story 2nd Season", 2, None), (103, "season_aware", 110.0, 2, "Hero Story 2nd Season")),
    (("Hero Story Two", 3, None), (103, "fuzzy", 100.0, None, "Hero Story 2nd Season")),
    # A bonused title (92 + 10) beats an exact one (100) listed before it.
    (("Spy Family x Season", 3, None), (177937, "season_aware", 105.0, 3, "Spy x Family Season 3")),
    (("Jujutsu Kaisen", None, 50), (172463, "episode_range", 100.0, None, "Jujutsu Kaisen: Shimetsu Kaiyuu")),
    (("Hero Story - Some Very Long Japanese Subtitle That Hides It", None, None), (104, "fuzzy", 100.0, None, "Hero Story")),
    (("2", None, None), None),
    (("日本語", None, None), None),
    (("Something else entirely", None, None), None),
    # Three letters before the dash are too few.
    (("Abc - Hero Story", None, None), None),
]


def test_cascade(spark, shows):
    got = resolve(spark, shows, [case for case, _ in CASES])
    assert got == [expected for _, expected in CASES]


def test_overrides(spark, shows):
    listed = {"some thing": 105, "gone": 999, "long name": 105}
    cases = [("Some Thing!", 4, None), ("Gone", None, None), ("Long Name - with a subtitle", 2, None)]
    named = (105, "manual_override", 100.0)
    assert resolve(spark, shows, cases, listed) == [(*named, 4, "Kizoku"), None, (*named, 2, "Kizoku")]


def test_unmatched_scores(spark, shows):
    titles = spark.createDataFrame(
        [("a", "Hero Tale Of Old", None, None), ("b", "2", None, None)], "infohash string, title string, season bigint, episode bigint"
    )
    resolved = ops.resolve(titles, shows, rules.overrides(spark), rules.episode_ranges(spark))
    scores = {r["infohash"]: r["best_score"] for r in ops.best_scores(ops.unmatched(resolved), shows).collect()}
    assert scores["b"] is None and 40 < scores["a"] < 85


def test_no_titles(spark, shows):
    empty = spark.createDataFrame([], "infohash string, title string, season bigint, episode bigint")
    resolved = ops.resolve(empty, shows, rules.overrides(spark), rules.episode_ranges(spark))
    assert resolved.count() == 0 and ops.match_summary(resolved).count() == 0


def test_surveys(spark, shows):
    rows = spark.createDataFrame(
        [
            ("ヒーロー物語", 1, "2026/04/09", 70.0), ("ヒーロー物語", 1, "2026/04/02", 80.0),
            ("ｓｐｙ x family！", 2, "2026/04/02", 60.0),
            ("貴族転生アニメーシヨン", 1, "2026/04/03", 50.0),
            ("貴族転生アニメーション 第二期 後半", 2, "2026/04/03", 40.0),
            ("別の作品", 1, "2026/04/03", 30.0), ("無関係", 1, "2026/04/03", 20.0),
        ],
        "title string, episode bigint, aired_at string, very_good_pct double",
    ).selectExpr("title", "episode", "aired_at", "very_good_pct", *[f"cast(5 as double) AS {p}" for p in PERCENTAGES[1:]])
    got = match_surveys(rows, shows, title_map(spark, {"別の・作品": 105}))
    found = sorted((r["anilist_id"], r["episode"], r["very_good_pct"]) for r in got.collect())
    # Two rows say (105, 1): the earliest broadcast, then title order, decides.
    assert found == [(101, 2, 60.0), (104, 1, 80.0), (105, 1, 30.0), (105, 2, 40.0)]


def test_summary_is_counted_by_the_write(spark, shows):
    rows = [(str(i), *case) for i, (case, _) in enumerate(CASES)]
    titles = spark.createDataFrame(rows, "infohash string, title string, season bigint, episode bigint")
    resolved = ops.resolve(titles, shows, rules.overrides(spark, {"nothing": 1}), rules.episode_ranges(spark))
    stored, summary = ops.stored_with_summary(resolved)
    assert stored.count() == len(CASES)
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, ops.match_summary(stored).collect()))
    assert ops.stored_with_summary(resolved.limit(0))[1].count() == 0
