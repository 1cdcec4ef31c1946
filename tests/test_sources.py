from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulse import rules
from pulse.sources import catalogue, feed, filenames, listing, surveys

NOW = datetime(2025, 1, 1, 12)

FEED = """<?xml version="1.0"?><rss xmlns:t="https://x.example/ns" version="2.0"><channel><title>c</title>
<item><title>[Grp] A &amp; B - 07 [1080p].mkv</title><guid isPermaLink="true">https://x.example/view/123</guid>
<pubDate>Wed, 04 Jun 2025 10:00:00 -0000</pubDate><t:seeders>5</t:seeders><t:leechers>6</t:leechers><t:downloads>7</t:downloads>
<t:infoHash>ABCDEF</t:infoHash><t:size>1.1 GiB</t:size><t:trusted>Yes</t:trusted><t:remake>No</t:remake></item>
<item><title>bare</title><guid>https://x.example/view/none</guid><t:infoHash>aa</t:infoHash></item>
<item><title>no hash</title></item>
<item><title>bad count</title><t:infoHash>bb</t:infoHash><t:seeders>many</t:seeders></item>
</channel></rss>"""


def test_feed(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text(FEED)
    rows = {r["infohash"]: r for r in feed.read_feed(spark, str(path), NOW).collect()}
    assert set(rows) == {"abcdef", "aa"}
    full = rows["abcdef"]
    assert full["filename"] == "[Grp] A & B - 07 [1080p].mkv"
    assert (full["source_id"], full["size_bytes"], full["trusted"], full["remake"]) == (123, int(1.1 * 1024**3), True, False)
    assert (full["seeders"], full["leechers"], full["downloads"]) == (5, 6, 7)
    assert full["pubdate"] == datetime(2025, 6, 4, 10)
    assert '"episode":7' in full["guessit_data"]
    bare = rows["aa"]
    assert (bare["pubdate"], bare["source_id"], bare["size_bytes"], bare["downloads"]) == (NOW, None, 0, 0)


def row_html(key, css="default", name="x", magnet=True, extra="", size="1.2 GiB", epoch="1735732800", cells=8):
    link = f'<a href="magnet:?xt=urn:btih:{key}&amp;dn=x"></a>' if magnet else ""
    rest = "<td>1</td><td>2</td><td>3</td>" if cells == 8 else ""
    return (
        f'<tr class="{css}"><td></td><td>{extra}<a href="/view/7" title="{name}">t</a></td><td>{link}</td>'
        f'<td>{size}</td><td data-timestamp="{epoch}">d</td>{rest}</tr>'
    )


def test_listing(spark):
    comments = '<a href="/view/9#comments" class="comments" title="2 comments">2</a>'
    html = '<table class="torrent-list"><tbody>' + "".join([
        row_html("aa", "success", "A &amp; B", extra=comments),
        row_html("bb", "danger"), row_html("cc", magnet=False), row_html("dd", size="big"),
        row_html("ee", epoch=""), row_html("ff", cells=5),
    ]) + "</tbody></table>"
    pages = spark.createDataFrame([(html,), ("<table><tbody>" + row_html("zz") + "</tbody></table>",)], "html string")
    rows = {r["infohash"]: r for r in listing.listing_rows(pages).collect()}
    assert set(rows) == {"aa", "bb"}
    first = rows["aa"]
    assert (first["filename"], first["source_id"], first["trusted"], first["remake"]) == ("A & B", 7, True, False)
    assert first["pubdate"] == datetime(2025, 1, 1, 12) and first["size_bytes"] == int(1.2 * 1024**3)
    assert (first["seeders"], first["leechers"], first["downloads"]) == (1, 2, 3)
    assert rows["bb"]["remake"] and not rows["bb"]["trusted"]


SURVEY = """放送日時,lvID,種別,シーズン,タイトル,話,1,2,3,4,5,エピソード種別,備考
2026/04/05 00:00,lv1,通常,2026B,"作品, A",１,80.5,10,5,,x,本編,
2026/04/06 00:00,lv2,一挙,2026B,作品A,1,80,10,5,3,2,本編,
2026/04/07 00:00,lv3,通常,2026B,作品A,SP,80,10,5,3,2,本編,
2026/04/08 00:00,lv4,通常,2025D,,3,80,10,5,3,2,本編,
2026/04/09 00:00,lv5,通常,2024A,作品C,3,80,10,5,3,2,本編,
"""


def test_survey_csv(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(SURVEY, encoding="utf-8")
    rows = surveys.read_surveys(spark, str(path))
    found = sorted((r["title"], r["episode"], r["very_good_pct"], r["bad_pct"], r["very_bad_pct"]) for r in rows.collect())
    assert found == [("作品, A", 1, 80.5, None, None), ("作品C", 3, 80.0, 3.0, 2.0)]
    assert [r["season_code"] for r in surveys.of_seasons(rows, rules.seasons(spark)).collect()] == ["2026B"]


@pytest.mark.parametrize(
    "name, title, season, episode, group, size, container",
    [
        ("[SubsPlease] Show Name - 05 (1080p) [ABCD1234].mkv", "Show Name", None, 5, "SubsPlease", "1080p", "mkv"),
        ("[Grp] Show S2 - 11v2 [720p].mkv", "Show", 2, 11, "Grp", "720p", "mkv"),
        ("Show Name S03E12 1080p WEB.mkv", "Show Name", 3, 12, None, "1080p", "mkv"),
        ("[G] Show 2nd Season - 03.mp4", "Show", 2, 3, "G", None, "mp4"),
        ("[G] Show - Part - 04 [1080p]", "Show - Part", None, 4, "G", "1080p", None),
    ],
)
def test_names(spark, name, title, season, episode, group, size, container):
    p = filenames.with_parsed(spark.range(1).select(F.lit(name).alias("n")), "n").first()["p"]
    got = (p["title"], p["season"], p["episode"], p["release_group"], p["screen_size"], p["container"])
    assert got == (title, season, episode, group, size, container)


def test_batch_and_unreadable_names(spark):
    json = lambda n: filenames.with_metadata(spark.range(1).select(F.lit(n).alias("n")), "n", "j").first()["j"]
    assert '"episode":[1,2,3]' in json("[G] Show 01-03 [Batch].mkv")
    assert json("[1080p]") is None


def test_media(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text(
        '{"id":1,"title":{"romaji":"R","english":null,"native":"日"},"synonyms":["s"],"episodes":12,"status":"FINISHED",'
        '"format":"TV","airingSchedule":{"nodes":[{"episode":1,"airingAt":5}]},"coverImage":null,"startDate":{"year":null,"month":3}}\n'
        '{"id":2,"title":{"romaji":"Q"},"startDate":{"year":2025,"month":10,"day":null},"idMal":9}\n'
    )
    first, second = catalogue.read_media(spark, str(path)).orderBy("anilist_id").collect()
    assert first["start_date"] is None and first["airing_schedule"][0]["airing_at"] == 5
    assert first["cover_image_url"] is None and first["title_native"] == "日"
    assert tuple(second["start_date"]) == (2025, 10, None) and second["synonyms"] == [] and second["mal_id"] == 9


def test_stale_ratings(spark):
    shows = spark.createDataFrame([(1, 11), (2, 12), (3, None), (4, 14), (5, 15)], "anilist_id bigint, mal_id bigint")
    ratings = spark.createDataFrame(
        [("mal", 1, "2024-12-31T12:00:00Z"), ("mal", 2, "2024-12-25T12:00:00Z"), ("mal", 4, "??"), ("other", 5, "2025-01-01T00:00:00Z")],
        "source string, anilist_id bigint, fetched_at string",
    )
    stale = catalogue.stale_shows(shows, ratings, NOW)
    assert sorted(r["anilist_id"] for r in stale.collect()) == [2, 4, 5]


def test_items_are_parsed_once(spark):
    from pulse.sources import feed

    raw = spark.createDataFrame([("<item><title>[G] T - 05 [720p].mkv</title><infoHash>AB</infoHash><seeders>x</seeders></item>",), ("<item>",), (None,)], "item string")
    rows = feed.feed_rows(feed.parse_items(raw, "item"), datetime(2024, 1, 1))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1 and rows.count() == 0
