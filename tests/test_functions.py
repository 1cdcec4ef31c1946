import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulse.functions import numbers, text, times
from pulse.functions.metadata import aggregation_episode, json_or_error, matching_fields


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_round_binary_is_python_round(spark):
    pick = random.Random(1)
    values = [0.0625, 2.675, 0.0005, 1.0005, -2.5, 0.1235, 0.0004999] + [
        pick.randrange(1, 9999) / pick.randrange(1, 999) for _ in range(500)
    ]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", numbers.round_binary(F.col("v"), 3).alias("r")).collect():
        assert row["r"] == round(row["v"], 3), row


@pytest.mark.parametrize(
    "size, feed, listing",
    [("1.1 GiB", int(1.1 * 1024**3), int(1.1 * 1024**3)), ("309.2 MB", int(309.2 * 1024**2), 309200000),
     ("7 kb", 7168, None), ("12", 0, None), ("1 2 GB", 0, None), ("3KiB", 0, 3072), ("x GB", 0, None), ("5 B", 5, 5)],
)
def test_sizes(spark, size, feed, listing):
    assert one(spark, numbers.feed_size(F.lit(size))) == feed
    assert one(spark, numbers.listing_size(F.lit(size))) == listing


@pytest.mark.parametrize("hours, bucket", [(0.0, 0), (1.99, 1), (168.0, 168), (168.5, 168), (191.9, 168), (192.0, 192)])
def test_time_bucket(spark, hours, bucket):
    assert one(spark, times.time_bucket(F.lit(hours))) == bucket


@pytest.mark.parametrize(
    "at, week",
    [("2025-10-05T04:59:59Z", "2025-09-28"), ("2025-10-05T05:00:00Z", "2025-10-05"), ("2025-10-11T23:00:00Z", "2025-10-05")],
)
def test_week_starts_sunday_at_utc_minus_5(spark, at, week):
    assert one(spark, times.week_label(F.lit(at))) == week


def test_week_texts(spark):
    start = F.to_date(F.lit("2025-12-28"))
    assert one(spark, times.date_range_label(start)) == "Dec 28 – Jan 3, 2026, 2026"
    assert one(spark, times.date_range_label(F.to_date(F.lit("2026-01-11")))) == "Jan 11 – Jan 17, 2026"
    assert str(one(spark, times.iso_week_monday(F.lit("2025-W40")))) == "2025-09-29"


def test_rfc822(spark):
    now = F.lit(datetime(2025, 1, 1)).cast("timestamp")
    read = lambda t: str(one(spark, times.rfc822(F.lit(t), now)))
    assert read("Wed, 04 Jun 2025 10:00:00 -0000") == "2025-06-04 10:00:00"
    assert read("Wed, 04 Jun 2025 10:00:00 +0200") == "2025-06-04 08:00:00"
    assert read("Wed, 04 Jun 2025 10:00:00 GMT") == "2025-06-04 10:00:00"
    assert read("not a date") == "2025-01-01 00:00:00"


def test_titles(spark):
    assert one(spark, text.normalize_title(F.lit("  [Oshi no Ko]　 3rd\tSeason! "))) == "oshi no ko 3rd season"
    assert one(spark, text.title_before_dash(F.lit("A - B - C"))) == "A"
    assert one(spark, text.title_before_dash(F.lit("A-B"))) is None
    assert one(spark, text.is_informative(F.lit("12"))) is False
    assert one(spark, text.season_code(F.lit("winter"), F.lit(2026))) == "2026A"
    assert one(spark, text.season_slug(F.lit("Fall 2025"))) == "fall-2025"


def test_identifiers(spark):
    assert one(spark, text.last_path_number(F.lit("https://x.example/view/1994?p=3#c"))) == 1994
    assert one(spark, text.last_path_number(F.lit("https://x.example/view/abc"))) is None
    assert one(spark, text.last_path_number(F.lit("https://x.example"))) is None
    assert one(spark, text.magnet_infohash(F.lit("magnet:?dn=a&xt=urn:btih:ABCD&tr=x"))) == "ABCD"
    assert one(spark, text.magnet_infohash(F.lit("magnet:?dn=a"))) is None
    assert one(spark, text.escape_html(F.lit("<a href=\"x\">'&'</a>"))) == "&lt;a href=&quot;x&quot;&gt;&#039;&amp;&#039;&lt;/a&gt;"


def test_compact(spark):
    read = lambda n: one(spark, numbers.compact(F.lit(n)))
    assert [read(n) for n in (999, 1000, 12500, 999499, 1000000, 1250000)] == ["999", "1K", "13K", "999K", "1.0M", "1.3M"]


def line(spark, change, previous, new=False, oldest=False, html=False, downloads=12345):
    return one(spark, text.ranking_line(
        F.lit(3), F.lit(change).cast("int"), F.lit(downloads), F.lit(previous).cast("int"), F.lit(new), F.lit(oldest), F.lit("T"), html,
    ))


def test_ranking_line(spark):
    assert line(spark, 2, 10000) == "# 3 (↑ 2) 12,345 (+ 23%) T"
    assert line(spark, -12, 20000) == "# 3 (↓12) 12,345 (- 38%) T"
    assert line(spark, 0, 12345) == "# 3 ( — ) 12,345 (+  0%) T"
    assert line(spark, None, None, new=True) == "# 3 (NEW) 12,345 (      ) T"
    assert line(spark, None, None, oldest=True) == "# 3 (   ) 12,345 (      ) T"
    assert line(spark, 1, 100, downloads=1234567) == "# 3 (↑ 1) 1,234,567 (+1234467%) T"
    assert line(spark, 2, 10000, html=True) == '# 3 (<span class="rank-up">↑ 2</span>) 12,345 (<span class="dl-up">+ 23%</span>) T'


@pytest.mark.parametrize(
    "json, counted, matched",
    [('{"title":"A","episode":3}', 3, 3), ('{"title":"A","episode":"12"}', 12, None), ('{"title":"A","episode":6.5}', 6, None),
     ('{"title":"A","episode":"6.5"}', None, None), ('{"title":"A","episode":[4,5]}', None, 4), ('{"title":"A","episode":[]}', None, None),
     ('{"title":"A"}', None, None), ('{"title":"A","episode":null}', None, None), ("broken", None, None), ("[1]", None, None)],
)
def test_episode_rules(spark, json, counted, matched):
    assert one(spark, aggregation_episode(F.lit(json))) == counted
    assert one(spark, matching_fields(F.lit(json)))["episode"] == matched


def test_matching_fields(spark):
    row = one(spark, matching_fields(F.lit('{"title":" Oshi No ","season":2}')))
    assert (row["title"], row["season"]) == ("oshi no ko", 2)
    row = one(spark, matching_fields(F.lit('{"title":"A","season":[1,2]}')))
    assert (row["title"], row["season"]) == ("A", None)
    row = one(spark, matching_fields(F.lit('{"title":["A","B"],"season":2,"episode":1}')))
    assert (row["title"], row["season"], row["episode"]) == (None, None, None)


def test_unreadable_json_is_kept(spark):
    assert one(spark, json_or_error(F.lit("{x"))) == '{"_parse_error":"invalid_json","_raw":"{x"}'
    assert one(spark, json_or_error(F.lit(None).cast("string"))) == "{}"
