"""Parsing of feeds, listings, surveys, catalogues and names. The texts to parse
are written by Spark from the given tables, so the SQL knows what must come out."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from pulse import rules
from pulse.functions.times import utc
from pulse.operators.store import feed_to_tables
from pulse.plans import collector, reception
from pulse.queries import registry
from pulse.queries import views as v
from pulse.schema import MEDIA, RATING_PAYLOAD
from pulse.session import cut, ensure_checkpoint_dir
from pulse.sources import catalogue, feed, filenames, listing, surveys
from pulse.streaming import jobs

_HASH = "md5(CAST(o_orderkey AS VARCHAR))"


def _orders(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    return v.table(spark, sf_dir, "orders").withColumns(
        {"_key": key, "_hash": F.md5(key), "_epoch": F.unix_seconds(utc("o_orderdate")).cast("string")}
    )


LISTED = f"""
  SELECT {_HASH} AS infohash, concat('[G] Order & Co ', o_orderkey, ' - 05 [720p].mkv') AS filename, epoch_us(o_orderdate) AS published,
         CAST(trunc(o_orderkey * 1.5 * 1048576) AS BIGINT) AS size_bytes, o_orderkey AS source_id,
         o_orderkey % 5 = 0 AS trusted, o_orderkey % 5 = 1 AS remake, o_orderkey % 90 AS seeders, o_orderkey % 7 AS leechers, o_custkey AS downloads
  FROM orders"""


@registry.add(LISTED + " WHERE o_orderkey % 11 <> 0")
def listing_rows(spark, sf_dir):
    """Listing pages of up to 75 orders; every 11th row lacks its magnet link."""
    orders, key = _orders(spark, sf_dir), F.col("_key")

    def text(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    number = F.col("o_orderkey")
    css = F.when(number % 5 == 0, "success").when(number % 5 == 1, "danger").otherwise("default")
    comments = F.when(
        number % 2 == 0, text('<a href="/view/', key, '#comments" class="comments" title="3 comments">3</a>')
    ).otherwise("")
    magnet = F.when(
        number % 11 != 0, text('<a href="magnet:?xt=urn:btih:', F.col("_hash"), '&amp;dn=x"><i></i></a>')
    ).otherwise("")
    row = text(
        '<tr class="', css, '">\n<td><a href="/?c=1_2"><img></a></td><td colspan="2">', comments,
        '<a href="/view/', key, '" title="[G] Order &amp; Co ', key, ' - 05 [720p].mkv">x</a></td><td>',
        '<a href="/download/', key, '.torrent"></a>', magnet, "</td><td>", (number * 1.5).cast("string"), " MiB</td>",
        '<td data-timestamp="', F.col("_epoch"), '">date</td><td>', (number % 90).cast("string"), "</td><td>",
        (number % 7).cast("string"), "</td><td>", F.col("o_custkey").cast("string"), "</td></tr>",
    )
    pages = orders.groupBy(F.floor(number / 75).alias("page")).agg(
        text(
            "<html><table class='other'><tbody><tr></tr></tbody></table>",
            '<table class="table torrent-list"><thead><tr><th>x</th></tr></thead><tbody>',
            F.array_join(F.collect_list(row), "\n"), "</tbody></table></html>",
        ).alias("html")
    )
    return listing.listing_rows(pages).select(
        "infohash", "filename", v.micros("pubdate").alias("published"), "size_bytes", "source_id", "trusted",
        "remake", "seeders", "leechers", "downloads",
    )


_FEED_NOW = datetime(2000, 1, 1)


def _feed_items(spark, sf_dir):
    number, key = F.col("o_orderkey"), F.col("_key")
    date = F.date_format(utc("o_orderdate"), "EEE, dd MMM yyyy HH:mm:ss")
    xml = F.concat(
        F.lit("<item><title>[G] Order &amp; Co "), key, F.lit(' - 05 [720p].mkv</title><guid isPermaLink="true">https://x.example/view/'),
        key, F.lit("</guid><pubDate>"), F.when(number % 13 == 0, "soon").otherwise(F.concat(date, F.lit(" -0000"))),
        F.lit("</pubDate>"), F.when(number % 9 != 0, F.concat(F.lit("<seeders>"), (number % 90).cast("string"), F.lit("</seeders>"))).otherwise(""),
        F.lit("<downloads>"), F.when(number % 17 == 0, "many").otherwise(F.col("o_custkey").cast("string")),
        F.lit("</downloads><infoHash>"), F.when(number % 11 != 0, F.upper("_hash")).otherwise(""),
        F.lit("</infoHash><size>1.5 GiB</size><trusted>"), F.when(number % 5 == 0, "Yes").otherwise("No"),
        F.lit("</trusted></item>"),
    )
    return _orders(spark, sf_dir).select(xml.alias("item"))


def _feed_rows(spark, sf_dir):
    return feed.feed_rows(feed.parse_items(_feed_items(spark, sf_dir), "item"), _FEED_NOW)


def _scratch(spark):
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


FILE_LINES = 30_000


def _write_files(lines, folder, least, head, tail=None, times=1):
    """Write the lines as so many files at least, and as many as there are lines for, each with its head and tail; all
    of them as many times as asked for. A file is rows until it is written, so none is in memory as a whole."""
    (column,) = lines.columns
    count = max(least, -(-lines.count() // FILE_LINES))
    page = F.pmod(F.xxhash64(column), F.lit(count))
    ends = [F.struct(F.lit(i).alias("place"), F.lit(t).alias("value")) for i, t in ((0, head), (2, tail)) if t is not None]
    pages = lines.sparkSession.range(count).select(F.col("id").alias("page"), F.inline(F.array(*ends)))
    rows = lines.select(page.alias("page"), F.lit(1).alias("place"), F.col(column).alias("value")).unionByName(pages)
    # What is written more than once is shuffled once.
    dealt = rows.repartition("page").withColumn("again", F.explode(F.array(*[F.lit(i) for i in range(times)])))
    dealt = dealt.sortWithinPartitions("again", "page", "place")
    dealt.select("again", "page", "value").write.partitionBy("again", "page").text(folder)
    return count * times


FED = f"""
  SELECT {_HASH} AS infohash, concat('[G] Order & Co ', o_orderkey, ' - 05 [720p].mkv') AS filename,
         CASE WHEN o_orderkey % 13 = 0 THEN 946684800000000 ELSE epoch_us(o_orderdate) END AS published,
         CAST(1610612736 AS BIGINT) AS size_bytes, o_orderkey AS source_id, o_orderkey % 5 = 0 AS trusted, false AS remake,
         CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 90 END AS seeders, CAST(0 AS BIGINT) AS leechers, o_custkey AS downloads
  FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0"""


@registry.add(FED)
def feed_rows(spark, sf_dir):
    """Items without hash or with unreadable counts are left out; unreadable
    dates become the time of reading."""
    return _feed_rows(spark, sf_dir).select(
        "infohash", "filename", v.micros("pubdate").alias("published"), "size_bytes", "source_id", "trusted",
        "remake", "seeders", "leechers", "downloads",
    )


@registry.add(FED)
def feed_files(spark, sf_dir):
    """The same items as XML documents in a folder."""
    folder = _scratch(spark)
    _write_files(_feed_items(spark, sf_dir), folder, 7, "<rss><channel><title>feed</title>", "</channel></rss>")
    return feed.read_feed(spark, folder, _FEED_NOW).select(
        "infohash", "filename", v.micros("pubdate").alias("published"), "size_bytes", "source_id", "trusted",
        "remake", "seeders", "leechers", "downloads",
    )


@registry.add(FED.replace("946684800000000", "NULL"))
def stream_feed(spark, sf_dir):
    """The documents arrive in three batches and are listed twice; each item is stored once."""
    folder, root = _scratch(spark), _scratch(spark)
    files = _write_files(_feed_items(spark, sf_dir), folder, 4, "<rss>", "</rss>", times=2)
    rows = feed.stream_feed(spark, f"{folder}/again=*/page=*", files=-(-files // 3), named=False)
    query = jobs.first_rows(rows, f"{root}/rows", f"{root}/state", ["infohash"], ["filename"], finish=feed.with_names)
    query.awaitTermination()
    published = F.when(F.col("source_id") % 13 != 0, v.micros("pubdate"))
    return spark.read.parquet(f"{root}/rows").select(
        "infohash", "filename", published.alias("published"), "size_bytes", "source_id", "trusted",
        "remake", "seeders", "leechers", "downloads",
    )


@registry.add(f"""WITH fed AS ({FED})
SELECT infohash, source_id, CASE WHEN source_id % 3 = 0 THEN 'dead' ELSE 'active' END AS status, 1 AS readings FROM fed""")
def ingest_feed(spark, sf_dir):
    """The feed on top of a store that has every third order already, as dead."""
    rows = cut(_feed_rows(spark, sf_dir))
    known = rows.filter(F.col("source_id") % 3 == 0)
    stored, stats = feed_to_tables(known)
    torrents, readings = collector.ingest(stored.withColumn("status", F.lit("dead")), stats, rows)
    counts = readings.groupBy("infohash").agg(F.count(F.lit(1)).cast("int").alias("readings"))
    return torrents.join(counts, "infohash").select("infohash", "source_id", "status", "readings")


@registry.add("""SELECT l_orderkey, l_linenumber, l_partkey, concat('Show ', l_partkey % 50, ' Part') AS title,
  CASE WHEN l_linenumber % 4 = 1 THEN l_partkey % 6 + 1 ELSE NULL END AS season,
  CASE WHEN l_linenumber % 4 = 2 THEN NULL ELSE l_suppkey % 100 + 1 END AS episode,
  CASE WHEN l_linenumber % 4 = 2 THEN 12 END AS batch_size,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE 'Grp' END AS release_group,
  CASE WHEN l_linenumber % 4 = 0 THEN '1080p' WHEN l_linenumber % 4 = 1 THEN '720p' END AS screen_size, 'mkv' AS container
FROM lineitem""")
def parsed_names(spark, sf_dir):
    """Four ways to write a release name."""
    title = F.concat(F.lit("Show "), (F.col("l_partkey") % 50).cast("string"), F.lit(" Part"))
    episode = F.lpad((F.col("l_suppkey") % 100 + 1).cast("string"), 3, "0")
    season = F.lpad((F.col("l_partkey") % 6 + 1).cast("string"), 2, "0")
    kind = F.col("l_linenumber") % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("[Grp] "), title, F.lit(" - "), episode, F.lit(" [1080p].mkv")))
        .when(kind == 1, F.concat(F.lit("[Grp] "), title, F.lit(" S"), season, F.lit("E"), episode, F.lit(" (720p) [ABCD].mkv")))
        .when(kind == 2, F.concat(F.lit("[Grp] "), title, F.lit(" 01-12 [Batch].mkv")))
        .otherwise(F.concat(F.replace(title, F.lit(" "), F.lit("_")), F.lit("_-_"), episode, F.lit("v2.mkv")))
    )
    rows = v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", name.alias("name")
    )
    rows = filenames.with_parsed(rows, "name")
    size = F.when(F.col("p.episodes").isNotNull(), F.size("p.episodes"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "p.title", F.col("p.season").cast("bigint").alias("season"),
        F.col("p.episode").cast("bigint").alias("episode"), size.alias("batch_size"), "p.release_group",
        "p.screen_size", "p.container",
    )


@registry.add("""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) = '' AS untitled,
  len(regexp_extract_all(html, '(?s)<a\\b[^>]*>.*?</a>')) AS links,
  len(regexp_extract_all(html, '(?s)<a\\b[^>]*href="[^"]*/view/[0-9]+[^"]*"[^>]*>.*?</a>')) AS view_links FROM pages""")
def page_links(spark, sf_dir):
    """Links of whole pages, and those that lead to an item."""
    html = F.col("html")
    return v.table(spark, sf_dir, "pages").select(
        "page_id",
        (F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1) == "").alias("untitled"),
        F.size(listing.links(html)).cast("bigint").alias("links"),
        F.size(listing.view_links(html)).cast("bigint").alias("view_links"),
    )


_HEADERS = ("放送日時", "lvID", "種別", "シーズン", "タイトル", "話", "1", "2", "3", "4", "5", "エピソード種別", "備考")
_SURVEY_SQL = """
  SELECT l_orderkey, concat('番組 ', l_partkey % 50, ', 第') AS title, l_linenumber * 10 + 1 AS episode,
         concat(2020 + l_partkey % 6, CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END) AS season_code,
         l_quantity AS very_good_pct, CASE WHEN l_partkey % 9 <> 0 THEN l_discount * 100 END AS good_pct
  FROM lineitem WHERE l_partkey % 7 <> 0 AND l_partkey % 8 <> 0 AND l_partkey % 10 <> 0"""


def _survey_lines(spark, sf_dir):
    part = F.col("l_partkey")

    def text(column):
        return column.cast("string")

    code = F.concat(text(part % 6 + 2020), F.substring(F.lit("ABCD"), F.col("l_suppkey") % 4 + 1, F.lit(1)))
    title = F.when(part % 10 == 0, " ").otherwise(F.concat(F.lit('"番組 '), text(part % 50), F.lit(', 第"')))
    episode = F.when(part % 8 == 0, "SP").otherwise(text(F.col("l_linenumber") * 10 + 1))
    line = F.concat_ws(
        ",", F.date_format("l_shipdate", "yyyy/MM/dd HH:mm"), text(F.col("l_orderkey")),
        F.when(part % 7 == 0, "一挙").otherwise("通常"), code, title, episode, text(F.col("l_quantity")),
        F.when(part % 9 == 0, "n/a").otherwise(text(F.col("l_discount") * 100)), F.lit(""), F.lit("1.5"), F.lit("2"),
        F.lit("本編"), F.lit(""),
    )
    return v.table(spark, sf_dir, "lineitem").select(line.alias("line"))


def _survey_rows(spark, sf_dir):
    columns = ", ".join(f"`{h}` string" for h in _HEADERS)
    raw = _survey_lines(spark, sf_dir).select(F.inline(F.array(F.from_csv("line", columns))))
    return surveys.survey_rows(raw)


@registry.add(f"""WITH s AS ({_SURVEY_SQL})
SELECT title, CAST(episode AS BIGINT) AS episode, season_code, very_good_pct, good_pct, count(*) AS rows FROM s GROUP BY ALL""")
def survey_rows(spark, sf_dir):
    """Regular broadcasts with a number and a title; unreadable shares are null."""
    keys = ("title", "episode", "season_code", "very_good_pct", "good_pct")
    return _survey_rows(spark, sf_dir).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


@registry.add(f"""WITH s AS ({_SURVEY_SQL})
SELECT title, CAST(episode AS BIGINT) AS episode, season_code, very_good_pct, good_pct, count(*) AS rows FROM s GROUP BY ALL""")
def survey_files(spark, sf_dir):
    """The same lines as CSV files with a header in a folder."""
    folder = _scratch(spark)
    _write_files(_survey_lines(spark, sf_dir), folder, 3, ",".join(_HEADERS))
    keys = ("title", "episode", "season_code", "very_good_pct", "good_pct")
    return surveys.read_surveys(spark, f"{folder}/again=*/page=*").groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


@registry.add(f"""WITH s AS ({_SURVEY_SQL})
SELECT season_code, count(*) AS rows FROM s WHERE season_code IN ('2025D') GROUP BY ALL""")
def surveys_of_seasons(spark, sf_dir):
    rows = surveys.of_seasons(_survey_rows(spark, sf_dir), rules.seasons(spark))
    return rows.groupBy("season_code").agg(F.count(F.lit(1)).alias("rows"))


CATALOGUE = """
media AS (
  SELECT p_partkey AS anilist_id, p_name AS title_romaji, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE upper(p_name) END AS title_english,
         CASE WHEN p_partkey % 4 <> 0 THEN 1990 + p_size % 10 END AS start_year, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size % 3 END AS episodes,
         CASE p_partkey % 6 WHEN 0 THEN 'NOT_YET_RELEASED' WHEN 1 THEN 'RELEASING' ELSE 'FINISHED' END AS status,
         CASE p_partkey % 7 WHEN 0 THEN 'TV' WHEN 1 THEN 'ONA' ELSE 'MOVIE' END AS format, p_partkey * 2 AS mal_id
  FROM part)"""


def _media(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    json = F.to_json(
        F.struct(
            key.alias("id"),
            (key * 2).alias("idMal"),
            F.struct(F.col("p_name").alias("romaji"), F.when(key % 3 != 0, F.upper("p_name")).alias("english")).alias("title"),
            F.array("p_brand").alias("synonyms"),
            F.when(key % 5 != 0, size % 3).alias("episodes"),
            F.when(key % 6 == 0, "NOT_YET_RELEASED").when(key % 6 == 1, "RELEASING").otherwise("FINISHED").alias("status"),
            F.when(key % 7 == 0, "TV").when(key % 7 == 1, "ONA").otherwise("MOVIE").alias("format"),
            F.struct(
                F.array(F.struct(F.lit(1).alias("episode"), key.alias("airingAt"))).alias("nodes")
            ).alias("airingSchedule"),
            F.struct(F.when(key % 4 != 0, size % 10 + 1990).alias("year"), F.lit(6).alias("month")).alias("startDate"),
        )
    )
    raw = v.table(spark, sf_dir, "part").select(F.inline(F.array(F.from_json(json, MEDIA))))
    return catalogue.media_rows(raw)


@registry.add(f"""WITH {CATALOGUE}
SELECT anilist_id, title_romaji, title_english, start_year, episodes, status, format, mal_id, anilist_id AS airing_at,
       1 AS scheduled, NULL::VARCHAR AS cover_image_url FROM media""")
def catalogue_rows(spark, sf_dir):
    return _media(spark, sf_dir).select(
        "anilist_id", "title_romaji", "title_english", F.col("start_date.year").alias("start_year"), "episodes",
        "status", "format", "mal_id", F.get("airing_schedule", F.lit(0))["airing_at"].alias("airing_at"),
        F.size("airing_schedule").alias("scheduled"), "cover_image_url",
    )


@registry.add(f"""WITH {CATALOGUE}
SELECT anilist_id FROM media WHERE format IN ('MOVIE', 'ONA', 'SPECIAL') AND start_year * 10000 + 600 > 19920101 AND start_year * 10000 + 600 < 19970601""")
def movie_query(spark, sf_dir):
    rows = catalogue.in_movie_query(_media(spark, sf_dir), date(1992, 1, 1), date(1997, 6, 1))
    return rows.select("anilist_id")


@registry.add(f"""WITH {CATALOGUE},
kept AS (SELECT anilist_id FROM media WHERE (episodes IS NULL OR episodes <= 1) AND status IN ('FINISHED', 'RELEASING')
         AND anilist_id NOT IN (3, 5, 8))
SELECT anilist_id, false AS added FROM kept
UNION ALL SELECT anilist_id, true FROM media WHERE anilist_id IN (7, 8, 9, 10) AND anilist_id NOT IN (SELECT anilist_id FROM kept)""")
def movie_catalogue(spark, sf_dir):
    """All entries as the movie and as the TV catalogue: override targets that
    the movie filters drop come back from the latter."""
    media = catalogue.with_order(_media(spark, sf_dir))
    overrides = rules.overrides(spark, {"a": 7, "b": 8, "c": 9, "d": 10, "e": 10**12})
    movies = catalogue.movie_shows(media, rules.ids(spark, (3, 5, 8)), overrides, media)
    return movies.select("anilist_id", F.col("show_seq.last").alias("added"))


@registry.add(f"""WITH {CATALOGUE}
SELECT season, count(*) AS members, (SELECT count(*) FROM media) AS shows
FROM (SELECT 'Year' AS season FROM media UNION ALL SELECT 'Movies' FROM media WHERE format = 'MOVIE') GROUP BY ALL""")
def season_catalogues(spark, sf_dir):
    """Two overlapping season catalogues as one."""
    media = catalogue.with_order(_media(spark, sf_dir))
    parts = {"Movies": media.filter(F.col("format") == "MOVIE"), "Year": media}
    shows, members = catalogue.season_catalogues(parts)
    sizes = members.groupBy("season").agg(F.count(F.lit(1)).alias("members"))
    total = shows.agg(F.count(F.lit(1)).alias("shows"))
    tagged = total.select("shows", F.explode(F.array(F.lit("Movies"), F.lit("Year"))).alias("season"))
    return sizes.join(tagged, "season").select("season", "members", "shows")


@registry.add("""SELECT p_partkey AS anilist_id, p_retailprice AS score, p_size AS rank FROM part WHERE p_partkey % 4 <> 0""")
def rating_rows(spark, sf_dir):
    """Rating responses; every fourth one has no data."""
    key = F.col("p_partkey")
    body = F.when(
        key % 4 != 0,
        F.to_json(F.struct(F.struct(F.col("p_retailprice").alias("score"), F.col("p_size").alias("rank"),
                                    F.col("p_name").alias("other")).alias("data"))),
    ).otherwise('{"status": 404}')
    raw = v.table(spark, sf_dir, "part").select(
        key.alias("anilist_id"), key.alias("mal_id"), body.alias("body"), F.lit("2024-01-01T00:00:00Z").alias("fetched_at")
    )
    return catalogue.rating_rows(raw).select("anilist_id", "payload.score", "payload.rank")


@registry.add("""SELECT p_partkey AS anilist_id, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice ELSE 1.5 END AS score,
  p_partkey % 4 <> 0 AS renewed FROM part WHERE p_partkey % 4 <> 0 OR p_partkey % 3 = 0""")
def rating_update(spark, sf_dir):
    """Every third show has a stored rating; responses without data leave it."""
    key = F.col("p_partkey")
    part = v.table(spark, sf_dir, "part")
    old = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    stored = part.filter(key % 3 == 0).select(
        F.lit("mal").alias("source"), key.alias("anilist_id"), key.alias("mal_id"),
        F.from_json(F.to_json(F.struct(F.lit(1.5).alias("score"))), RATING_PAYLOAD).alias("payload"), old.alias("fetched_at"),
    )
    body = F.when(
        key % 4 != 0, F.to_json(F.struct(F.struct(F.col("p_retailprice").alias("score")).alias("data")))
    ).otherwise("{}")
    responses = part.select(
        key.alias("anilist_id"), key.alias("mal_id"), body.alias("body"), F.lit("2024-02-01T00:00:00Z").alias("fetched_at")
    )
    table = reception.update_ratings(stored, responses)
    return table.select("anilist_id", "payload.score", (F.col("fetched_at") > old).alias("renewed"))


@registry.add("""SELECT o_orderkey AS anilist_id FROM orders WHERE o_orderkey % 3 <> 0
  AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR epoch(TIMESTAMP '1998-12-01') - epoch(o_orderdate) >= 90 * 86400)""")
def stale_ratings(spark, sf_dir):
    """Shows to fetch again: no rating, an unreadable time, or too old."""
    key = F.col("o_orderkey")
    orders = v.table(spark, sf_dir, "orders")
    shows = orders.select(key.alias("anilist_id"), F.when(key % 3 != 0, key).alias("mal_id"))
    fetched = F.when(key % 7 == 0, "yesterday").otherwise(F.date_format(utc("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    ratings = orders.filter(key % 5 != 0).select(
        F.lit("mal").alias("source"), key.alias("anilist_id"), fetched.alias("fetched_at")
    )
    return catalogue.stale_shows(shows, ratings, v.NOW, ttl_days=90).select("anilist_id")
