"""The domain tables as views of the given ones, in Spark and as SQL text.

readings: an events row is a reading of the counter ``user/type``; a user's shows
are user % 40 and the event type is the episode. Other views are described where
they are built.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.times import utc

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
NOW = datetime(1998, 12, 1)
READ_NOW = datetime(2024, 1, 30, 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    return F.unix_micros(utc(column))


# ---- readings -------------------------------------------------------------

READINGS = """
readings AS (
  SELECT concat(user_id, '/', event_type) AS infohash, ts,
         CAST(round(value * 100) AS BIGINT) AS downloads,
         user_id % 40 AS anilist_id,
         CAST(list_position(['click','error','purchase','signup','view'], event_type) AS BIGINT) AS episode,
         user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

DELTAS = READINGS + """,
deltas AS (
  SELECT *, CASE WHEN downloads > lag(downloads) OVER w THEN downloads - lag(downloads) OVER w ELSE 0 END AS delta
  FROM readings WINDOW w AS (PARTITION BY infohash ORDER BY ts))"""

SERIES = DELTAS + """,
starts AS (SELECT anilist_id, episode, min(ts) AS first_ts FROM readings GROUP BY anilist_id, episode),
aged AS (
  SELECT d.*, first_ts, ((epoch_us(ts) - epoch_us(first_ts)) // 1000000) / 3600.0 AS hours
  FROM deltas d JOIN starts USING (anilist_id, episode)),
buckets AS (
  SELECT anilist_id, episode, first_ts,
         CAST(CASE WHEN hours <= 168 THEN floor(hours) ELSE 168 + floor((hours - 168) / 24) * 24 END AS BIGINT) AS bucket,
         CAST(sum(delta) AS BIGINT) AS daily, min(ts) AS period_start
  FROM aged GROUP BY ALL),
series AS (
  SELECT *, CAST(sum(daily) OVER (PARTITION BY anilist_id, episode ORDER BY bucket) AS BIGINT) AS cumulative,
         bucket / 24.0 AS days
  FROM buckets)"""


def week_sql(ts: str) -> str:
    day = f"CAST({ts} - INTERVAL 5 HOUR AS DATE)"
    return f"strftime({day} - CAST(dayofweek({day}) AS INTEGER), '%Y-%m-%d')"


WEEKLY = SERIES + f""",
weekly AS (
  SELECT {week_sql('period_start')} AS week, anilist_id, CAST(sum(daily) AS BIGINT) AS downloads
  FROM series GROUP BY ALL),
rankings AS (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY downloads DESC, anilist_id) AS rank FROM weekly)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    return table(spark, sf_dir, "events").selectExpr(
        "concat(user_id, '/', event_type) AS infohash",
        "cast(ts AS timestamp) AS timestamp",
        "cast(round(value * 100) AS bigint) AS downloads",
        "user_id % 40 AS anilist_id",
        f"cast(array_position(array({kinds}), event_type) AS bigint) AS episode",
        "user_id",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    )


def torrents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One torrent per counter, published at its first reading."""
    return readings(spark, sf_dir).groupBy("infohash", "anilist_id", "episode", "user_id").agg(
        F.min("timestamp").alias("pubdate")
    )


# Torrents with parsed-name JSON whose episode changes type with the user.
NAMED_TORRENTS = READINGS + """,
named AS (
  SELECT infohash, anilist_id, user_id, episode AS number, min(ts) AS pubdate,
         concat('[Grp] Show ', anilist_id, ' - ', episode, '.mkv') AS filename,
         CASE WHEN user_id % 17 = 0 THEN 'not json'
              WHEN user_id % 13 = 0 THEN NULL
              ELSE concat('{"title":', CASE WHEN user_id % 19 = 0 THEN 'null' ELSE concat('"Show ', anilist_id, '"') END,
                   ',"season":', CASE WHEN user_id % 5 = 0 THEN '[1,2]' WHEN user_id % 5 = 1 THEN '2' ELSE '"2"' END,
                   ',"episode":', CASE WHEN user_id % 7 = 0 THEN concat('[', episode, ',', episode + 1, ']')
                                       WHEN user_id % 7 = 1 THEN concat('"', episode, '"')
                                       WHEN user_id % 7 = 2 THEN concat(episode, '.5')
                                       WHEN user_id % 7 = 3 THEN concat('"', episode, '.5"')
                                       ELSE CAST(episode AS VARCHAR) END, '}') END AS guessit_data,
         CASE WHEN user_id % 23 = 0 THEN 'guessit_failed' WHEN user_id % 3 = 0 THEN NULL ELSE 'active' END AS status
  FROM readings GROUP BY infohash, anilist_id, user_id, episode)"""


def named_torrents(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, number = F.col("user_id"), F.col("episode").cast("string")

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    title = F.when(user % 19 == 0, "null").otherwise(text('"Show ', F.col("anilist_id").cast("string"), '"'))
    season = F.when(user % 5 == 0, "[1,2]").when(user % 5 == 1, "2").otherwise('"2"')
    episode = (
        F.when(user % 7 == 0, text("[", number, ",", (F.col("episode") + 1).cast("string"), "]"))
        .when(user % 7 == 1, text('"', number, '"'))
        .when(user % 7 == 2, text(number, ".5"))
        .when(user % 7 == 3, text('"', number, '.5"'))
        .otherwise(number)
    )
    json = text('{"title":', title, ',"season":', season, ',"episode":', episode, "}")
    return torrents(spark, sf_dir).select(
        "infohash",
        "anilist_id",
        "user_id",
        F.col("episode").alias("number"),
        "pubdate",
        text("[Grp] Show ", F.col("anilist_id").cast("string"), " - ", number, ".mkv").alias("filename"),
        F.when(user % 17 == 0, "not json").when(user % 13 == 0, F.lit(None)).otherwise(json).alias("guessit_data"),
        F.when(user % 23 == 0, "guessit_failed").when(user % 3 == 0, F.lit(None)).otherwise("active").alias("status"),
        (user % 2 == 0).alias("trusted"),
        F.lit(False).alias("remake"),
    )


# ---- catalogue and seasons ------------------------------------------------

# Shows 0..31 of the 40 that readings refer to; every third has no English name.
SHOWS = """
shows AS (
  SELECT DISTINCT user_id % 40 AS anilist_id, concat('Romaji ', user_id % 40) AS title_romaji,
         CASE WHEN (user_id % 40) % 3 = 0 THEN NULL ELSE concat('English ', user_id % 40) END AS title_english
  FROM events WHERE user_id % 40 < 32)"""


def shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("anilist_id").cast("string")
    return (
        readings(spark, sf_dir)
        .filter(F.col("anilist_id") < 32)
        .select("anilist_id")
        .distinct()
        .select(
            "anilist_id",
            F.concat(F.lit("Romaji "), number).alias("title_romaji"),
            F.when(F.col("anilist_id") % 3 != 0, F.concat(F.lit("English "), number)).alias("title_english"),
            F.concat(F.lit("https://img/"), number).alias("cover_image_url"),
            F.lit(None).cast("string").alias("cover_image_color"),
        )
    )


SEASON_ROWS = (
    ("Jan A", "WINTER", 2024, date(2024, 1, 1), date(2024, 1, 14)),
    ("Jan B", "SPRING", 2024, date(2024, 1, 15), date(2024, 1, 31)),
)
SEASONS = """
seasons AS (
  SELECT * FROM (VALUES
    ('Jan A', 'WINTER', 2024, DATE '2024-01-01', DATE '2024-01-14'),
    ('Jan B', 'SPRING', 2024, DATE '2024-01-15', DATE '2024-01-31'))
  t(name, season, year, start_date, end_date)),
members AS (
  SELECT DISTINCT CASE WHEN (user_id % 40) % 2 = 0 THEN 'Jan A' ELSE 'Jan B' END AS season, user_id % 40 AS anilist_id
  FROM events)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even shows belong to the first season, odd ones to the second."""
    return (
        readings(spark, sf_dir)
        .select("anilist_id")
        .distinct()
        .select(F.when(F.col("anilist_id") % 2 == 0, "Jan A").otherwise("Jan B").alias("season"), "anilist_id")
    )


# ---- reception ------------------------------------------------------------

# Customers as shows, nations as seasons; total downloads are their order values,
# scores their balance (every seventh has none) and their number of orders.
RATED = """
rated AS (
  SELECT c_nationkey AS season, c_custkey AS anilist_id,
         CAST(coalesce(total, 0) AS BIGINT) AS total_downloads,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS mal_score,
         coalesce(n, 0) AS average_score,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 100 END AS niconico_very_good_pct
  FROM customer LEFT JOIN (
    SELECT o_custkey, sum(CAST(round(o_totalprice) AS BIGINT)) AS total, count(*) AS n FROM orders GROUP BY o_custkey)
  ON o_custkey = c_custkey)"""


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("_total"), F.count(F.lit(1)).alias("_n"))
    )
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(spent, "c_custkey", "left")
        .select(
            F.col("c_nationkey").alias("season"),
            key.alias("anilist_id"),
            F.coalesce("_total", F.lit(0)).alias("total_downloads"),
            F.when(key % 7 != 0, F.col("c_acctbal")).alias("mal_score"),
            F.coalesce("_n", F.lit(0)).alias("average_score"),
            F.when(key % 3 != 0, key % 100).alias("niconico_very_good_pct"),
        )
    )


# ---- schedule -------------------------------------------------------------

# Orders as items; a line item shipped before "now" is a reading of its order.
ITEMS = """
items AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS infohash, o_orderdate AS pubdate,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'dead' ELSE 'guessit_failed' END AS status
  FROM orders),
item_stats AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS infohash, l_shipdate AS ts FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-12-01'),
scraped AS (
  SELECT items.*, last_scrape, epoch(TIMESTAMP '1998-12-01') - epoch(pubdate) AS age,
         epoch(TIMESTAMP '1998-12-01') - epoch(last_scrape) AS gap
  FROM items LEFT JOIN (SELECT infohash, max(ts) AS last_scrape FROM item_stats GROUP BY infohash) USING (infohash)),
scheduled AS (
  SELECT *, CASE WHEN last_scrape IS NULL THEN 'never_scraped' WHEN age <= 172800 THEN 'hourly'
                 WHEN age <= 604800 THEN 'every_4_hours' WHEN age <= 2592000 THEN 'daily'
                 WHEN age <= 15552000 THEN 'weekly' ELSE 'never' END AS schedule_type,
         CASE WHEN last_scrape IS NULL THEN true WHEN age <= 172800 THEN gap >= 3600
              WHEN age <= 604800 THEN gap >= 14400 WHEN age <= 2592000 THEN gap >= 86400
              WHEN age <= 15552000 THEN gap >= 604800 ELSE false END AS is_due
  FROM scraped)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "dead")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("infohash"),
        utc("o_orderdate").alias("pubdate"),
        status.otherwise("guessit_failed").alias("status"),
    )


def item_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") <= F.lit("1998-12-01").cast("timestamp_ntz"))
        .select(F.col("l_orderkey").cast("string").alias("infohash"), utc("l_shipdate").alias("timestamp"))
    )


# Readings with all three counters, mostly zero.
COUNTERS = READINGS + """,
counters AS (
  SELECT infohash, ts, greatest(k - 60, 0) AS seeders, greatest(k - 80, 0) AS leechers,
         CAST(greatest(k - 70, 0) AS BIGINT) AS downloads
  FROM readings)"""


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return readings(spark, sf_dir).select(
        "infohash",
        "timestamp",
        F.greatest(k - 60, F.lit(0)).alias("seeders"),
        F.greatest(k - 80, F.lit(0)).alias("leechers"),
        F.greatest(k - 70, F.lit(0)).cast("bigint").alias("downloads"),
    )
