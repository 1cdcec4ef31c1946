"""Scheduling and keyed writes. See ``views`` for what stands for an item."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulse.functions.times import utc
from pulse.operators import schedule, store
from pulse.plans import collector, reports
from pulse.queries import registry
from pulse.queries import views as v
from pulse.session import cut, ensure_checkpoint_dir, literal_rows
from pulse.sources.tables import usable_torrents


def _items(spark, sf_dir):
    return v.items(spark, sf_dir), v.item_stats(spark, sf_dir)


@registry.add(f"""WITH {v.ITEMS}
SELECT infohash, epoch_us(last_scrape) AS last_at FROM scheduled WHERE status = 'active' AND is_due""")
def due_items(spark, sf_dir):
    due = schedule.in_scrape_order(schedule.due_items(*_items(spark, sf_dir), v.NOW))
    return due.select("infohash", v.micros("last_scrape").alias("last_at"))


_SOON = v.ITEMS.replace("THEN gap >=", "THEN gap + 3600 * 24 >=")


@registry.add(f"""WITH {_SOON} SELECT infohash FROM scheduled WHERE status = 'active' AND is_due""")
def due_within_a_day(spark, sf_dir):
    return schedule.due_items(*_items(spark, sf_dir), v.NOW, 24 * 60).select("infohash")


@registry.add(f"""WITH {v.ITEMS}
SELECT infohash, status, age / 86400.0 AS age_days, schedule_type, is_due FROM scheduled""")
def item_schedule(spark, sf_dir):
    rows = schedule.schedule_of(*_items(spark, sf_dir), v.NOW)
    return rows.select("infohash", "status", "age_days", "schedule_type", "is_due")


@registry.add(f"""WITH {v.ITEMS}
SELECT CASE WHEN status <> 'active' THEN status ELSE schedule_type END AS schedule_type, count(*) AS items
FROM scheduled GROUP BY ALL""")
def schedule_summary(spark, sf_dir):
    return schedule.schedule_summary(*_items(spark, sf_dir), v.NOW)


@registry.add(f"""WITH {v.ITEMS},
t AS (SELECT count(*) AS torrents_total, count(*) FILTER (status = 'active') AS torrents_active,
             count(*) FILTER (status = 'dead') AS torrents_dead, count(*) FILTER (status = 'guessit_failed') AS torrents_guessit_failed,
             count(*) FILTER (status = 'active' AND is_due) AS queue_depth FROM scheduled),
s AS (SELECT count(*) AS stats_total, count(*) FILTER (epoch(TIMESTAMP '1998-12-01') - epoch(ts) <= 86400) AS stats_recent FROM item_stats)
SELECT * FROM t, s""")
def system_metrics(spark, sf_dir):
    return schedule.system_metrics(*_items(spark, sf_dir), v.NOW)


@registry.add("""SELECT epoch_us(max(o_orderdate)) AS last_at, epoch_us(max(o_orderdate) + INTERVAL 6 HOUR) AS next_at,
       epoch(TIMESTAMP '1998-12-01') - epoch(max(o_orderdate)) >= 21600 AS should_fetch FROM orders""")
def feed_status(spark, sf_dir):
    row = schedule.feed_status(v.items(spark, sf_dir), v.NOW, 6)
    return row.select(
        v.micros("last_feed").alias("last_at"), v.micros("next_feed").alias("next_at"), "should_fetch"
    )


BATCHES = v.ITEMS + """,
batched AS (
  SELECT infohash, row_number() OVER (ORDER BY last_scrape NULLS FIRST, infohash) AS position,
         (row_number() OVER (ORDER BY last_scrape NULLS FIRST, infohash) - 1) // 20 + 1 AS batch
  FROM scheduled WHERE status = 'active' AND is_due)"""


@registry.add(f"WITH {BATCHES} SELECT infohash, position, batch FROM batched")
def scrape_batches(spark, sf_dir):
    return collector.plan_scrape(*_items(spark, sf_dir), v.NOW)


@registry.add(f"""WITH {BATCHES}
SELECT infohash, batch, CASE WHEN CAST(infohash AS BIGINT) % 3 = 0 THEN 0 ELSE 1 END AS seeders,
       0 AS leechers, CASE WHEN CAST(infohash AS BIGINT) % 3 = 0 THEN 0 ELSE CAST(infohash AS BIGINT) END AS downloads
FROM batched WHERE batch % 5 <> 0 AND length(infohash) % 2 = 0""")
def zero_filled_results(spark, sf_dir):
    """Every third key is missing from the result, every fifth batch failed;
    keys of odd length are no valid hashes."""
    requested = cut(collector.plan_scrape(*_items(spark, sf_dir), v.NOW))
    number = F.col("infohash").cast("bigint")
    results = requested.filter(number % 3 != 0).select(
        "infohash", F.lit(1).alias("seeders"), F.lit(0).alias("leechers"), number.alias("downloads")
    )
    succeeded = requested.filter(F.col("batch") % 5 != 0).select("batch")
    return schedule.fill_missing(requested, results, succeeded)


DEAD = v.COUNTERS + """,
recent AS (SELECT *, row_number() OVER (PARTITION BY infohash ORDER BY ts DESC) AS n FROM counters),
dead AS (
  SELECT infohash FROM recent WHERE n <= 3 GROUP BY infohash
  HAVING count(*) = 3 AND sum(seeders + leechers + downloads) = 0)"""


@registry.add(f"WITH {DEAD} SELECT infohash FROM dead")
def dead_torrents(spark, sf_dir):
    return schedule.dead_keys(v.counters(spark, sf_dir))


@registry.add(f"WITH {DEAD} SELECT infohash, epoch_us(ts) AS at, downloads, n AS recency FROM recent WHERE n <= 5")
def latest_five_readings(spark, sf_dir):
    rows = store.latest_per_key(v.counters(spark, sf_dir), ["infohash"], [F.col("timestamp")], 5)
    return rows.select(
        "infohash", v.micros("timestamp").alias("at"), "downloads", F.col("recency").cast("bigint").alias("recency")
    )


@registry.add(f"""WITH {DEAD}
SELECT infohash, CASE WHEN infohash IN (SELECT infohash FROM dead) AND infohash IN (SELECT infohash FROM counters WHERE ts >= TIMESTAMP '2024-01-25')
                      THEN 'dead' ELSE 'active' END AS status, count(*) AS readings
FROM counters GROUP BY ALL""")
def collection_step(spark, sf_dir):
    """Readings from 25 January arrive as one batch on top of the stored ones."""
    rows = v.counters(spark, sf_dir)
    recent = F.col("timestamp") >= F.lit("2024-01-25").cast("timestamp")
    torrents = rows.select("infohash").distinct().withColumn("status", F.lit("active"))
    marked, stored = schedule.collect(torrents, rows.filter(~recent), rows.filter(recent))
    counts = stored.groupBy("infohash").agg(F.count(F.lit(1)).alias("readings"))
    return marked.join(counts, "infohash").select("infohash", "status", "readings")


@registry.add(f"""WITH {DEAD}
SELECT infohash, CASE WHEN infohash IN (SELECT infohash FROM dead) AND infohash IN (SELECT infohash FROM counters WHERE ts >= TIMESTAMP '2024-01-25')
                      THEN 'dead' ELSE 'active' END AS status, count(*) AS readings
FROM counters GROUP BY ALL""")
def collection_in_place(spark, sf_dir):
    """The same step on stored tables, of which only the touched partitions are rewritten."""
    root = f"{ensure_checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"
    rows = v.counters(spark, sf_dir)
    recent = F.col("timestamp") >= F.lit("2024-01-25").cast("timestamp")
    fields = {"filename": F.lit("x"), "pubdate": F.lit("2024-01-01").cast("timestamp"), "size_bytes": F.lit(1).cast("bigint"),
              "source_id": F.lit(None).cast("bigint"), "trusted": F.lit(True), "remake": F.lit(False),
              "status": F.lit("active"), "guessit_data": F.lit(None).cast("string")}
    torrents = rows.select("infohash").distinct().withColumns(fields)
    columns = ["infohash", "timestamp", "seeders", "leechers", "downloads"]
    counters = rows.select(*columns[:2], *[F.col(c).cast(t).alias(c) for c, t in zip(columns[2:], ("int", "int", "bigint"), strict=True)])
    collector.create(root, torrents, counters.filter(~recent))
    collector.store_readings(root, counters.filter(recent))
    counts = collector.stored_stats(spark, root).groupBy("infohash").agg(F.count(F.lit(1)).alias("readings"))
    return collector.stored_torrents(spark, root).join(counts, "infohash").select("infohash", "status", "readings")


# Line items by (order, line): the key repeats. What was shipped before 1995 is
# stored already, everything arrives again.
UPSERTS = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS first_n,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS last_n
  FROM lineitem)"""
_KEY = ["l_orderkey", "l_linenumber"]
_FIELDS = [*_KEY, "l_partkey", "l_suppkey", "l_quantity"]


def _lines(spark, sf_dir):
    return v.table(spark, sf_dir, "lineitem").select(*_FIELDS, utc("l_shipdate").alias("l_shipdate"))


def _stored():
    return F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp")


def _seq():
    return [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")]


@registry.add(f"""WITH {UPSERTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lines WHERE first_n = 1 AND l_shipdate >= TIMESTAMP '1995-01-01'""")
def insert_if_absent(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    stored = rows.filter(_stored())
    return store.insert_if_absent(stored, rows, _KEY, _seq()).select(*_FIELDS)


@registry.add(f"""WITH {UPSERTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lines WHERE last_n = 1""")
def upsert(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    stored = store.first_per_key(rows.filter(_stored()), _KEY, _seq())
    return store.upsert(stored, rows, _KEY, _seq()).select(*_FIELDS)


@registry.add(f"""WITH {UPSERTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lines WHERE first_n = 1""")
def earliest_row_per_key(spark, sf_dir):
    return store.first_per_key(_lines(spark, sf_dir), _KEY, _seq()).select(*_FIELDS)


@registry.add("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-12-01')""")
def skip_existing(spark, sf_dir):
    known = v.item_stats(spark, sf_dir).select(F.col("infohash").cast("bigint").alias("o_orderkey")).distinct()
    rows = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return store.skip_existing(rows, known, ["o_orderkey"])


@registry.add(f"""WITH {v.ITEMS}
SELECT infohash, CASE WHEN infohash IN (SELECT infohash FROM item_stats) THEN status ELSE 'guessit_failed' END AS status FROM items""")
def mark_status(spark, sf_dir):
    items, stats = _items(spark, sf_dir)
    unread = store.skip_existing(items, stats.distinct(), ["infohash"])
    return store.mark_status(items, unread, "guessit_failed").select("infohash", "status")


@registry.add(f"""WITH {v.NAMED_TORRENTS},
read AS (SELECT infohash, max(downloads) AS max_downloads, count(*) AS stat_count FROM readings GROUP BY infohash),
top AS (
  SELECT infohash, filename, user_id, number, max_downloads, stat_count, guessit_data
  FROM named JOIN read USING (infohash) WHERE guessit_data IS NOT NULL ORDER BY max_downloads DESC, infohash LIMIT 100),
named_top AS (
  SELECT *, CASE WHEN guessit_data <> 'not json' THEN json_extract_string(guessit_data, '$.title') END AS guessit_title FROM top)
SELECT infohash, filename, guessit_title,
       CASE WHEN guessit_data <> 'not json' AND user_id % 5 = 1 THEN CAST(2 AS BIGINT) END AS season,
       CASE WHEN guessit_data <> 'not json' AND user_id % 7 IN (4, 5, 6) THEN number END AS episode, max_downloads, stat_count
FROM named_top WHERE guessit_title IS NULL OR lower(guessit_title) NOT IN ('show 1', 'show 2', 'show 3')""")
def unmatched_report(spark, sf_dir):
    """Top 100 of all torrents, then without ignored titles."""
    named = v.named_torrents(spark, sf_dir).filter(F.col("guessit_data").isNotNull())
    ignored = literal_rows(spark, [("show 1",), ("show 2",), ("show 3",)], "normalized string")
    return reports.unmatched_report(named.select("infohash"), named, v.readings(spark, sf_dir), ignored)


@registry.add(f"""WITH {v.NAMED_TORRENTS},
kept AS (SELECT * FROM named WHERE (status IS NULL OR status <> 'guessit_failed') AND guessit_data IS NOT NULL)
SELECT anilist_id, infohash, row_number() OVER (PARTITION BY anilist_id ORDER BY pubdate, filename, infohash) - 1 AS pos,
       count(*) OVER (PARTITION BY anilist_id) AS torrent_count,
       CASE WHEN guessit_data = 'not json' THEN NULL ELSE json_extract_string(guessit_data, '$.title') END AS guessit_title,
       guessit_data = 'not json' AS unreadable, CAST(user_id % 50 + 50 AS DOUBLE) AS score
FROM kept""")
def movie_match_report(spark, sf_dir):
    """Torrents per movie in release order; flattened."""
    named = usable_torrents(v.named_torrents(spark, sf_dir))
    matches = named.select(
        "infohash", F.lit("fuzzy").alias("method"), (F.col("user_id") % 50 + 50).cast("double").alias("score"),
        F.lit("x").alias("matched_title"), F.lit(None).cast("bigint").alias("season_matched"),
    )
    nested = reports.movie_match_report(named, matches, v.shows(spark, sf_dir))
    flat = nested.select("anilist_id", "torrent_count", F.posexplode("torrents"))
    return flat.select(
        "anilist_id", "torrent_count", F.col("pos").cast("bigint").alias("pos"), "col.infohash",
        "col.guessit_title",
        F.get_json_object("col.guessit", "$._parse_error").isNotNull().alias("unreadable"),
        "col.match.score",
    )
