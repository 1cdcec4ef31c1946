"""Streaming jobs over the readings, in micro-batches, against the batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulse.queries import registry
from pulse.queries import views as v
from pulse.session import ensure_checkpoint_dir
from pulse.streaming import jobs

PARTS = 4
FILES = 8
FILE_ROWS = 500_000


def _bounds(rows):
    return rows.select(F.unix_micros("timestamp").alias("t")).approxQuantile("t", [i / PARTS for i in range(1, PARTS)], 0.01)


def _source(spark, rows, root, order=range(PARTS), clock=False):
    """The rows as files that arrive part by part, each part a stretch of time and a micro-batch. With a clock they have
    the time of arrival: the end of the newest part that has arrived."""
    folder = f"{root}/source"
    cuts = _bounds(rows)
    part = sum([(F.unix_micros("timestamp") >= c).cast("int") for c in cuts], F.lit(0))
    last = rows.agg(F.max(F.unix_micros("timestamp"))).first()[0] if clock else None
    for n, i in enumerate(order):
        here = rows.filter(part == i)
        if clock:
            end = max([*cuts, last][k] for k in list(order)[: n + 1])
            here = here.withColumn("arrived", F.timestamp_micros(F.lit(int(end))))
        here.repartition(FILES).write.parquet(f"{folder}/at={n}")
    schema = rows.withColumn("arrived", F.current_timestamp()).schema if clock else rows.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES)
    return stream.parquet(f"{folder}/at=*")


def _root(spark):
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


@registry.add(f"""WITH {v.DELTAS}
SELECT infohash, epoch_us(ts) AS at, CAST(delta AS BIGINT) AS downloads_delta FROM deltas""")
def stream_counter_deltas(spark, sf_dir):
    """Time stretches arrive out of order; only what the stream emitted is read."""
    root = _root(spark)
    rows = v.readings(spark, sf_dir).select("infohash", "timestamp", "downloads")
    jobs.incremental_deltas(_source(spark, rows, root, (2, 0, 3, 1)), root, f"{root}/state")
    deltas = jobs.emitted_deltas(spark, root)
    return deltas.select("infohash", v.micros("timestamp").alias("at"), "downloads_delta")


@registry.add(f"""WITH {v.READINGS}
SELECT {v.week_sql('ts')} AS week, anilist_id, CAST(sum(downloads) AS BIGINT) AS downloads FROM readings GROUP BY ALL""")
def stream_weekly_totals(spark, sf_dir):
    """Two of the parts arrive after the weeks they fall into are closed."""
    root = _root(spark)
    rows = v.readings(spark, sf_dir).select("timestamp", "anilist_id", F.col("downloads").alias("downloads_delta"))
    stream = _source(spark, rows, root, (1, 0, 3, 2), clock=True)
    jobs.weekly_totals(stream, f"{root}/totals", f"{root}/state", "arrived", "9 days")
    return jobs.current_totals(spark, f"{root}/totals", f"{root}/state")


@registry.add(f"WITH {v.READINGS} SELECT infohash, anilist_id, episode, epoch_us(min(ts)) AS at FROM readings GROUP BY ALL")
def stream_first_rows(spark, sf_dir):
    root = _root(spark)
    rows = v.readings(spark, sf_dir).select("infohash", "anilist_id", "episode", "timestamp")
    stream = _source(spark, rows, root, clock=True)
    query = jobs.first_rows(stream.drop("arrived_"), f"{root}/torrents", f"{root}/state", ["infohash"], ["timestamp"], "arrived")
    query.awaitTermination()
    stored = spark.read.parquet(f"{root}/torrents")
    return stored.select("infohash", "anilist_id", "episode", v.micros("timestamp").alias("at"))


@registry.add(f"""WITH {v.COUNTERS},
recent AS (SELECT *, row_number() OVER (PARTITION BY infohash ORDER BY ts DESC) AS n FROM counters)
SELECT infohash, epoch_us(ts) AS at, seeders, leechers, downloads FROM recent WHERE n <= 3""")
def stream_recent_readings(spark, sf_dir):
    """What the dead detection keeps: each key's three newest readings."""
    root = _dead(spark, sf_dir)
    kept = jobs.recent_readings(spark, f"{root}/state")
    return kept.select("infohash", v.micros("timestamp").alias("at"), "seeders", "leechers", "downloads")


@registry.add(f"""WITH {v.COUNTERS},
recent AS (SELECT *, row_number() OVER (PARTITION BY infohash ORDER BY ts DESC) AS n FROM counters)
SELECT infohash FROM recent WHERE n <= 3 GROUP BY infohash
HAVING count(*) = 3 AND sum(abs(seeders) + abs(leechers) + abs(downloads)) = 0""")
def stream_dead(spark, sf_dir):
    root = _dead(spark, sf_dir)
    return jobs.dead_now(spark, f"{root}/dead")


@registry.add(f"WITH {v.ITEMS} SELECT infohash FROM scheduled WHERE status = 'active' AND is_due")
def stream_due_items(spark, sf_dir):
    """Items and readings in the order of their times, and a tick at the end: what is due then. Items of a later date are
    known at the end."""
    root = _root(spark)
    known = F.least("pubdate", F.lit(v.NOW).cast("timestamp"))
    items = v.items(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("timestamp")).withColumn("arrived", known)
    stats = v.item_stats(spark, sf_dir).select("infohash", "timestamp", F.col("timestamp").alias("arrived"))
    tick = spark.range(1).select(F.lit(v.NOW).cast("timestamp").alias("arrived"))
    events = items.unionByName(stats, allowMissingColumns=True)
    counters = [F.when(F.col("timestamp").isNotNull(), 1).cast(t).alias(c) for c, t in (("seeders", "int"), ("leechers", "int"), ("downloads", "bigint"))]
    events = events.unionByName(tick, allowMissingColumns=True).select("*", *counters)
    arrived = F.unix_micros("arrived")
    bounds, rows = events.agg(F.percentile_approx(arrived, [i / PARTS for i in range(1, PARTS)], 100), F.count(F.lit(1))).first()
    files = max(FILES, -(-rows // (PARTS * FILE_ROWS)))
    part = sum([(arrived >= c).cast("int") for c in bounds], F.lit(0))
    for i in range(PARTS):
        events.filter(part == i).repartition(files).write.parquet(f"{root}/source/at={i}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/source/at=*")
    jobs.due_changes(stream, f"{root}/due", f"{root}/state").awaitTermination()
    return jobs.due_now(spark, f"{root}/due")


def _dead(spark, sf_dir):
    root = _root(spark)
    stream = _source(spark, v.counters(spark, sf_dir), root, (1, 0, 2, 3))
    jobs.dead_detection(stream, f"{root}/dead", f"{root}/state").awaitTermination()
    return root
