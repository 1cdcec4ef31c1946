from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulse.operators import schedule, store
from pulse.plans import collector
from pulse.schema import STATS, TORRENTS

NOW = datetime(2025, 1, 1, 12)
ITEM = "infohash string, pubdate timestamp, status string"
READ = "infohash string, timestamp timestamp"


def items(spark, *rows):
    return spark.createDataFrame([(k, NOW - age, s) for k, age, s in rows], ITEM)


def read(spark, *rows):
    return spark.createDataFrame([(k, NOW - gap) for k, gap in rows], READ)


def days(n):
    return timedelta(days=n)


AGES = [("hourly", timedelta(hours=1)), ("four", days(5)), ("daily", days(20)), ("weekly", days(120)), ("never", days(200))]


def test_one_item_of_each_class(spark):
    torrents = items(spark, *[(k, a, "active") for k, a in AGES], ("new", days(300), "active"), ("gone", days(1), "dead"))
    stats = read(spark, *[(k, timedelta(minutes=90)) for k, _ in AGES], ("gone", days(1)))
    summary = {r["schedule_type"]: r["items"] for r in schedule.schedule_summary(torrents, stats, NOW).collect()}
    assert summary == {"hourly": 1, "every_4_hours": 1, "daily": 1, "weekly": 1, "never": 1, "never_scraped": 1, "dead": 1}
    due = [r["infohash"] for r in schedule.in_scrape_order(schedule.due_items(torrents, stats, NOW)).collect()]
    assert due == ["new", "hourly"]
    due = {r["infohash"] for r in schedule.due_items(torrents, stats, NOW, 180).collect()}
    assert due == {"new", "hourly", "four"}


@pytest.mark.parametrize("age, gap, due", [
    (days(1), timedelta(minutes=59), False), (days(1), timedelta(minutes=61), True), (days(3), timedelta(hours=3), False),
    (days(3), timedelta(hours=5), True), (days(10), timedelta(hours=23), False), (days(10), timedelta(hours=25), True),
    (days(100), days(6), False), (days(100), days(8), True), (days(181), days(90), False),
])
def test_gaps(spark, age, gap, due):
    found = schedule.due_items(items(spark, ("k", age, "active")), read(spark, ("k", gap)), NOW)
    assert (found.count() == 1) is due


def test_status_without_value(spark):
    torrents, stats = items(spark, ("k", days(1), None)), read(spark, ("k", days(1)))
    assert schedule.due_items(torrents, stats, NOW).count() == 0
    assert schedule.schedule_summary(torrents, stats, NOW).first()["schedule_type"] == "hourly"
    assert schedule.schedule_of(torrents, stats, NOW).first()["is_due"] is True


def test_metrics(spark):
    torrents = items(spark, ("a", days(1), "active"), ("b", days(1), "active"), ("c", days(1), "dead"), ("d", days(1), "guessit_failed"))
    row = schedule.system_metrics(torrents, read(spark, ("a", timedelta(minutes=5)), ("c", days(2))), NOW).first()
    assert row.asDict() == {
        "torrents_total": 4, "torrents_active": 2, "torrents_dead": 1, "torrents_guessit_failed": 1,
        "queue_depth": 1, "stats_total": 2, "stats_recent": 1,
    }


def test_feed_status(spark):
    row = schedule.feed_status(items(spark, ("a", timedelta(minutes=50), "active")), NOW, 1).first()
    assert row["should_fetch"] is False
    assert schedule.feed_status(items(spark), NOW, 1).first()["should_fetch"] is True


def counters(spark, *rows):
    return spark.createDataFrame([(k, NOW + timedelta(hours=h), s, p, d) for k, h, s, p, d in rows], STATS)


def test_dead_needs_three_zero_readings(spark):
    stats = counters(
        spark, ("dead", 1, 5, 0, 9), ("dead", 2, 0, 0, 0), ("dead", 3, 0, 0, 0), ("dead", 4, 0, 0, 0),
        ("two", 1, 0, 0, 0), ("two", 2, 0, 0, 0), ("mid", 1, 0, 0, 0), ("mid", 2, 0, 1, 0), ("mid", 3, 0, 0, 0),
    )
    assert [r["infohash"] for r in schedule.dead_keys(stats).collect()] == ["dead"]
    latest = store.latest_per_key(stats.filter("infohash = 'dead'"), ["infohash"], [F.col("timestamp")], 3)
    assert [r["timestamp"].hour for r in latest.orderBy("recency").collect()] == [16, 15, 14]


def test_batches(spark):
    due = spark.createDataFrame([(f"{i:04d}", NOW - timedelta(minutes=i % 7)) for i in range(95)], "infohash string, last_scrape timestamp")
    got = schedule.batches(due, 40)
    assert sorted(r["count"] for r in got.groupBy("batch").count().collect()) == [15, 40, 40]
    expected = [r["infohash"] for r in schedule.in_scrape_order(due).collect()]
    assert [r["infohash"] for r in got.orderBy("position").collect()] == expected


def torrent(key, name="[G] Show - 01.mkv", status="active", data="{}"):
    return (key, name, NOW, 1, 1, False, False, status, data)


def test_first_and_last_win(spark):
    schema = "k int, v string, at int"
    stored = spark.createDataFrame([(1, "old", 0)], schema)
    rows = spark.createDataFrame([(1, "b", 2), (2, "x", 1), (2, "y", 2), (2, "w", 0)], schema)
    added = store.insert_if_absent(stored, rows, ["k"], [F.col("at")])
    assert [tuple(r) for r in added.collect()] == [(2, "w", 0)]
    table = store.upsert(stored, rows, ["k"], [F.col("at")])
    assert sorted(tuple(r) for r in table.collect()) == [(1, "b", 2), (2, "y", 2)]


def test_upsert_rewrites_touched_partitions(spark, tmp_path):
    schema = "k int, v string, at int"
    path = str(tmp_path / "t")
    place = F.col("k") % 3
    old = spark.createDataFrame([(1, "a", 0), (4, "b", 0), (3, "c", 0)], schema)
    store.with_partition(old, ["k"], place, "part").coalesce(1).write.partitionBy("part").parquet(path)
    untouched = sorted((tmp_path / "t" / "part=0").glob("part-*"))
    rows = spark.createDataFrame([(4, "x", 1), (4, "y", 2), (5, "z", 1)], schema)
    store.upsert_partitions(path, rows, ["k"], [F.col("at")], place, "part")
    found = sorted((r["k"], r["v"], r["part"]) for r in spark.read.parquet(path).collect())
    assert found == [(1, "a", 1), (3, "c", 0), (4, "y", 1), (5, "z", 2)]
    assert sorted((tmp_path / "t" / "part=0").glob("part-*")) == untouched
    with pytest.raises(AnalysisException):
        store.upsert_partitions(path, rows, ["k"], [F.col("at")], F.col("at") % 3, "part")


def test_stored_run_touches_only_its_partitions(spark, tmp_path):
    """A run on stored tables gives what the whole-table run gives."""
    root = str(tmp_path)
    torrents = spark.createDataFrame([torrent(k) for k in ("aa", "bb", "cc")], TORRENTS)
    stats = counters(spark, *[(k, -h, 0, 0, 0) for k in ("aa", "bb") for h in (30, 40)], ("cc", -30, 1, 1, 1))
    collector.create(root, torrents, stats)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "stats").rglob("part-*.parquet")}
    scraped = counters(spark, ("aa", 0, 0, 0, 0), ("bb", 0, 3, 1, 9))
    collector.store_readings(root, scraped)
    marked, stored = schedule.collect(torrents, stats, scraped)
    status = lambda df: sorted((r["infohash"], r["status"]) for r in df.collect())
    assert status(collector.stored_torrents(spark, root)) == status(marked)
    rows = lambda df: sorted(tuple(r) for r in df.select("infohash", "timestamp", "downloads").collect())
    assert rows(collector.stored_stats(spark, root)) == rows(stored)
    kept = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    assert kept and all("day=2" in str(p) for p in kept)
    new = spark.createDataFrame(
        [("aa", "x", NOW, 1, 1, False, False, None, 5, 5, 5), ("dd", "new", NOW, 1, 1, True, False, "{}", 7, 8, 9)],
        "infohash string, filename string, pubdate timestamp, size_bytes bigint, source_id bigint, trusted boolean, remake boolean, "
        "guessit_data string, seeders bigint, leechers bigint, downloads bigint",
    )
    collector.store_feed(root, new)
    assert status(collector.stored_torrents(spark, root)) == [("aa", "guessit_failed"), ("bb", "active"), ("cc", "active"), ("dd", "active")]
    # A first reading never replaces one that is stored.
    assert rows(collector.stored_stats(spark, root)) == sorted([*rows(stored), ("dd", NOW.replace(tzinfo=None), 9)])


def test_collection_run(spark):
    torrents = spark.createDataFrame([torrent("aa"), torrent("bb"), torrent("cc")], TORRENTS)
    stats = counters(spark, *[(k, -h, 0, 0, 0) for k in ("aa", "bb") for h in (30, 40)], ("cc", -30, 1, 1, 1))
    requested = collector.plan_scrape(torrents, stats, NOW, batch_size=2)
    assert requested.count() == 3
    results = spark.createDataFrame([("bb", 3, 1, 9)], "infohash string, seeders int, leechers int, downloads bigint")
    failed = requested.filter("infohash = 'cc'").select("batch")
    answered = requested.select("batch").join(failed, "batch", "left_anti")
    after, readings = collector.take_results(torrents, stats, requested, results, answered, NOW)
    assert {r["infohash"]: r["status"] for r in after.collect()} == {"aa": "dead", "bb": "active", "cc": "active"}
    assert readings.count() == 7


def test_ingest(spark):
    torrents = spark.createDataFrame([torrent("aa", "first"), torrent("bb", "kept")], TORRENTS)
    stats = counters(spark, ("aa", 0, 1, 1, 1))
    rows = spark.createDataFrame(
        [("aa", "second", NOW, 1, 1, False, False, "{}", 5, 5, 5), ("bb", "??", NOW, 1, 1, False, False, None, 5, 5, 5),
         ("cc", "new", NOW, 1, 1, True, False, "{}", 7, 8, 9)],
        "infohash string, filename string, pubdate timestamp, size_bytes bigint, source_id bigint, trusted boolean, remake boolean, "
        "guessit_data string, seeders bigint, leechers bigint, downloads bigint",
    )
    all_torrents, all_stats = collector.ingest(torrents, stats, rows)
    found = {r["infohash"]: (r["filename"], r["status"]) for r in all_torrents.collect()}
    assert found == {"aa": ("first", "active"), "bb": ("kept", "guessit_failed"), "cc": ("new", "active")}
    assert {(r["infohash"], r["downloads"]) for r in all_stats.collect()} == {("aa", 1), ("bb", 5), ("cc", 9)}


def test_a_numbered_batch_is_stored_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    torrents = spark.createDataFrame([torrent(k) for k in ("aa", "bb")], TORRENTS)
    stats = counters(spark, *[(k, -h, 0, 0, 0) for k in ("aa", "bb") for h in (30, 40)])
    collector.create(root, torrents, stats)
    scraped = counters(spark, ("aa", 0, 0, 0, 0), ("bb", 0, 3, 1, 9))
    real = collector._set_status

    def broken(*args):
        raise RuntimeError("lost")

    # It breaks off between the tables, and another run finishes it.
    monkeypatch.setattr(collector, "_set_status", broken)
    with pytest.raises(RuntimeError):
        collector.store_readings(root, scraped, 7)
    monkeypatch.setattr(collector, "_set_status", real)
    collector.store_readings(root, scraped, 7)
    marked, stored = schedule.collect(torrents, stats, scraped)
    status = lambda df: sorted((r["infohash"], r["status"]) for r in df.collect())
    assert status(collector.stored_torrents(spark, root)) == status(marked)
    assert collector.stored_stats(spark, root).count() == stored.count()
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("part-*.parquet")}
    collector.store_readings(root, scraped, 7)
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("part-*.parquet")} == files
