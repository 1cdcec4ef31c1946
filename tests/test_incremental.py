"""The weekly tables after updates are those of a full recompute, and untouched weeks are not read."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulse.operators.ranking import weekly_rankings
from pulse.operators.series import counter_deltas, episode_dims, episode_series, weekly_totals
from pulse.plans import incremental

START = datetime(2025, 10, 6, 12)
DAY = timedelta(days=1)


class Store:
    """Torrents and readings, with what a full recompute makes of them, and updates of what changed."""

    def __init__(self, spark, root):
        self.spark, self.root, self.number, self.before = spark, root, 0, None
        self.torrents: dict[str, tuple] = {}
        self.readings: dict[tuple, int] = {}

    def full(self):
        torrents = self.spark.createDataFrame(
            [(k, *t, None) for k, t in self.torrents.items()], "infohash string, anilist_id bigint, episode bigint, pubdate timestamp, filename string"
        )
        stats = self.spark.createDataFrame([(*k, n) for k, n in self.readings.items()], "infohash string, timestamp timestamp, downloads bigint")
        return episode_dims(torrents), counter_deltas(stats)

    def update(self):
        dims, deltas = self.full()
        rows = {(r.infohash, r.timestamp): r.downloads_delta for r in deltas.collect()}
        old = self.before or {}
        changed = [(*k, n, self.number) for k, n in rows.items() if old.get(k) != n]
        changes = self.spark.createDataFrame(changed, "infohash string, timestamp timestamp, downloads_delta bigint, version bigint")
        self.before = rows
        incremental.update(self.spark, self.root, self.number, dims, changes)
        self.number += 1
        return [r["week"] for r in incremental.touched_weeks(self.spark, self.root, self.number - 1).collect()]

    def check(self):
        dims, deltas = self.full()
        series = episode_series(deltas.join(dims, "infohash")).cache()
        columns = ["anilist_id", "episode", "time_bucket_hours", "first_datetime", "period_start", "downloads_daily", "downloads_cumulative", "date"]
        got = incremental.series(self.spark, self.root).select(*columns).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, series.select(*columns).collect()))
        want = weekly_rankings(weekly_totals(series)).select("week", "anilist_id", "downloads", "rank").collect()
        assert sorted(map(tuple, incremental.rankings(self.spark, self.root).collect())) == sorted(map(tuple, want))

    def read(self, name, day, downloads):
        self.readings[name, START + day * DAY] = downloads

    def publish(self, name, show, episode, day):
        self.torrents[name] = (show, episode, START + day * DAY)
        self.read(name, day, 0)


def filled(spark, root, seed=1, days=30):
    store, pick = Store(spark, str(root)), random.Random(seed)
    for i in range(12):
        store.publish(f"t{i}", i % 4, i // 4, pick.randrange(days // 2))
    for name, (_, _, at) in list(store.torrents.items()):
        first = (at - START).days
        for day in range(first + 1, days):
            if pick.random() < 0.7:
                store.read(name, day, pick.randrange(200) + day)
    return store, pick


def test_updates_equal_full_recomputes(spark, tmp_path):
    store, pick = filled(spark, tmp_path)
    store.update()
    store.check()
    # New readings at the end, one late one, one that is corrected.
    for name in ("t1", "t2", "t7"):
        store.read(name, 31, 500 + pick.randrange(100))
    store.read("t3", 20.5, 77)
    store.readings[next(k for k in store.readings if k[0] == "t4" and store.readings[k])] += 9
    assert len(store.update()) < 5
    store.check()
    # A new episode, a torrent that releases an old one earlier, one that belongs to another show, one that is none.
    store.publish("new", 9, 1, 32)
    store.read("new", 33, 40)
    store.publish("early", 2, 1, 0.25)
    store.read("early", 3, 25)
    store.torrents["t0"] = (3, 5, store.torrents["t0"][2])
    del store.torrents["t6"]
    store.update()
    store.check()
    # The last torrents of a show go, and with them rows of weeks and partitions.
    for name in [k for k, t in store.torrents.items() if t[0] in (9, 1)]:
        del store.torrents[name]
    store.update()
    store.check()


def test_untouched_weeks_are_not_read(spark, tmp_path):
    store, _ = filled(spark, tmp_path, 2, 40)
    store.update()
    weeks = sorted(p.name for p in (tmp_path / "weeks").glob("week=*"))
    # Broken files: a job that reads them fails.
    kept = {p: p.read_bytes() for w in weeks[:3] for p in (tmp_path / "weeks" / w).glob("*.parquet")}
    for path in kept:
        path.write_bytes(b"broken")
    for crc in (tmp_path / "weeks").rglob(".*.crc"):
        crc.unlink()
    store.read("t1", 41, 900)
    store.read("t2", 41.5, 800)
    touched = store.update()
    assert touched and not set(touched) & {w.removeprefix("week=") for w in weeks[:3]}
    for path, data in kept.items():
        path.write_bytes(data)
    store.check()


@pytest.mark.parametrize("table", ["deltas", "dims", "series", "weeks"])
def test_an_update_that_breaks_off_is_finished(spark, tmp_path, monkeypatch, table):
    store, _ = filled(spark, tmp_path, 3, 12)
    store.update()
    store.read("t1", 13, 300)
    real = incremental._replace

    def broken(rows, path, partition):
        if path.endswith(table):
            raise RuntimeError("lost")
        real(rows, path, partition)

    monkeypatch.setattr(incremental, "_replace", broken)
    before, number = dict(store.before), store.number
    with pytest.raises(RuntimeError):
        store.update()
    monkeypatch.setattr(incremental, "_replace", real)
    store.before, store.number = before, number
    store.update()
    store.check()
    # Done is done.
    files = {p: p.stat().st_mtime_ns for p in Path(store.root).rglob("*.parquet")}
    incremental.update(spark, store.root, number, *store.full())
    assert {p: p.stat().st_mtime_ns for p in Path(store.root).rglob("*.parquet")} == files


def test_an_older_version_changes_nothing(spark, tmp_path):
    store, _ = filled(spark, tmp_path, 4, 10)
    store.update()
    dims, _ = store.full()
    (name, at), n = next(iter(store.before.items()))
    stale = spark.createDataFrame([(name, at, n + 50, -1)], "infohash string, timestamp timestamp, downloads_delta bigint, version bigint")
    incremental.update(spark, store.root, 1, dims, stale)
    assert incremental.touched_weeks(spark, store.root, 1).count() == 0
    store.check()
    assert incremental.table(spark, store.root, "deltas").filter(F.col("version") < 0).count() == 0
