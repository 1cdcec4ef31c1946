"""Streams end where a batch over everything ends, and a batch costs what it brings."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulse.operators.schedule import due_items
from pulse.operators.series import counter_deltas
from pulse.schema import STATS
from pulse.streaming import jobs

START = datetime(2025, 10, 1)
READING = "infohash string, timestamp timestamp, downloads bigint"
DAY = timedelta(days=1)


def source(spark, folder, schema, *batches, first=0):
    for i, rows in enumerate(batches, first):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/part{i:03d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(f"{folder}/part*")


def updated(query):
    """Rows of state that each batch with rows has changed, and how many there were."""
    return [(p["stateOperators"][0]["numRowsUpdated"], p["stateOperators"][0]["numRowsTotal"]) for p in query.recentProgress if p["numInputRows"]]


@pytest.mark.parametrize("shuffled", [False, True])
def test_deltas(spark, tmp_path, shuffled):
    """In order, and in any order: late readings correct the delta after them, also on a later day."""
    pick = random.Random(3)
    rows = [(f"k{i % 5}", START + timedelta(minutes=37 * i), pick.randrange(100)) for i in range(200)]
    if shuffled:
        pick.shuffle(rows)
    batches = [rows[i : i + 40] for i in range(0, 200, 40)]
    root = str(tmp_path)
    jobs.incremental_deltas(source(spark, f"{root}/in", READING, *batches), root, f"{root}/state")
    expected = counter_deltas(spark.createDataFrame(rows, READING))
    got = jobs.emitted_deltas(spark, root)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    # In order nothing is emitted twice.
    assert (jobs.delta_changes(spark, root).count() > 200) == shuffled
    assert jobs.keys_to_recount(spark, root).count() == 0


def test_late_reading_corrects_its_neighbour(spark, tmp_path):
    root = str(tmp_path)
    batches = [[("k", START, 5), ("k", START + 3 * DAY, 20), ("j", START, 1)], [("k", START + DAY, 12)], [("k", START + DAY, 14), ("k", START + DAY / 2, 14)]]
    found = []
    for i, batch in enumerate(batches):
        jobs.incremental_deltas(source(spark, f"{root}/in", READING, batch, first=i), root, f"{root}/state")
        rows = jobs.emitted_deltas(spark, root).filter("infohash = 'k'").collect()
        found.append(sorted(((r["timestamp"] - START) / DAY, r["downloads_delta"]) for r in rows))
    assert found == [[(0, 0), (3, 15)], [(0, 0), (1, 7), (3, 8)], [(0, 0), (0.5, 9), (1, 0), (3, 6)]]


def test_a_repeated_reading_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = [("k", START + timedelta(hours=h), h * 3) for h in range(30)]
    batches = [rows[:10], rows[10:], rows[5:], [("k", START, 0), ("k", START, -1)], [("k", None, 4), (None, START, 4), ("k", START + DAY / 2, None)]]
    jobs.incremental_deltas(source(spark, f"{root}/in", READING, *batches), root, f"{root}/state")
    changes = jobs.delta_changes(spark, root).collect()
    assert sorted(r["downloads_delta"] for r in changes) == [0] + [3] * 29


def test_cost_of_a_batch_follows_its_rows(spark, tmp_path):
    """Every batch has one reading of each of four keys; the state it changes is theirs, however many slots there are."""
    root = str(tmp_path)
    batches = [[(f"k{k}", START + i * DAY, i * 10 + k) for k in range(4)] for i in range(12)]
    first, second = jobs.incremental_deltas(source(spark, f"{root}/in", READING, *batches), root, f"{root}/state")
    assert updated(first) == [(4, 4 * (i + 1)) for i in range(12)]
    assert all(n == 4 for n, _ in updated(second))
    assert jobs.delta_changes(spark, root).count() == 48


def test_forgotten_slots_ask_for_a_recount(spark, tmp_path):
    schema = READING + ", arrived timestamp"
    root = str(tmp_path)
    batches = [[("k", START, 5, START), ("j", START, 1, START)], [("j", START + 9 * DAY, 2, START + 9 * DAY)], [("j", START + 9 * DAY, 2, START + 10 * DAY)],
               [("k", START + DAY / 4, 7, START + 11 * DAY), ("k", START + 11 * DAY, 9, START + 11 * DAY)]]
    for i, batch in enumerate(batches):
        stream = source(spark, f"{root}/in", schema, batch, first=i)
        first, _ = jobs.incremental_deltas(stream, root, f"{root}/state", arrived="arrived", lateness="3 days")
    assert [r[0] for r in jobs.keys_to_recount(spark, root).collect()] == ["k"]
    assert first.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 5


def test_dead_detection(spark, tmp_path):
    def row(key, hour, value):
        return (key, START + timedelta(hours=hour), value, 0, 0)

    root = str(tmp_path)
    batches = [
        [row("a", 1, 0), row("b", 1, 3), row("c", 1, 0)], [row("a", 2, 0), row("b", 2, 0)], [row("a", 3, 0), row("b", 3, 0), row("c", 2, 0)],
        [row("b", 4, 0)], [row("a", 4, 1)], [row("b", 3, 5), row("d", 1, 0), row("d", 2, None), row("d", 3, 0)],
    ]
    dead = []
    for i, batch in enumerate(batches):
        stream = source(spark, f"{root}/in", STATS, batch, first=i)
        jobs.dead_detection(stream, f"{root}/dead", f"{root}/state").awaitTermination()
        dead.append(sorted(r[0] for r in jobs.dead_now(spark, f"{root}/dead").collect()))
    assert dead == [[], [], ["a"], ["a", "b"], ["b"], ["d"]]
    # Only changes of the verdict are written, and the state is three readings a key.
    assert spark.read.parquet(f"{root}/dead").count() == 5
    kept = jobs.recent_readings(spark, f"{root}/state")
    assert {(r["infohash"], (r["timestamp"] - START).seconds // 3600, r["seeders"]) for r in kept.collect()} == {
        ("a", 2, 0), ("a", 3, 0), ("a", 4, 1), ("b", 2, 0), ("b", 3, 5), ("b", 4, 0), ("c", 1, 0), ("c", 2, 0), ("d", 1, 0), ("d", 2, 0), ("d", 3, 0),
    }


def test_first_rows(spark, tmp_path):
    schema = "infohash string, name string, at int, arrived timestamp"
    root = str(tmp_path)
    day = lambda n: START + n * DAY
    batches = [
        [("a", "x", 2, day(0)), ("a", "y", 1, day(0)), ("c", "once", 3, day(0))],
        [("a", "z", 0, day(1)), ("b", "w", 5, day(1)), ("a", "x", 2, day(1))],
        [("d", "later", 1, day(9))],
        [("a", "x", 2, day(10)), ("c", "again", 3, day(10))],
        [("f", "last", 1, day(11))],
    ]
    stream = source(spark, f"{root}/in", schema, *batches)
    query = jobs.first_rows(stream, f"{root}/t", f"{root}/state", ["infohash"], ["at"], "arrived")
    query.awaitTermination()
    got = spark.read.parquet(f"{root}/t")
    # A key that comes again behind the horizon is known from the stored rows.
    assert sorted((r["infohash"], r["name"]) for r in got.collect()) == [("a", "y"), ("b", "w"), ("c", "once"), ("d", "later"), ("f", "last")]
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(totals) <= 6 and totals[-1] <= 3


def test_first_rows_of_a_repeated_batch(spark, tmp_path):
    """A batch that is run again replaces what it wrote."""
    schema = "infohash string, at int"
    root = str(tmp_path)
    stream = source(spark, f"{root}/in", schema, [("a", 1), ("b", 2)], [("c", 1)])
    jobs.first_rows(stream, f"{root}/t", f"{root}/one", ["infohash"], ["at"]).awaitTermination()
    jobs.first_rows(stream, f"{root}/t", f"{root}/two", ["infohash"], ["at"]).awaitTermination()
    assert sorted(r["infohash"] for r in spark.read.parquet(f"{root}/t").collect()) == ["a", "b", "c"]


def test_first_rows_keep_their_keys_out_of_the_heap(spark, tmp_path):
    """The keys of the horizon are in a store on disk, and only rows that are stored are finished."""
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    root = str(tmp_path)
    finished = []

    def finish(rows):
        finished.append(rows.count())
        return rows.withColumn("named", F.upper("infohash"))

    batches = [[("a", 1), ("b", 2)], [("a", 1), ("b", 2), ("c", 1), ("c", 2)], [("b", 1), ("d", 1)], [("d", 1)]]
    stream = source(spark, f"{root}/in", "infohash string, at int", *batches)
    query = jobs.first_rows(stream, f"{root}/t", f"{root}/state", ["infohash"], ["at"], finish=finish)
    query.awaitTermination()
    got = spark.read.parquet(f"{root}/t").collect()
    assert sorted((r["infohash"], r["at"], r["named"]) for r in got) == [("a", 1, "A"), ("b", 2, "B"), ("c", 1, "C"), ("d", 1, "D")]
    assert finished[:4] == [2, 1, 1, 0] and not any(finished[4:])
    assert any(m.startswith("rocksdb") for m in query.recentProgress[0]["stateOperators"][0]["customMetrics"])
    assert spark.conf.get(store) == before


TOTALS = "timestamp timestamp, anilist_id bigint, downloads_delta bigint, arrived timestamp"


def test_weekly_windows_close_and_are_corrected(spark, tmp_path):
    root = str(tmp_path)
    edge = datetime(2025, 10, 5, 5)

    def row(at, show, n, arrived=None):
        return (at, show, n, arrived or at)

    late = edge - 2 * DAY
    batches = [
        [row(edge - timedelta(seconds=1), 1, 5), row(edge, 1, 7)],
        [row(edge - DAY / 2, 1, 2, edge + DAY)],  # in time
        [row(edge + 9 * DAY, 1, 11)],
        [row(edge + 10 * DAY, 2, 1)],
        [row(late, 1, 100, edge + 11 * DAY)],  # its week is closed
    ]
    closed = []
    for i, batch in enumerate(batches):
        jobs.weekly_totals(source(spark, f"{root}/in", TOTALS, batch, first=i), f"{root}/t", f"{root}/state", "arrived")
        closed.append(sorted(map(tuple, jobs.closed_totals(spark, f"{root}/t").collect())))
    week = lambda n: f"{edge + 7 * n * DAY:%Y-%m-%d}"
    assert closed == [[], [], [(week(-1), 1, 7), (week(0), 1, 7)], [(week(-1), 1, 7), (week(0), 1, 7)], [(week(-1), 1, 7), (week(0), 1, 7)]]
    totals = sorted(map(tuple, jobs.current_totals(spark, f"{root}/t", f"{root}/state").collect()))
    assert totals == [(week(-1), 1, 107), (week(0), 1, 7), (week(1), 1, 11), (week(1), 2, 1)]
    # Closed weeks have left the state.
    assert jobs.state_rows(spark, f"{root}/state/closed", jobs._OPEN).count() == 2


ITEM = "infohash string, pubdate timestamp, status string, timestamp timestamp, seeders int, leechers int, downloads bigint, arrived timestamp"


def test_due_items_at_each_step(spark, tmp_path):
    """Items of all ages, some read, some dead: after each step the stream says what the batch says."""
    pick = random.Random(5)
    root = str(tmp_path)
    torrents, stats = [], []
    clock = START
    for step, hours in enumerate([1, 1, 3, 20, 24, 100, 700, 2000, 2500]):
        events = []
        clock += timedelta(hours=hours)
        for i in range(4):
            pubdate = clock - timedelta(hours=pick.choice([0, 1, 47, 48, 160, 700, 5000]))
            torrents.append((f"t{step}.{i}", pubdate, pick.choice(["active"] * 5 + ["guessit_failed"])))
            events.append((*torrents[-1], None, None, None, None, clock))
        for name, _, _ in torrents:
            if pick.random() < 0.5:
                zero = name.endswith("3") or pick.random() < 0.3
                at = clock - timedelta(minutes=pick.choice([0, 0, 30, 600]))
                if not any(s[:2] == (name, at) for s in stats):
                    stats.append((name, at, *([0, 0, 0] if zero else [1, 0, 2])))
                    events.append((name, None, None, *stats[-1][1:], clock))
        events.append((None,) * 7 + (clock,))
        jobs.due_changes(source(spark, f"{root}/in", ITEM, events, first=step), f"{root}/due", f"{root}/state").awaitTermination()
        dead = {
            name for name, _, _ in torrents
            if len(found := sorted((s for s in stats if s[0] == name), key=lambda s: s[1])[-3:]) == 3 and not any(n for s in found for n in s[2:])
        }
        for name in dead:  # once dead, always
            at = next(i for i, t in enumerate(torrents) if t[0] == name)
            if torrents[at][2] == "active":
                torrents[at] = (*torrents[at][:2], "dead")
        want = due_items(
            spark.createDataFrame(torrents, "infohash string, pubdate timestamp, status string"), spark.createDataFrame(stats, STATS), clock
        )
        assert sorted(r[0] for r in jobs.due_now(spark, f"{root}/due").collect()) == sorted(r["infohash"] for r in want.collect()), step
    changes = spark.read.parquet(f"{root}/due")
    assert changes.filter("NOT is_due").count() > 5 and changes.filter("status = 'dead'").count() > 0


def test_changes_of_due_are_where_the_answer_changes():
    pick = random.Random(1)
    for _ in range(300):
        pubdate, last = 0, pick.choice([None, pick.randrange(0, 200 * 86400, 1800)])
        now = pick.randrange(0, 190 * 86400, 600)
        found = jobs.next_change("active", pubdate, last, now)
        answer = jobs.due_at("active", pubdate, last, now)
        if found is None:
            assert all(jobs.due_at("active", pubdate, last, t) == answer for t in range(now, now + 250 * 86400, 1800))
        else:
            assert jobs.due_at("active", pubdate, last, found) != answer
            assert all(jobs.due_at("active", pubdate, last, t) == answer for t in range(now, found, 1800))


class State:
    """What a group's step is handed, without Spark."""

    exists, get, hasTimedOut, watermark, timer = False, None, False, 0, None  # noqa: N815

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.watermark

    def update(self, value):
        self.exists, self.get, self.timer = True, value, None

    def setTimeoutTimestamp(self, at):  # noqa: N802
        self.timer = at


class PlainItem:
    """One item at a time, as it is described."""

    def __init__(self):
        self.status, self.pubdate, self.last, self.columns = "active", None, None, ([], [], [], [])
        self.is_due, self.clock, self.version = False, None, 0

    def flip(self, at, rows, name):
        now = jobs.due_at(self.status, self.pubdate, self.last, at)
        if now != self.is_due:
            self.is_due, self.version = now, self.version + 1
            rows.append((name, at, now, self.status, self.version))

    def following(self):
        return None if self.clock is None else jobs.next_change(self.status, self.pubdate, self.last, self.clock)

    def run_to(self, now, rows, name):
        while (at := self.following()) is not None and at <= now:
            self.clock = at
            self.flip(at, rows, name)
        self.clock = now

    def take(self, events, rows, name):
        self.run_to(max(*[e[0] for e in events], self.clock or 0), rows, name)
        arrived = {}
        for _, pubdate, status, *reading in events:
            self.pubdate = pubdate if self.pubdate is None else self.pubdate
            self.status = self.status if status in (None, "active") else status
            if reading[0] is not None:
                seconds = reading[0] // 1_000_000
                self.last = seconds if self.last is None else max(seconds, self.last)
                jobs._arrive(arrived, tuple(reading))
        recent = jobs._newest(self.columns, arrived)
        self.columns = jobs._columns(recent)
        self.status = "dead" if self.status == "active" and jobs._all_zero(recent) else self.status


def test_items_of_a_bucket_are_as_each_alone():
    """Nulls, ties, late readings, statuses in any order, and batches without rows: all items of a bucket at once change as
    each by itself."""
    pick = random.Random(11)
    plain, state, clock = {}, State(), -5 * 86400
    for step in range(60):
        clock += pick.choice([1, 60, 3600, 86400, 9 * 86400, 70 * 86400])
        state.hasTimedOut = step > 40 and step % 5 == 0
        events = []
        for _ in range(0 if state.hasTimedOut else pick.choice([1, 30, 90])):
            at = None if pick.random() < 0.3 else (clock - pick.choice([0, 0, 1, 3600, 86400])) * 1_000_000 + pick.choice([0, 0, 7])
            events.append((
                f"k{pick.randrange(40)}", clock - pick.choice([0, 0, 5]), clock - pick.randrange(9 * 86400) if pick.random() < 0.5 else None,
                pick.choice(["guessit_failed", "gone"] if pick.random() < 0.01 else [None, "active"]),
                at, pick.choice([0, 0, 0, 2]), 0, pick.choice([0, 0, 0, 3, 2**60 + 1]),
            ))
        wanted = []
        now = (state.watermark + 1) // 1000
        touched = {e[0] for e in events}
        for name, item in plain.items():
            if name not in touched and item.following() is not None and item.following() <= now:
                item.run_to(now, wanted, name)
                item.flip(item.clock, wanted, name)
        for name in touched:
            item = plain.setdefault(name, PlainItem())
            item.take([e[1:] for e in events if e[0] == name], wanted, name)
            item.flip(item.clock, wanted, name)
        names = ("infohash", "arrived", "pubdate", "status", "at", "seeders", "leechers", "downloads")
        rows = [tuple(jobs._NONE if v is None and c in ("pubdate", "at") else v for c, v in zip(names, e, strict=True)) for e in events]
        frames = [pd.DataFrame(rows[i : i + 50], columns=names) for i in range(0, len(rows), 50)]
        got = [tuple(r) for frame in jobs._due_step((0,), iter(frames), state) for r in frame.itertuples(index=False)]
        assert sorted(got) == sorted(wanted), step
        first = min((f for i in plain.values() if (f := i.following()) is not None), default=None)
        assert state.timer == (None if first is None else max(first * 1000 - 2, state.watermark + 1)), step
        state.watermark = max(state.watermark, clock * 1000 - 1)
    assert {i.status for i in plain.values()} >= {"active", "dead", "gone"}


def test_state_of_many_items_is_small():
    """An item's three readings, dates and answers were hundreds of bytes on the heap."""
    n, state = 20_000, State()
    rows = [(f"{i:040x}", 10 * i, i, "active", (5 * i + r) * 1_000_000, 1, 2, 3) for i in range(n) for r in range(3)]
    names = ("infohash", "arrived", "pubdate", "status", "at", "seeders", "leechers", "downloads")
    list(jobs._due_step((0,), iter([pd.DataFrame(rows, columns=names)]), state))
    assert sum(map(len, state.get)) < 60 * n and type(state.get[0]) is bytes


MANY = 2500


def test_many_keys_are_few_calls_for_deltas(spark, tmp_path):
    """A call of Python has a bucket of keys: with a call a key, a batch of many keys took hours."""
    root = str(tmp_path)
    rows = [(f"k{i}", START + timedelta(hours=h), i * h) for i in range(MANY) for h in (0, 1, 30)]
    first, second = jobs.incremental_deltas(source(spark, f"{root}/in", READING, rows), root, f"{root}/state")
    assert updated(first)[0][0] <= 2 * jobs.SLOT_BUCKETS and updated(second)[0][0] <= jobs.BUCKETS
    got = jobs.emitted_deltas(spark, root).collect()
    wanted = counter_deltas(spark.createDataFrame(rows, READING)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_many_keys_are_few_calls_for_dead_detection(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"k{i}", START + timedelta(hours=h), 0, 0, int(i % 5 == 0 and h > 1)) for i in range(MANY) for h in range(4)]
    query = jobs.dead_detection(source(spark, f"{root}/in", STATS, rows), f"{root}/dead", f"{root}/state")
    query.awaitTermination()
    assert updated(query)[0][0] <= jobs.BUCKETS
    assert jobs.dead_now(spark, f"{root}/dead").count() == MANY * 4 // 5
    kept = jobs.recent_readings(spark, f"{root}/state")
    assert kept.count() == 3 * MANY and kept.agg(F.min("timestamp")).first()[0] == START + timedelta(hours=1)


def test_keys_of_a_bucket_are_forgotten_one_by_one(spark, tmp_path):
    """All keys in one bucket: those silent for longer than the retention go, the others stay."""
    schema = STATS + ", arrived timestamp"
    root = str(tmp_path)
    names = [r[0] for r in spark.range(20000).select(F.col("id").cast("string").alias("infohash")).filter(jobs._bucket() == 7).limit(3).collect()]
    row = lambda key, day: (key, START + day * DAY, 1, 1, 1, START + day * DAY)
    batches = [[row(n, 0) for n in names], [row(names[0], 6)], [row(names[0], 12), row(names[1], 12)], [row(names[0], 13)]]
    stream = source(spark, f"{root}/in", schema, *batches)
    jobs.dead_detection(stream, f"{root}/dead", f"{root}/state", "arrived", "10 days").awaitTermination()
    kept = jobs.recent_readings(spark, f"{root}/state").groupBy("infohash").count().collect()
    assert sorted(map(tuple, kept)) == sorted([(names[0], 3), (names[1], 2)])


def test_many_items_are_few_calls_for_due_items(spark, tmp_path):
    """Items that come due one by one, by timers of their buckets, with nothing read."""
    root = str(tmp_path)
    items = [(f"t{i}", START - timedelta(seconds=i), "active", None, None, None, None, START) for i in range(MANY)]
    reads = [(f"t{i}", None, None, START - timedelta(seconds=i), 1, 1, 1, START) for i in range(MANY)]
    others = [[(f"other{m}", at := START + timedelta(minutes=m), "guessit_failed", None, None, None, None, at)] for m in (40, 61)]
    query = jobs.due_changes(source(spark, f"{root}/in", ITEM, items + reads, *others), f"{root}/due", f"{root}/state")
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) <= jobs.BUCKETS
    assert jobs.due_now(spark, f"{root}/due").count() == MANY
    first = spark.read.parquet(f"{root}/due").agg(F.min("at"), F.max("at")).first()
    assert [t - int(START.timestamp()) for t in first] == [3600 - MANY + 1, 3600]
