"""The collection's incremental behaviour as Structured Streaming jobs with keyed state.

What a batch costs follows the rows it brings and the state of their buckets of keys; no job reads what earlier
batches wrote. State is bounded: keys seen within a horizon, the readings of a slot until its lateness has
passed, three readings a key, open weeks. Results are appended by Spark's file sink, which writes every batch
once whatever fails, as changes with a version: the newest version of a row counts.

Where a job needs a clock it is the column `arrived`, the time of arrival, so that no row is too late
for its watermark; without one the batch's time is taken.

Handing a group to Python costs milliseconds, whatever is in it, so keys are dealt over buckets by their hash and a
group is a bucket: a batch makes at most that many calls (a slot of time), however many keys it brings. The state
of a bucket is the state of its keys, side by side in arrays; for the due items, which are never forgotten, in one
compressed table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulse.functions.times import utc
from pulse.operators.schedule import AGE_CLASSES, DEAD_AFTER
from pulse.operators.store import first_per_key, last_per_key, skip_existing
from pulse.session import cut, literal_rows

_DAY = 86400
SLOT_SECONDS = _DAY
# Nothing is read after its last age class, so a key silent for longer has ended.
RETENTION = "200 days"
LATENESS = "30 days"
# Buckets of keys, and of the keys of one slot: enough for many tasks, and few enough that a call has work to do.
BUCKETS, SLOT_BUCKETS = 1024, 64


def _milliseconds(duration: str) -> int:
    return int(pd.Timedelta(duration).total_seconds() * 1000)


# For state that grows with the keys: it is kept on the executors' disks, behind a cache of fixed size, and not in their
# heap. A checkpoint that was begun with another store keeps it. (Generated methods above 8,000 bytes, such as those of
# many patterns, are never compiled by the JVM; each expression by itself is.)
_LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the queries that are started within: a query copies its session's when it starts."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _start(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _append(rows: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = ()) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer.partitionBy(*partitions) if partitions else writer, checkpoint)


def appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What the file sink has committed; empty before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return literal_rows(spark, [], schema)


def state_rows(spark: SparkSession, checkpoint: str, schema: str) -> DataFrame:
    """The state of a query with one stateful operator, as key and value; empty before its first batch."""
    try:
        return spark.read.format("statestore").load(checkpoint)
    except AnalysisException:
        return literal_rows(spark, [], schema)


def _arrival(stream: DataFrame, arrived: str | None, within: str = "1 millisecond") -> DataFrame:
    clock = F.col(arrived) if arrived else F.current_timestamp()
    return stream.withColumn("arrived_", clock.cast("timestamp")).withWatermark("arrived_", within)


# Timers count on the clock: state goes when its key has had no rows for so long. (Timers of processing time would
# never let a query end that takes in what there is.)
_CLOCK = "unix_millis(arrived_) AS clock"
_TIMERS = GroupStateTimeout.EventTimeTimeout


def _bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64("infohash"), F.lit(buckets)).cast("int")


def _load(state: GroupState) -> dict[str, list]:
    """The state of each key of a bucket: its values, the last one the clock at which it was seen last."""
    if not state.exists:
        return {}
    keys, *columns = state.get
    return {key: list(values) for key, *values in zip(keys, *columns, strict=True)}


def _store(state: GroupState, keys: dict[str, list], width: int, timer: int | None) -> None:
    """Keep what is left of a bucket; the timer is for the first of its keys that needs one."""
    if not keys:
        if state.exists:
            state.remove()
        return
    columns = [list(c) for c in zip(*keys.values(), strict=True)]
    assert len(columns) == width
    state.update((list(keys), *columns))
    if timer is not None:
        state.setTimeoutTimestamp(max(timer, state.getCurrentWatermarkMs() + 1))


def _keep_for(state: GroupState, keys: dict[str, list], width: int, milliseconds: int) -> None:
    """Keep the keys of a bucket that have been seen within so long."""
    watermark = state.getCurrentWatermarkMs()
    kept = {key: values for key, values in keys.items() if values[-1] + milliseconds + 1 >= watermark}
    _store(state, kept, width, min((v[-1] for v in kept.values()), default=0) + milliseconds + 1)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")], dtype=object)


# ---- first rows -------------------------------------------------------------


def first_rows(
    stream: DataFrame, target: str, checkpoint: str, key: list[str], order: list[str],
    arrived: str | None = None, within: str = "2 days", finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append the first row of each key to ``target``: of those in one batch the first in order.

    Rows listed again within the horizon (feeds repeat their items for days) go by Spark's state,
    which holds the keys of the horizon only. What comes again later meets the stored keys,
    of which a batch reads the partitions (a digit of the key's hash) that it has rows for. ``finish`` adds
    the columns that only rows to be stored need.
    """
    seen = _arrival(stream, arrived, within).dropDuplicatesWithinWatermark([*key, *order]).drop("arrived_")
    columns = seen.columns
    stored = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in seen.select(*key).schema)}, digit string, batch bigint"
    digit = F.substring(F.sha1(F.concat_ws("\0", *[F.col(k).cast("string") for k in key])), 1, 1)

    def step(batch: DataFrame, batch_id: int) -> None:
        found = cut(first_per_key(batch, key, [F.col(c) for c in order]).withColumn("digit", digit))
        known = appended(batch.sparkSession, target, stored).filter(F.col("batch") < batch_id)
        known = known.join(found.select("digit").distinct(), "digit", "left_semi")
        new = skip_existing(found, known, key).withColumn("batch", F.lit(batch_id).cast("bigint"))
        new = new.select(*columns, "digit", "batch")
        # A batch owns its folders and replaces them when it is run again.
        (
            (finish(new) if finish else new).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("digit", "batch").parquet(target)
        )

    with _settings(stream.sparkSession, _LARGE_STATE):
        return _start(seen.writeStream.foreachBatch(step), checkpoint)


# ---- counter deltas ---------------------------------------------------------

_CHANGE = "infohash string, kind string, at bigint, value bigint, slot bigint, first bigint, last bigint, version bigint, fresh boolean"
_SLOT_STATE = "infohash array<string>, at array<array<bigint>>, downloads array<array<bigint>>, version array<bigint>, seen array<bigint>"
_KEY_STATE = (
    "infohash array<string>, slots array<array<bigint>>, at array<array<bigint>>, first array<array<bigint>>, "
    "last array<array<bigint>>, version array<bigint>, seen array<bigint>"
)


def _delta(now: int, then: int | None) -> int:
    return now - then if then is not None and now > then else 0


def _slot_step(retention: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Deltas within a slot of each key of a bucket, and its ends when they change."""
        keys, rows, slot = _load(state), [], int(key[1])
        if not state.hasTimedOut:
            arrived: dict[str, dict[int, int]] = {}
            clocks: dict[str, int] = {}
            for frame in frames:
                columns = [frame[c].tolist() for c in ("infohash", "at", "downloads", "clock")]
                for infohash, at, downloads, clock in zip(*columns, strict=True):
                    found = arrived.setdefault(infohash, {})
                    found[at] = max(downloads, found.get(at, downloads))
                    clocks[infohash] = max(clock, clocks.get(infohash, clock))
            for infohash, readings in arrived.items():
                fresh = infohash not in keys
                at, downloads, version, _ = keys.get(infohash, ([], [], 0, 0))
                old = dict(zip(at, downloads, strict=True))
                changed = {t for t, n in readings.items() if old.get(t) != n}
                if changed:
                    merged = sorted((old | readings).items())
                    version += 1
                    # A delta changes with its reading or with the one before.
                    rows += [
                        (infohash, "delta", t, _delta(n, n0), None, None, None, version, False)
                        for (t0, n0), (t, n) in zip(merged, merged[1:], strict=False) if t in changed or t0 in changed
                    ]
                    if {merged[0][0], merged[-1][0]} & changed:
                        rows.append((infohash, "edge", merged[0][0], None, slot, merged[0][1], merged[-1][1], version, fresh))
                    at, downloads = [t for t, _ in merged], [n for _, n in merged]
                keys[infohash] = [at, downloads, version, max(clocks[infohash], state.getCurrentWatermarkMs())]
        _keep_for(state, keys, 4, retention)
        if rows:
            yield _frame(rows, _CHANGE)

    return run


_FIRST = "infohash string, at bigint, value bigint, version bigint, late boolean"


def _edge_changes_of(infohash: str, known: list | None, newest: dict[int, tuple]) -> tuple[list[tuple], list]:
    """The deltas of the first readings of a key's slots that change with new ends of slots, and its new state."""
    slots, ats, firsts, lasts, version = [list(x) for x in known[:4]] + [known[4]] if known else ([], [], [], [], 0)
    before = {s: (a, f, p) for s, a, f, p in zip(slots, ats, firsts, [None, *lasts], strict=False)}
    rows, touched = [], set()
    version += 1
    for slot, (edge_version, at, first, last, fresh) in newest.items():
        place = bisect_left(slots, slot)
        if place < len(slots) and slots[place] == slot:
            if fresh and edge_version == 1:
                # The slot had readings that its state has forgotten.
                rows.append((infohash, at, None, version, True))
                continue
            ats[place], firsts[place], lasts[place] = at, first, last
        else:
            for values, value in ((slots, slot), (ats, at), (firsts, first), (lasts, last)):
                values.insert(place, value)
        touched.add(slot)
    for slot in touched:
        place = bisect_left(slots, slot)
        for i in (place, place + 1):
            now = (ats[i], firsts[i], lasts[i - 1] if i else None) if i < len(slots) else None
            if now and before.get(slots[i]) != now:
                before[slots[i]] = now
                rows.append((infohash, now[0], _delta(now[1], now[2]), version, False))
    return rows, [slots, ats, firsts, lasts, version]


def _edge_step(retention: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Deltas of the first readings of the slots of a bucket's keys, from the ends of the slots."""
        keys, rows = _load(state), []
        if not state.hasTimedOut:
            newest: dict[str, dict[int, tuple]] = {}
            clocks: dict[str, int] = {}
            for frame in frames:
                columns = [frame[c].tolist() for c in ("infohash", "clock", "slot", "version", "at", "first", "last", "fresh")]
                for infohash, clock, slot, *edge in zip(*columns, strict=True):
                    found = newest.setdefault(infohash, {})
                    if slot not in found or edge[0] > found[slot][0]:
                        found[slot] = tuple(edge)
                    clocks[infohash] = max(clock, clocks.get(infohash, clock))
            for infohash, edges in newest.items():
                found, values = _edge_changes_of(infohash, keys.get(infohash), edges)
                rows += found
                keys[infohash] = [*values, max(clocks[infohash], state.getCurrentWatermarkMs())]
        _keep_for(state, keys, 6, retention)
        if rows:
            yield _frame(rows, _FIRST)

    return run


def slot_changes(
    stream: DataFrame, root: str, checkpoint: str, arrived: str | None = None, slot_seconds: int = SLOT_SECONDS, lateness: str = LATENESS
) -> StreamingQuery:
    """The first of two queries: the deltas within each (key, slot of time), and the ends of slots that changed.

    The state of a key is cut into slots, so a key with a third of all readings is many tasks' work, and a
    reading, however late, meets the readings of its slot alone (a group is a bucket of keys and a slot). What a key has in
    a slot is forgotten when it gets nothing for `lateness`.
    """
    micros = F.unix_micros(utc("timestamp"))
    readings = _arrival(stream, arrived).select(
        "infohash", micros.alias("at"), F.col("downloads").cast("bigint").alias("downloads"), F.expr(_CLOCK), "arrived_"
    )
    readings = readings.dropna().withColumn("slot", F.floor(F.col("at") / (slot_seconds * 1_000_000)))
    changes = readings.withColumn("bucket", _bucket(SLOT_BUCKETS)).groupBy("bucket", "slot").applyInPandasWithState(
        _slot_step(_milliseconds(lateness)), _CHANGE, _SLOT_STATE, "append", _TIMERS
    )
    return _append(changes, f"{root}/changes", checkpoint, ("kind",))


def edge_changes(spark: SparkSession, root: str, checkpoint: str, retention: str = RETENTION) -> StreamingQuery:
    """The second query: it follows the ends of slots that the first one wrote, one row per key and slot touched, and
    gives the deltas of the slots' first readings."""
    edges = spark.readStream.schema(_CHANGE).parquet(f"{root}/changes").filter("kind = 'edge'")
    clocked = _arrival(edges, None).select("infohash", "slot", "version", "at", "first", "last", "fresh", F.expr(_CLOCK), "arrived_")
    first = clocked.withColumn("bucket", _bucket()).groupBy("bucket").applyInPandasWithState(
        _edge_step(_milliseconds(retention)), _FIRST, _KEY_STATE, "append", _TIMERS
    )
    return _append(first, f"{root}/first", checkpoint)


def incremental_deltas(stream: DataFrame, root: str, checkpoint: str, **parameters) -> tuple[StreamingQuery, StreamingQuery]:
    """Take in what there is: both queries, one after the other. Of readings of one time the highest in a batch counts,
    and the newest batch; readings without a count are none."""
    first = slot_changes(stream, root, f"{checkpoint}/slots", **parameters)
    first.awaitTermination()
    second = edge_changes(stream.sparkSession, root, f"{checkpoint}/edges")
    second.awaitTermination()
    return first, second


def delta_changes(spark: SparkSession, root: str) -> DataFrame:
    """(infohash, timestamp, downloads_delta, version) of all changes. A reading can stop being the first of
    its slot, but not become it again, so changes within slots are newer than those between them."""
    inside = appended(spark, f"{root}/changes", _CHANGE).filter("kind = 'delta'")
    first = appended(spark, f"{root}/first", _FIRST).filter("NOT late")
    row = ["infohash", F.timestamp_micros("at").alias("timestamp"), F.col("value").alias("downloads_delta")]
    version = lambda n: F.struct(F.lit(n).alias("within"), "version").alias("version")
    return inside.select(*row, version(1)).union(first.select(*row, version(0)))


def emitted_deltas(spark: SparkSession, root: str) -> DataFrame:
    """What the stream has found so far, one row per reading."""
    rows = delta_changes(spark, root)
    return last_per_key(rows, ["infohash", "timestamp"], [F.col("version")]).drop("version")


def keys_to_recount(spark: SparkSession, root: str) -> DataFrame:
    """Keys with readings that came after their slot was forgotten: a batch over their readings is needed."""
    return appended(spark, f"{root}/first", _FIRST).filter("late").select("infohash").distinct()


# ---- dead keys --------------------------------------------------------------

_RECENT = (
    "infohash array<string>, at array<array<bigint>>, seeders array<array<int>>, leechers array<array<int>>, "
    "downloads array<array<bigint>>, is_dead array<boolean>, version array<bigint>, seen array<bigint>"
)
_VERDICT = "infohash string, is_dead boolean, version bigint"
_COUNTERS = ("seeders", "leechers", "downloads")


def _arrive(arrived: dict[int, tuple], row: tuple) -> None:
    """Add a reading of (at, seeders, leechers, downloads) to those of its key in a batch, of which the newest are kept;
    of one time the one with most downloads counts."""
    if row[0] not in arrived or row[3] > arrived[row[0]][3]:
        arrived[row[0]] = row
        if len(arrived) > 100:
            for old in sorted(arrived)[:-DEAD_AFTER]:
                del arrived[old]


def _newest(columns: list[list], arrived: dict[int, tuple]) -> list[tuple]:
    """The newest readings, newest first, of those kept (as columns) and those of a batch, which count for their time."""
    merged = {r[0]: r for r in zip(*columns, strict=True)} | arrived
    return [merged[t] for t in sorted(merged, reverse=True)[:DEAD_AFTER]]


def _columns(recent: list[tuple]) -> list[list]:
    return [list(c) for c in zip(*recent, strict=True)] or [[], [], [], []]


def _all_zero(recent: list[tuple]) -> bool:
    return len(recent) == DEAD_AFTER and all(n == 0 for r in recent for n in r[1:])


def _liveness_step(retention: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, rows = _load(state), []
        if not state.hasTimedOut:
            arrived: dict[str, dict[int, tuple]] = {}
            clocks: dict[str, int] = {}
            for frame in frames:
                columns = [frame[c].tolist() for c in ("infohash", "clock", "at", *_COUNTERS)]
                for infohash, clock, *reading in zip(*columns, strict=True):
                    _arrive(arrived.setdefault(infohash, {}), tuple(reading))
                    clocks[infohash] = max(clock, clocks.get(infohash, clock))
            for infohash, readings in arrived.items():
                *columns, was_dead, version, _ = keys.get(infohash, ([], [], [], [], False, 0, 0))
                recent = _newest(columns, readings)
                is_dead = _all_zero(recent)
                if is_dead != was_dead:
                    version += 1
                    rows.append((infohash, is_dead, version))
                keys[infohash] = [*_columns(recent), is_dead, version, max(clocks[infohash], state.getCurrentWatermarkMs())]
        _keep_for(state, keys, 7, retention)
        if rows:
            yield _frame(rows, _VERDICT)

    return run


def dead_detection(
    stream: DataFrame, root: str, checkpoint: str, arrived: str | None = None, retention: str = RETENTION
) -> StreamingQuery:
    """Under ``root`` the keys whose three newest readings have become all zero, or are so no more. State is
    those readings; missing counters count as 0."""
    counters = [F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c) for c, t in zip(_COUNTERS, ("int", "int", "bigint"), strict=True)]
    at = F.unix_micros(utc("timestamp")).alias("at")
    readings = _arrival(stream, arrived).select("infohash", at, *counters, F.expr(_CLOCK), "arrived_").dropna()
    verdicts = readings.withColumn("bucket", _bucket()).groupBy("bucket").applyInPandasWithState(
        _liveness_step(_milliseconds(retention)), _VERDICT, _RECENT, "append", _TIMERS
    )
    return _append(verdicts, root, checkpoint)


def recent_readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The readings that the dead detection holds, read from its state."""
    rows = state_rows(spark, checkpoint, f"key struct<bucket: int>, value struct<groupState: struct<{_RECENT.replace(' array', ': array')}>>")
    keys = rows.select(F.inline(F.arrays_zip(*[f"value.groupState.{c}" for c in ("infohash", "at", *_COUNTERS)])))
    kept = keys.select("infohash", F.inline(F.arrays_zip("at", *_COUNTERS)))
    return kept.select("infohash", F.timestamp_micros("at").alias("timestamp"), *_COUNTERS)


def dead_now(spark: SparkSession, root: str) -> DataFrame:
    """Keys whose newest verdict is that they are dead."""
    return last_per_key(appended(spark, root, _VERDICT), ["infohash"], [F.col("version")]).filter("is_dead").select("infohash")


# ---- due items --------------------------------------------------------------

_ITEM = "items binary"
_DUE = "infohash string, at bigint, is_due boolean, status string, version bigint"
# A number that is missing.
_NONE = int(np.iinfo(np.int64).min)


def due_at(status: str, pubdate: int | None, last: int | None, now: int) -> bool:
    """Whether an active item is due: never read, or the gap of its age class has passed. Seconds."""
    if status != "active" or pubdate is None:
        return False
    if last is None:
        return True
    for limit, _, gap in AGE_CLASSES:
        if now - pubdate <= limit:
            return now - last >= gap
    return False


def next_change(status: str, pubdate: int | None, last: int | None, now: int) -> int | None:
    """The first second after ``now`` at which the item becomes due or ceases to be, if nothing is read."""
    if status != "active" or pubdate is None or last is None:
        return None
    if now - pubdate > AGE_CLASSES[-1][0]:
        return None
    is_due = due_at(status, pubdate, last, now)
    times = sorted({pubdate + limit + 1 for limit, _, _ in AGE_CLASSES} | {last + gap for _, _, gap in AGE_CLASSES})
    return next((t for t in times if t > now and due_at(status, pubdate, last, t) != is_due), None)


def _are_due(active: np.ndarray, pubdate: np.ndarray, last: np.ndarray, now: np.ndarray) -> np.ndarray:
    """:func:`due_at` of many items."""
    age, gap = now - pubdate, now - last
    passed = np.zeros(len(now), dtype=bool)
    for limit, _, needed in reversed(AGE_CLASSES):
        passed = np.where(age <= limit, gap >= needed, passed)
    return active & (pubdate != _NONE) & ((last == _NONE) | passed)


def _next_changes(active: np.ndarray, pubdate: np.ndarray, last: np.ndarray, now: np.ndarray) -> np.ndarray:
    """:func:`next_change` of many items."""
    result = np.full(len(now), _NONE)
    waiting = np.flatnonzero(active & (pubdate != _NONE) & (last != _NONE) & (now - pubdate <= AGE_CLASSES[-1][0]))
    active, pubdate, last, now = (a[waiting] for a in (active, pubdate, last, now))
    is_due, never = _are_due(active, pubdate, last, now), np.iinfo(np.int64).max
    found = np.full(len(now), never)
    for t in [pubdate + limit + 1 for limit, _, _ in AGE_CLASSES] + [last + gap for _, _, gap in AGE_CLASSES]:
        sooner = (t > now) & (t < found) & (_are_due(active, pubdate, last, t) != is_due)
        found = np.where(sooner, t, found)
    result[waiting] = np.where(found == never, _NONE, found)
    return result


class _Items:
    """The state of a bucket's items, a row each, and the moments at which their answers change. It is kept as one
    compressed Arrow table, so that a batch moves few bytes an item and calls Python for none."""

    # Of the three newest readings, newest first; a missing one has no time.
    READINGS = {"at": np.int64, "seeders": np.int64, "leechers": np.int64, "downloads": np.int64}
    COLUMNS = {
        "infohash": (object, None), "status": (object, "active"), "pubdate": (np.int64, _NONE), "last": (np.int64, _NONE),
        **{f"{c}{i}": (t, _NONE if c == "at" else 0) for c, t in READINGS.items() for i in range(DEAD_AFTER)},
        "is_due": (bool, False), "clock": (np.int64, _NONE), "version": (np.int64, 0), "following": (np.int64, _NONE),
    }

    def __init__(self, stored: bytes | None) -> None:
        if stored is None:
            self.columns = {c: np.empty(0, dtype=t) for c, (t, _) in self.COLUMNS.items()}
        else:
            table = pa.ipc.open_stream(pa.py_buffer(stored)).read_all()
            # Arrow's memory can't be written to.
            self.columns = {c: table[c].to_numpy().astype(t) for c, (t, _) in self.COLUMNS.items()}
        self.changes: list[tuple[np.ndarray, ...]] = []

    def stored(self) -> bytes:
        types = {object: pa.string(), bool: pa.bool_(), np.int64: pa.int64()}
        table = pa.table({c: pa.array(v, types[self.COLUMNS[c][0]]) for c, v in self.columns.items()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def rows_of(self, infohash: np.ndarray) -> np.ndarray:
        """The row of each of the given keys; those that are new get one."""
        known = self.columns["infohash"]
        rows, keys = pd.factorize(np.concatenate([known, infohash]))
        more = len(keys) - len(known)
        for c, (t, default) in self.COLUMNS.items():
            self.columns[c] = keys if c == "infohash" else np.concatenate([self.columns[c], np.full(more, default, dtype=t)])
        return rows[len(known) :]

    def _states(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        c = self.columns
        return c["status"][rows] == "active", c["pubdate"][rows], c["last"][rows], c["clock"][rows]

    def _flip(self, rows: np.ndarray) -> None:
        """Note the answers that are others at the items' clocks."""
        c = self.columns
        now = _are_due(*self._states(rows))
        other = now != c["is_due"][rows]
        rows = rows[other]
        c["is_due"][rows] = now[other]
        c["version"][rows] += 1
        self.changes.append(tuple(c[x][rows] for x in ("infohash", "clock", "is_due", "status", "version")))

    def run_to(self, rows: np.ndarray, now: np.ndarray) -> None:
        """What happened since the last look by the passing of time alone."""
        clock, following = self.columns["clock"], self.columns["following"]
        passed = (following[rows] != _NONE) & (following[rows] <= now)
        left, until = rows[passed], now[passed]
        while len(left):
            clock[left] = following[left]
            self._flip(left)
            following[left] = _next_changes(*self._states(left))
            passed = (following[left] != _NONE) & (following[left] <= until)
            left, until = left[passed], until[passed]
        clock[rows] = now

    def take(self, rows: np.ndarray, events: dict[str, np.ndarray]) -> np.ndarray:
        """A batch's events, each with its item's row; the rows that had any."""
        c = self.columns
        touched = np.unique(rows)
        now = np.where(c["clock"] == _NONE, 0, c["clock"])
        np.maximum.at(now, rows, events["arrived"])
        self.run_to(touched, now[touched])

        # The first date of an item counts, and the last status that is not active.
        dated = np.flatnonzero(events["pubdate"] != _NONE)[::-1]
        dates = np.full(len(now), _NONE)
        dates[rows[dated]] = events["pubdate"][dated]
        c["pubdate"] = np.where(c["pubdate"] == _NONE, dates, c["pubdate"])
        ended = np.flatnonzero(pd.notna(events["status"]) & (events["status"] != "active"))
        c["status"][rows[ended]] = events["status"][ended]

        read = events["at"] != _NONE
        self._read(rows[read], {name: events[name][read] for name in self.READINGS})
        dead = c[f"at{DEAD_AFTER - 1}"][touched] != _NONE
        for name in _COUNTERS:
            for i in range(DEAD_AFTER):
                dead &= c[f"{name}{i}"][touched] == 0
        dead &= c["status"][touched] == "active"
        c["status"][touched[dead]] = "dead"
        return touched

    def _read(self, rows: np.ndarray, readings: dict[str, np.ndarray]) -> None:
        """Keep the newest of the readings known and new. Of one time a new one counts, and of these that with most downloads."""
        c = self.columns
        np.maximum.at(c["last"], rows, readings["at"] // 1_000_000)
        known = np.unique(rows)
        values = {name: np.concatenate([new, *[c[f"{name}{i}"][known] for i in range(DEAD_AFTER)]]) for name, new in readings.items()}
        items = np.concatenate([rows, *[known] * DEAD_AFTER])
        # Inverted bits sort downwards; what was known comes last.
        fewest = np.concatenate([~readings["downloads"], np.full(DEAD_AFTER * len(known), np.iinfo(np.int64).max)])
        order = np.lexsort((fewest, ~values["at"], items))
        order = order[values["at"][order] != _NONE]
        item, at = items[order], values["at"][order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1])
        order, item = order[first], item[first]
        begins = np.searchsorted(item, known)
        place = np.arange(len(order)) - np.repeat(begins, np.diff([*begins, len(order)]))
        for i in range(DEAD_AFTER):
            here = place == i
            for name in readings:
                c[f"{name}{i}"][item[here]] = values[name][order[here]]

    def settle(self, rows: np.ndarray) -> None:
        """Note the answers at the items' clocks, and when they change next."""
        self._flip(rows)
        self.columns["following"][rows] = _next_changes(*self._states(rows))


def _due_step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    items = _Items(bytes(state.get[0]) if state.exists else None)
    frames = [] if state.hasTimedOut else [f for f in frames if len(f)]
    names = ("infohash", "arrived", "pubdate", "status", "at", *_COUNTERS)
    events = {c: np.concatenate([f[c].to_numpy() for f in frames]) for c in names} if frames else {}
    rows = items.rows_of(events["infohash"]) if frames else np.empty(0, dtype=np.int64)
    # The watermark is a millisecond behind the clock.
    now = (state.getCurrentWatermarkMs() + 1) // 1000
    following = items.columns["following"]
    idle = (following != _NONE) & (following <= now)
    idle[rows] = False
    idle = np.flatnonzero(idle)
    items.run_to(idle, np.full(len(idle), now))
    touched = items.take(rows, events) if frames else rows
    items.settle(np.concatenate([idle, touched]))
    if len(items.columns["infohash"]):
        state.update((items.stored(),))
        following = items.columns["following"]
        following = following[following != _NONE]
        if len(following):
            # A timer fires when the watermark is above it.
            state.setTimeoutTimestamp(max(int(following.min()) * 1000 - 2, state.getCurrentWatermarkMs() + 1))
    changes = pd.DataFrame({f.split()[0]: np.concatenate(c) for f, c in zip(_DUE.split(", "), zip(*items.changes, strict=True), strict=True)})
    if len(changes):
        yield changes


def due_changes(events: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Under ``root`` every moment at which an item becomes due or ceases to be.

    Events are torrents (infohash, pubdate, status), readings (infohash, timestamp, counters) and ticks (a null
    infohash), each with ``arrived``, in whose order they come. Each bucket has a timer for the next
    moment at which the age class of one of its keys or the gap to its last reading changes the answer; timers fire with
    the clock, rows or not. State is one row per item: its dates, its three newest readings and the last answer. An item
    whose three newest readings are all zero is dead and due no more.
    """
    clocked = events.withWatermark("arrived", "1 millisecond").filter("infohash IS NOT NULL")
    counters = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in _COUNTERS]
    times = {"pubdate": F.unix_seconds(utc("pubdate")), "at": F.unix_micros(utc("timestamp"))}
    rows = clocked.select(
        "infohash", "status", *[F.coalesce(time, F.lit(_NONE)).alias(c) for c, time in times.items()], *counters,
        F.unix_seconds("arrived").alias("arrived"), F.col("arrived").alias("clock"),
    )
    changes = rows.withColumn("bucket", _bucket()).groupBy("bucket").applyInPandasWithState(_due_step, _DUE, _ITEM, "append", _TIMERS)
    with _settings(events.sparkSession, _LARGE_STATE):
        return _append(changes, root, checkpoint)


def due_now(spark: SparkSession, root: str) -> DataFrame:
    """Items that are due at the stream's clock."""
    return last_per_key(appended(spark, root, _DUE), ["infohash"], [F.col("version")]).filter("is_due").select("infohash")


# ---- weekly totals ----------------------------------------------------------

_TOTALS = "week string, anilist_id bigint, downloads bigint"
_OPEN = "key struct<window: struct<start: timestamp, end: timestamp>, anilist_id: bigint>, value struct<sum: bigint>"


def _week(start: str) -> Column:
    return F.date_format(F.col(start) - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd").alias("week")


def _windows(deltas: DataFrame) -> DataFrame:
    """Totals per show and Sunday-to-Saturday week at UTC-5: 7-day windows whose starts are shifted to Sunday 05:00 UTC."""
    window = F.window("timestamp", "7 days", "7 days", "77 hours")
    return deltas.groupBy(window.alias("w"), "anilist_id").agg(F.sum("downloads_delta").alias("downloads"))


def _is_late(delay: str):
    wait = F.col("arrived_") - F.expr(f"INTERVAL {delay}")
    return (F.col("timestamp") < wait) | (F.col("timestamp") > F.col("arrived_"))


def weekly_totals(
    deltas: DataFrame, root: str, checkpoint: str, arrived: str | None = None, delay: str = "2 days"
) -> tuple[StreamingQuery, StreamingQuery]:
    """Totals of closed weeks under ``root/closed``, once each, and corrections for what came too late for them.

    State is the open weeks: a week is written and forgotten when the watermark, ``delay`` behind the newest
    reading, has passed its end. A reading that arrives later than ``delay`` after its time (or before it)
    goes to the corrections, partial sums per batch; all others are in time for their week, since the
    watermark can't have passed them.
    """
    clock = F.col(arrived) if arrived else F.current_timestamp()
    timed = deltas.withColumn("timestamp", utc("timestamp")).withColumn("arrived_", clock.cast("timestamp"))
    in_time = timed.filter(~_is_late(delay)).withWatermark("timestamp", delay)
    closed = _append(_windows(in_time).select(_week("w.start"), "anilist_id", "downloads"), f"{root}/closed", f"{checkpoint}/closed")

    def correct(batch: DataFrame, batch_id: int) -> None:
        sums = _windows(batch).select(_week("w.start"), "anilist_id", "downloads")
        sums.write.mode("overwrite").parquet(f"{root}/corrections/batch={batch_id}")

    corrections = _start(timed.filter(_is_late(delay)).writeStream.foreachBatch(correct), f"{checkpoint}/corrections")
    for query in (closed, corrections):
        query.awaitTermination()
    return closed, corrections


def closed_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals of the closed weeks as they were written."""
    return appended(spark, f"{root}/closed", _TOTALS)


def current_totals(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """Closed weeks with their corrections, and the open weeks, read from the state."""
    corrections = appended(spark, f"{root}/corrections", _TOTALS + ", batch bigint").drop("batch")
    still = state_rows(spark, f"{checkpoint}/closed", _OPEN).select(_week("key.window.start"), "key.anilist_id", F.col("value.sum").alias("downloads"))
    rows = closed_totals(spark, root).unionByName(corrections).unionByName(still)
    return rows.groupBy("week", "anilist_id").agg(F.sum("downloads").alias("downloads"))
