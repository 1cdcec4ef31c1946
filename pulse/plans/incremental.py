"""The weekly tables kept up to date by what changed, in place of a full recompute.

Stored under one root: the deltas by day, the torrents' episodes (`dims`), the episode series by a digit of the show, and
the weekly rankings by week. An update takes the deltas that are new or have changed and the torrents as they are
now. Changed deltas change the buckets they fall into; an episode whose torrents or first release have changed
is built again from its own deltas. From the series rows of those episodes before and after follow the weeks whose
totals change, and only these weeks are read, ranked and written.

An update has a number. What it will write is staged first, then moved over the old partitions, and marked done at the
end: run again after a crash it goes on from its stage, and run again when done it does nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.functions.times import hours_since, time_bucket, week_label
from pulse.operators.ranking import weekly_rankings
from pulse.operators.store import last_per_key
from pulse.session import cut, literal_rows

_EPISODE = ["anilist_id", "episode"]
_BUCKET = [*_EPISODE, "time_bucket_hours"]
_TABLES = {
    "deltas": ("infohash string, timestamp timestamp, downloads_delta bigint, version bigint", "day date"),
    "dims": ("infohash string, anilist_id bigint, episode bigint, first_datetime timestamp", "digit string"),
    "series": (
        "anilist_id bigint, episode bigint, time_bucket_hours bigint, first_datetime timestamp, period_start timestamp, "
        "downloads_daily bigint, downloads_cumulative bigint, days_since_first_torrent double, date date", "digit string",
    ),
    "weeks": ("anilist_id bigint, downloads bigint, buckets bigint, rank bigint", "week string"),
}


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return literal_rows(spark, [], schema)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    columns = ", ".join(_TABLES[name])
    return _read(spark, f"{root}/{name}", columns).filter(F.col(columns.split()[0]).isNotNull())


def _with_empty_partitions(rows: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """With a row of nulls in each touched partition, so that one that has lost all its rows is replaced too."""
    return rows.unionByName(touched.select(partition).distinct(), allowMissingColumns=True)


def _digit(key: str) -> Column:
    return F.substring(F.sha1(F.col(key).cast("string")), 1, 1)


def _present(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.schema("id bigint").parquet(path).count() > 0
    except AnalysisException:
        return False


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).write.mode("overwrite").parquet(path)


def _replace(rows: DataFrame, path: str, partition: str) -> None:
    """Write the rows over the partitions they are in; all other partitions keep their files."""
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def _changed_deltas(spark: SparkSession, root: str, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are newer than what is stored, with what they replace, and the days they are on."""
    newest = last_per_key(changes, ["infohash", "timestamp"], [F.col("version")])
    arrived = cut(newest.select("infohash", "timestamp", "downloads_delta", "version", F.to_date("timestamp").alias("day")))
    days = arrived.select("day").distinct()
    stored = table(spark, root, "deltas").join(days, "day", "left_semi")
    old = stored.select("infohash", "timestamp", "day", F.col("downloads_delta").alias("old_delta"), F.col("version").alias("old_version"))
    met = arrived.join(old, ["infohash", "timestamp", "day"], "left")
    fresh = cut(met.filter(F.col("old_version").isNull() | (F.col("version") > F.col("old_version"))).drop("old_version"))
    merged = stored.join(fresh, ["infohash", "timestamp", "day"], "left_anti").unionByName(fresh.drop("old_delta"))
    return fresh, merged


def _buckets(rows: DataFrame, value: Column) -> DataFrame:
    bucket = time_bucket(hours_since(F.col("timestamp"), F.col("first_datetime"))).cast("bigint")
    return rows.withColumn("time_bucket_hours", bucket).groupBy(*_BUCKET, "first_datetime").agg(
        F.sum(value).alias("downloads_daily"), F.min("timestamp").alias("period_start")
    )


def _with_running_totals(buckets: DataFrame) -> DataFrame:
    running = Window.partitionBy(*_EPISODE).orderBy("time_bucket_hours").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return buckets.select(
        *_BUCKET, "first_datetime", "period_start", "downloads_daily",
        F.sum("downloads_daily").over(running).alias("downloads_cumulative"),
        (F.col("time_bucket_hours") / 24).alias("days_since_first_torrent"), F.to_date("period_start").alias("date"),
        _digit("anilist_id").alias("digit"),
    )


def _per_week(series: DataFrame, sign: int) -> DataFrame:
    return series.groupBy(week_label(F.col("period_start")).alias("week"), "anilist_id").agg(
        (F.sum("downloads_daily") * sign).alias("downloads"), (F.count(F.lit(1)) * sign).alias("buckets")
    )


def _stage(spark: SparkSession, root: str, stage: str, dims: DataFrame, changes: DataFrame) -> None:
    dims = cut(dims.select("infohash", "anilist_id", "episode", "first_datetime"))
    known = table(spark, root, "dims").drop("digit")
    # Episodes that got, lost or share a torrent that is not as it was.
    same = known.join(dims, dims.columns, "left_semi")
    differ = dims.join(same, "infohash", "left_anti").unionByName(known.join(same, "infohash", "left_anti"))
    moved = cut(differ.select(*_EPISODE).distinct())

    fresh, days = _changed_deltas(spark, root, changes)
    steady = fresh.join(dims, "infohash").join(moved, _EPISODE, "left_anti")
    added = cut(_buckets(steady, F.col("downloads_delta") - F.coalesce("old_delta", F.lit(0))))
    # All deltas of the moved episodes: those stored since the first of their releases, and those that this update brings.
    moving = cut(dims.join(moved, _EPISODE, "left_semi"))
    since = moving.agg(F.min(F.to_date("first_datetime"))).first()[0]
    brought = fresh.select("infohash", "timestamp", "downloads_delta")
    stored = table(spark, root, "deltas").filter(F.col("day") >= F.lit(since)).select("infohash", "timestamp", "downloads_delta")
    stored = stored.join(moving.select("infohash"), "infohash", "left_semi").join(brought, ["infohash", "timestamp"], "left_anti")
    rebuilt = _buckets(stored.unionByName(brought).join(moving, "infohash"), F.col("downloads_delta"))

    touched = cut(added.select(*_EPISODE).distinct().unionByName(moved).withColumn("digit", _digit("anilist_id")))
    series = table(spark, root, "series")
    before = cut(series.join(touched, [*_EPISODE, "digit"], "left_semi"))
    steady_before = before.join(moved, _EPISODE, "left_anti").select(*added.columns)
    merged = steady_before.unionByName(added).groupBy(*_BUCKET, "first_datetime").agg(
        F.sum("downloads_daily").alias("downloads_daily"), F.min("period_start").alias("period_start")
    )
    after = cut(_with_running_totals(merged.unionByName(rebuilt.select(*merged.columns))))

    change = _per_week(after, 1).unionByName(_per_week(before, -1)).groupBy("week", "anilist_id").agg(
        F.sum("downloads").alias("downloads"), F.sum("buckets").alias("buckets")
    )
    change = cut(change.filter("downloads <> 0 OR buckets <> 0"))
    # Weeks are at most 53 a year.
    weeks = [r["week"] for r in change.select("week").distinct().collect()]
    listed = table(spark, root, "weeks").filter(F.col("week").isin(weeks)).select("week", "anilist_id", "downloads", "buckets")
    totals = listed.unionByName(change).groupBy("week", "anilist_id").agg(
        F.sum("downloads").alias("downloads"), F.sum("buckets").alias("buckets")
    )
    ranked = weekly_rankings(totals.filter("buckets > 0"))

    digits = touched.select("digit").distinct()
    others = series.join(digits, "digit", "left_semi").join(touched, [*_EPISODE, "digit"], "left_anti")
    week_rows = literal_rows(spark, [(w,) for w in weeks], "week string")
    torrents = dims.withColumn("digit", _digit("infohash"))
    staged = {
        "deltas": days, "series": _with_empty_partitions(others.unionByName(after.select(*others.columns)), digits, "digit"),
        "weeks": _with_empty_partitions(ranked, week_rows, "week"),
        "dims": _with_empty_partitions(torrents, torrents.select("digit").union(table(spark, root, "dims").select("digit")), "digit"),
    }
    for name, rows in staged.items():
        columns = [c.split()[0] for c in ", ".join(_TABLES[name]).split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(f"{stage}/{name}")
    week_rows.write.mode("overwrite").parquet(f"{stage}/touched_weeks")


def _apply(spark: SparkSession, root: str, stage: str) -> None:
    for name, (columns, partition) in _TABLES.items():
        rows = _read(spark, f"{stage}/{name}", f"{columns}, {partition}")
        _replace(rows, f"{root}/{name}", partition.split()[0])


def update(spark: SparkSession, root: str, number: int, dims: DataFrame, changes: DataFrame) -> None:
    """Bring the tables under ``root`` up to date.

    ``dims``: every matched torrent (infohash, anilist_id, episode, first_datetime). ``changes``: (infohash, timestamp,
    downloads_delta, version), the deltas that are new or differ from before; of one reading the highest
    version counts, also against what is stored. Updates are numbered from 0. A torrent is first read when it is
    published, so no reading is older than the first release of its episode.
    """
    stage = f"{root}/updates/{number}"
    if _present(spark, f"{stage}/done"):
        return
    if not _present(spark, f"{stage}/ready"):
        _stage(spark, root, stage, dims, changes)
        _mark(spark, f"{stage}/ready")
    _apply(spark, root, stage)
    _mark(spark, f"{stage}/done")


def rankings(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "weeks").select("week", "anilist_id", "downloads", "rank")


def series(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "series").drop("digit")


def touched_weeks(spark: SparkSession, root: str, number: int) -> DataFrame:
    """The weeks that an update has ranked again."""
    return _read(spark, f"{root}/updates/{number}/touched_weeks", "week string")
