"""Feed documents (XML items) to torrent rows with their first reading."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.numbers import feed_size
from pulse.functions.text import last_path_number
from pulse.functions.times import rfc822
from pulse.schema import FEED_ITEM
from pulse.sources.filenames import with_metadata

ROW = (
    "infohash", "filename", "pubdate", "size_bytes", "source_id", "trusted", "remake",
    "guessit_data", "seeders", "leechers", "downloads",
)


def parse_items(documents: DataFrame, column: str) -> DataFrame:
    """The fields of one item per row. The parse stands behind a generator, so that no filter or field read later
    repeats it."""
    return documents.select(F.inline(F.array(F.from_xml(column, FEED_ITEM))))


_XML = {"rowTag": "item", "ignoreNamespace": "true"}


def read_feed(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    return feed_rows(spark.read.format("xml").options(**_XML).schema(FEED_ITEM).load(path), now)


def stream_feed(spark: SparkSession, path: str, files: int = 100, named: bool = True) -> DataFrame:
    """The rows of feed documents as they arrive in a folder; an unreadable date becomes the time of the batch."""
    reader = spark.readStream.format("xml").options(**_XML).schema(FEED_ITEM).option("maxFilesPerTrigger", files)
    return feed_rows(reader.load(path), named=named)


def _count(column: str) -> Column:
    """Missing counts as 0; present but unreadable is null and drops the item."""
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.trim(column).try_cast("bigint"))


def feed_rows(items: DataFrame, now: datetime | None = None, named: bool = True) -> DataFrame:
    """The items that can be used; ``named`` parses their names, which costs more than all else and can wait
    (:func:`with_names`) until items listed again are gone."""
    read_at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    counts = ("seeders", "leechers", "downloads")
    name = F.trim("title")
    rows = items.select(
        F.lower(F.trim("infoHash")).alias("infohash"),
        name.alias("filename"),
        rfc822(F.col("pubDate"), read_at).alias("pubdate"),
        feed_size(F.coalesce(F.nullif("size", F.lit("")), F.lit("0 B"))).alias("size_bytes"),
        last_path_number(F.trim("guid")).alias("source_id"),
        (F.coalesce("trusted", F.lit("No")) == "Yes").alias("trusted"),
        (F.coalesce("remake", F.lit("No")) == "Yes").alias("remake"),
        *[_count(c).alias(c) for c in counts],
    )
    readable = F.lit(True)
    for c in counts:
        readable = readable & F.col(c).isNotNull()
    kept = rows.filter(
        (F.coalesce("infohash", F.lit("")) != "") & (F.coalesce("filename", F.lit("")) != "") & readable
    )
    return with_names(kept).select(*ROW) if named else kept


def with_names(rows: DataFrame) -> DataFrame:
    """The rows with their parsed names."""
    return with_metadata(rows, "filename", "guessit_data")


def failed_names(rows: DataFrame) -> DataFrame:
    """Keys whose name could not be parsed; to be marked if already stored."""
    return rows.filter(F.col("guessit_data").isNull()).select("infohash").distinct()
