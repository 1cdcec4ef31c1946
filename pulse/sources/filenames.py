"""Release names to metadata, for the common ways such names are written:
``[Group] Title - 05 [1080p].mkv``, ``[Group] Title S02E05``, batches ``01-12``.

An own definition on SQL regular expressions, as successive projections: each
pattern is matched once per name, in generated code. Null when no pattern fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTAINER = r"\.(mkv|mp4|avi|ts|m2ts|webm)$"
_RESOLUTION = r"(?i)\b(\d{3,4}p|\d{3,4}x\d{3,4}|4k)\b"
_GROUP = r"^\[([^\]]+)\]"
_SEASON_EPISODE = r"(?i)\bS(\d{1,2})\s?E(\d{1,4})\b"
_RANGE = r"(?:-\s*|\b)(\d{1,4})\s*[-~]\s*(\d{1,4})(?:\s*$|\s*[\[(])"
_DASH_EPISODE = r"\s-\s+(\d{1,4})(?:v\d+)?(?:\s|$|\[|\()"
_TITLE_SEASON = r"(?i)\s(?:S(\d{1,2})|(\d{1,2})(?:st|nd|rd|th) Season|Season (\d{1,2}))$"


def _group(text: Column, pattern: str, index: int = 1) -> Column:
    """A group of the first match, null without a match: no group here can be empty."""
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def _number(text: Column, pattern: str, index: int = 1) -> Column:
    return _group(text, pattern, index).try_cast("int")


def with_parsed(rows: DataFrame, filename: str, out: str = "p") -> DataFrame:
    """Add a struct of title, season, episode(s), release_group, screen_size, container."""
    work = [f"_{out}_{n}" for n in ("bare", "body", "first", "last", "season", "number", "batch", "head")]
    bare, body, first, last, season, number, batch, head = work
    name = F.regexp_replace(filename, "(?i)" + _CONTAINER, "")
    steps = rows.withColumn(bare, F.trim(F.replace(name, F.lit("_"), F.lit(" "))))
    steps = steps.withColumn(body, F.trim(F.regexp_replace(bare, _GROUP, "")))
    text = F.col(body)
    # One test before the groups of a pattern that most names don't have.
    ranged, seasoned = text.rlike(_RANGE), text.rlike(_SEASON_EPISODE)
    steps = steps.withColumns(
        {
            first: F.when(ranged, _number(text, _RANGE, 1)),
            season: F.when(seasoned, _number(text, _SEASON_EPISODE, 1)),
        }
    )
    later = F.when(F.col(season).isNotNull(), _number(text, _SEASON_EPISODE, 2))
    steps = steps.withColumns(
        {
            last: F.when(F.col(first).isNotNull(), _number(text, _RANGE, 2)),
            number: F.coalesce(later, _number(text, _DASH_EPISODE)),
        }
    )
    steps = steps.withColumn(batch, F.coalesce(F.col(last) > F.col(first), F.lit(False)))
    before = (
        F.when(F.col(season).isNotNull(), F.regexp_replace(text, _SEASON_EPISODE + r".*$", ""))
        .when(F.col(batch), F.regexp_replace(text, _RANGE + r".*$", ""))
        .otherwise(F.regexp_replace(text, _DASH_EPISODE + r".*$", ""))
    )
    steps = steps.withColumn(head, F.trim(F.regexp_replace(before, r"\s*[\[(].*$|\s*-\s*$", "")))
    marked = F.col(head).rlike(_TITLE_SEASON)
    named = F.when(marked, F.coalesce(*[_number(F.col(head), _TITLE_SEASON, i) for i in (1, 2, 3)]))
    parts = F.struct(
        F.when(marked, F.trim(F.regexp_replace(head, _TITLE_SEASON, ""))).otherwise(F.col(head)).alias("title"),
        F.coalesce(F.col(season), named).alias("season"),
        F.when(~F.col(batch), F.col(number)).alias("episode"),
        F.when(F.col(batch), F.sequence(first, last)).alias("episodes"),
        _group(F.col(bare), _GROUP).alias("release_group"),
        _group(F.col(bare), _RESOLUTION).alias("screen_size"),
        F.lower(_group(F.col(filename), "(?i)" + _CONTAINER)).alias("container"),
    )
    parsed = steps.withColumn(out, parts).drop(*work)
    return parsed.withColumn(out, F.when(F.coalesce(F.col(f"{out}.title"), F.lit("")) != "", F.col(out)))


_TAGS = ("release_group", "screen_size", "container")


def with_metadata(rows: DataFrame, filename: str, out: str) -> DataFrame:
    """Add the parsed name as JSON; a batch writes ``episode`` as a list."""
    parsed = with_parsed(rows, filename, "_p")

    def record(episode: str) -> Column:
        return F.to_json(
            F.struct(
                F.col("_p.title").alias("title"),
                F.col("_p.season").alias("season"),
                F.col(f"_p.{episode}").alias("episode"),
                *[F.col(f"_p.{t}").alias(t) for t in _TAGS],
            )
        )

    json = F.when(F.col("_p.episodes").isNotNull(), record("episodes")).when(
        F.col("_p.title").isNotNull(), record("episode")
    )
    return parsed.withColumn(out, json).drop("_p")
