"""Survey rows to catalogue shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.numbers import weighted_mean
from pulse.functions.ratios import fold_width
from pulse.functions.text import strip_symbols
from pulse.operators.similarity import containing_pairs
from pulse.operators.store import first_per_key
from pulse.rules import SURVEY_MATCH_THRESHOLD
from pulse.session import cut, literal_rows
from pulse.sources.surveys import PERCENTAGES


def folded(df: DataFrame, column: str) -> DataFrame:
    """Distinct texts with their normal form; empty forms are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .select(column)
        .distinct()
        .withColumn("norm", strip_symbols(fold_width(F.col(column))))
        .filter(F.col("norm") != "")
    )


def survey_targets(titles: DataFrame, shows: DataFrame, title_map: DataFrame, threshold: int) -> DataFrame:
    """Survey title to show: listed title, then any equal name (the first show in
    catalogue order has it), then the most alike native title. Normal forms come from Python and are read by several
    joins, so they and what is left to compare are stored."""
    norms = cut(folded(titles, "title"))
    names = shows.select(
        "anilist_id",
        "show_seq",
        F.explode(
            F.concat(
                F.array("title_native", "title_romaji", "title_english"),
                F.coalesce("synonyms", F.array().cast("array<string>")),
            )
        ).alias("name"),
    )
    first = F.min(F.struct("show_seq", "anilist_id"))
    exact = (
        names.join(folded(names, "name"), "name")
        .groupBy("norm")
        .agg(first.alias("_show"))
        .select("norm", F.col("_show.anilist_id").alias("exact_id"))
    )
    listed = (
        title_map.join(folded(title_map, "title"), "title")
        .groupBy("norm")
        .agg(F.max("listed_id").alias("listed_id"))
    )
    known = cut(norms.join(listed, "norm", "left").join(exact, "norm", "left"))
    open_norms = (
        known.filter(F.coalesce("listed_id", "exact_id").isNull()).select("norm").distinct()
    )
    native = cut(
        shows.join(folded(shows, "title_native"), "title_native")
        .groupBy(F.col("norm").alias("native"))
        .agg(first.alias("_show"))
        .select("native", "_show.*")
    )
    alike = (
        containing_pairs(cut(open_norms), native, "norm", "native", threshold)
        .groupBy("norm")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "show_seq", "anilist_id")).alias("_best"))
        .select("norm", F.col("_best.anilist_id").alias("alike_id"))
    )
    target = F.coalesce("listed_id", "exact_id", "alike_id").alias("anilist_id")
    return known.join(alike, "norm", "left").select("title", target)


def match_surveys(
    rows: DataFrame,
    shows: DataFrame,
    title_map: DataFrame,
    threshold: int = SURVEY_MATCH_THRESHOLD,
) -> DataFrame:
    """One row per (show, episode), from the earliest broadcast; rows without a
    show are left out. ``title_map`` lists (title, listed_id)."""
    targets = survey_targets(rows, shows, title_map, threshold)
    placed = rows.join(targets.filter(F.col("anilist_id").isNotNull()), "title")
    earliest = first_per_key(
        placed.select("anilist_id", "episode", "aired_at", "title", *PERCENTAGES),
        ["anilist_id", "episode"],
        [F.col("aired_at"), F.col("title")],
    )
    return earliest.select(
        "anilist_id",
        "episode",
        *PERCENTAGES,
        weighted_mean([F.col(p) for p in PERCENTAGES]).alias("mean_score"),
    )


def title_map(spark: SparkSession, entries: dict[str, int] | None = None) -> DataFrame:
    return literal_rows(spark, (entries or {}).items(), "title string, listed_id bigint")
