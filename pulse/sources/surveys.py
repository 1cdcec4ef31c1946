"""Episode survey CSV: regular broadcasts with a plain episode number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.text import season_code

# Column headers and the broadcast kind that is kept.
SEASON, TITLE, EPISODE, KIND, AIRED = "シーズン", "タイトル", "話", "種別", "放送日時"
ANSWERS = ("1", "2", "3", "4", "5")
REGULAR = "通常"
PERCENTAGES = ("very_good_pct", "good_pct", "normal_pct", "bad_pct", "very_bad_pct")


def read_surveys(spark: SparkSession, path: str) -> DataFrame:
    """Exports with a header line. A record is one line, so that a large file is many tasks."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    return survey_rows(raw)


def _digits(text: Column) -> Column:
    ascii_digits = F.translate(text, "０１２３４５６７８９", "0123456789")
    return F.when(ascii_digits.rlike(r"^\d+$"), ascii_digits.try_cast("bigint"))


def survey_rows(raw: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))

    return (
        raw.filter(F.col(f"`{KIND}`") == REGULAR)
        .select(
            text(SEASON).alias("season_code"),
            text(TITLE).alias("title"),
            _digits(text(EPISODE)).alias("episode"),
            text(AIRED).alias("aired_at"),
            *[
                F.nullif(text(a), F.lit("")).try_cast("double").alias(p)
                for a, p in zip(ANSWERS, PERCENTAGES, strict=True)
            ],
        )
        .filter(F.col("episode").isNotNull() & (F.col("title") != ""))
    )


def of_seasons(rows: DataFrame, seasons: DataFrame) -> DataFrame:
    """Rows whose season code belongs to one of the seasons."""
    codes = seasons.select(season_code(F.col("season"), F.col("year")).alias("season_code")).distinct()
    return rows.join(codes, "season_code", "left_semi")
