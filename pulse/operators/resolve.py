"""Free-text titles to catalogue entries.

Order of decision per title: episode range, override, best similarity (with a
season bonus), then the same without bonus on the part before ``" - "``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.text import (
    is_informative,
    normalize_title,
    sort_tokens,
    title_before_dash,
)
from pulse.operators.similarity import BEST_CUTS, best_ratios, similar_pairs
from pulse.rules import MATCH_THRESHOLD, SEASON_BONUS
from pulse.session import cut, cut_counted, literal_rows

METHODS = ("episode_range", "manual_override", "season_aware", "fuzzy", "unmatched")
_DECISION = (
    "struct<anilist_id:bigint,score:double,method:string,season_matched:bigint,matched_title:string>"
)


def title_variants(shows: DataFrame) -> DataFrame:
    """Distinct informative normalised names of every show."""
    names = F.concat(
        F.array("title_romaji", "title_english"),
        F.coalesce("synonyms", F.array().cast("array<string>")),
    )
    variants = F.array_distinct(
        F.filter(
            F.transform(names, normalize_title), lambda v: v.isNotNull() & is_informative(v)
        )
    )
    return shows.select("anilist_id", "show_seq", F.explode(variants).alias("variant"))


def bonus_seasons(shows: DataFrame) -> DataFrame:
    """(show, season) pairs whose romaji title names that season.

    The season number is looked for as plain text, so "season 1" is also found
    in "season 10" and "2th season" in "12th season": all beginnings of the
    digits after "season", all endings of those before "nd/rd/th season".
    """
    title = F.lower("title_romaji")
    after = F.transform(
        F.regexp_extract_all(title, F.lit(r"season (\d+)"), F.lit(1)),
        lambda d: F.transform(F.sequence(F.lit(1), F.length(d)), lambda n: F.substring(d, F.lit(1), n)),
    )
    before = F.transform(
        F.regexp_extract_all(title, F.lit(r"(\d+)(?:nd|rd|th) season"), F.lit(1)),
        lambda d: F.transform(F.sequence(F.lit(1), F.length(d)), lambda n: F.substring(d, n, F.length(d))),
    )
    digits = F.filter(
        F.array_distinct(F.flatten(F.concat(after, before))), lambda d: d.rlike(r"^(0|[1-9]\d{0,17})$")
    )
    return shows.filter(F.coalesce("format", F.lit("")) != "").select(
        "anilist_id", F.explode(F.transform(digits, lambda d: d.cast("bigint"))).alias("season")
    )


def _decision(show: Column, score: Column, method: Column, season: Column, title: Column) -> Column:
    return F.struct(
        show.alias("anilist_id"),
        score.cast("double").alias("score"),
        method.alias("method"),
        season.cast("bigint").alias("season_matched"),
        title.alias("matched_title"),
    )


def range_rules(ranges: DataFrame, shows: DataFrame) -> DataFrame:
    """Ranges of listed shows, as one array per title in rule order."""
    listed = ranges.join(
        shows.select(F.col("anilist_id").alias("range_id"), F.col("title_romaji").alias("range_title")),
        "range_id",
    )
    rule = F.struct("rule_seq", "min_episode", "max_episode", "range_id", "range_title")
    return listed.groupBy("normalized").agg(F.array_sort(F.collect_list(rule)).alias("_ranges"))


def range_target(episode: Column, ranges: Column) -> Column:
    """The first range that holds the episode; its ``range_id`` is the show."""
    hit = F.filter(ranges, lambda r: (r["min_episode"] <= episode) & (episode <= r["max_episode"]))
    return F.get(hit, F.lit(0))


def override_rules(overrides: DataFrame, shows: DataFrame) -> DataFrame:
    """Overrides whose target the catalogue has."""
    named = shows.select(
        F.col("anilist_id").alias("override_id"), F.col("title_romaji").alias("override_title")
    )
    return overrides.join(named, "override_id")


def _first_best(pairs: DataFrame, by: list[str], bonus: int) -> DataFrame:
    """Highest score per key; the first show in catalogue order among equals."""
    ranked = F.struct((-(F.col("score") + bonus)).alias("s"), "show_seq", "anilist_id")
    return pairs.groupBy(*by).agg(F.min(ranked).alias("_best"))


def best_matches(texts: DataFrame, seasons: DataFrame, shows: DataFrame, threshold: int):
    """Best catalogue entry per text, and per (text, season) with the bonus.

    ``texts`` has ``text``; ``seasons`` has ``text`` and ``season``; both are
    token-sorted and distinct. Entries that share a variant are reduced to the
    first of them before the join.
    """
    variants = title_variants(shows).withColumn("variant", sort_tokens(F.col("variant")))
    first = F.min(F.struct("show_seq", "anilist_id")).alias("_show")
    plain = variants.groupBy("variant").agg(first).select("variant", "_show.*")
    named = (
        variants.join(bonus_seasons(shows), "anilist_id")
        .groupBy("variant", "season")
        .agg(first)
        .select("variant", "season", "_show.*")
    )
    raw = _first_best(similar_pairs(texts, plain, "text", "variant", threshold), ["text"], 0)
    lifted = _first_best(
        similar_pairs(
            seasons, named, "text", "variant", max(threshold - SEASON_BONUS, 1), on=["season"]
        ),
        ["text", "season"],
        SEASON_BONUS,
    )
    return raw, lifted


def _fuzzy_decisions(wanted: DataFrame, shows: DataFrame, overrides: DataFrame, threshold: int) -> DataFrame:
    """``wanted`` holds distinct (normalized, prefix, season)."""
    texts = (
        wanted.select(sort_tokens(F.col("normalized")).alias("text"))
        .unionByName(wanted.filter(F.col("prefix") != "").select(sort_tokens(F.col("prefix")).alias("text")))
        .distinct()
    )
    seasons = (
        wanted.filter(F.col("season").isNotNull())
        .select(sort_tokens(F.col("normalized")).alias("text"), "season")
        .distinct()
    )
    raw, lifted = best_matches(texts, seasons, shows, threshold)
    raw = cut(raw)  # read for the title and for its part before the dash
    by_text = raw.select("text", F.col("_best").alias("_raw"))
    by_prefix = raw.select(F.col("text").alias("_prefix_text"), F.col("_best").alias("_prefix_raw"))
    prefix_override = overrides.select(
        F.col("normalized").alias("prefix"), F.col("override_id").alias("_prefix_id")
    )
    joined = (
        wanted.withColumn("text", sort_tokens(F.col("normalized")))
        .withColumn("_prefix_text", sort_tokens(F.col("prefix")))
        .join(by_text, "text", "left")
        .join(lifted.select("text", "season", F.col("_best").alias("_lifted")), ["text", "season"], "left")
        .join(by_prefix, "_prefix_text", "left")
        .join(prefix_override, "prefix", "left")
    )
    lifted_wins = F.col("_lifted").isNotNull() & (
        F.col("_raw").isNull() | (F.col("_lifted") < F.col("_raw"))
    )
    plain = F.when(F.col("_raw").isNotNull(), F.col("_raw"))
    by_rule = plain.isNull() & F.col("_prefix_id").isNotNull() & ~lifted_wins
    best = F.when(lifted_wins, F.col("_lifted")).otherwise(F.coalesce("_raw", "_prefix_raw"))
    chosen = joined.select(
        "normalized",
        "prefix",
        "season",
        F.when(by_rule, F.col("_prefix_id")).otherwise(best["anilist_id"]).alias("anilist_id"),
        F.when(by_rule, F.lit(100)).otherwise(-best["s"]).alias("_score"),
        F.when(by_rule, "manual_override")
        .when(lifted_wins & (F.col("season") != 0), "season_aware")
        .otherwise("fuzzy")
        .alias("_method"),
        F.when(by_rule | lifted_wins, F.col("season")).alias("_matched_season"),
    ).filter(F.col("anilist_id").isNotNull())
    named = chosen.join(shows.select("anilist_id", "title_romaji"), "anilist_id", "left")
    columns = ("anilist_id", "_score", "_method", "_matched_season", "title_romaji")
    return named.select(
        "normalized", "prefix", "season", _decision(*[F.col(c) for c in columns]).alias("_fuzzy")
    )


def resolve(
    titles: DataFrame,
    shows: DataFrame,
    overrides: DataFrame,
    ranges: DataFrame,
    threshold: int = MATCH_THRESHOLD,
) -> DataFrame:
    """Match (key, title, season, episode) rows against the catalogue.

    Returns every row with anilist_id, score, method, matched_title and
    season_matched; all null when nothing matched. Similarity runs once per
    distinct title and season; the rows after the rules, those distinct titles and
    their scores are stored, as each is read more than once.
    """
    usable = override_rules(overrides, shows)
    dash = title_before_dash(F.col("title"))
    prefix = normalize_title(dash)
    keep_prefix = is_informative(prefix) & (F.length(prefix) >= 4)
    rows = (
        titles.withColumn("normalized", normalize_title(F.col("title")))
        .withColumn("prefix", F.coalesce(F.when(keep_prefix, prefix), F.lit("")))
        .withColumn("_informative", is_informative(F.col("normalized")))
        .join(range_rules(ranges, shows), "normalized", "left")
        .join(usable, "normalized", "left")
        .withColumn("_range", range_target(F.col("episode"), F.col("_ranges")))
    )
    hundred, none = F.lit(100), F.lit(None).cast("bigint")
    by_rule = (
        F.when(~F.col("_informative"), F.lit(None).cast(_DECISION))
        .when(
            F.col("_range").isNotNull(),
            _decision(
                F.col("_range.range_id"), hundred, F.lit("episode_range"), none, F.col("_range.range_title")
            ),
        )
        .when(
            F.col("override_id").isNotNull(),
            _decision(
                F.col("override_id"), hundred, F.lit("manual_override"), F.col("season"), F.col("override_title")
            ),
        )
    )
    ruled = cut(
        rows.withColumn("_rule", by_rule).drop("_ranges", "_range", "override_id", "override_title")
    )
    open_rows = F.col("_informative") & F.col("_rule").isNull()
    wanted = cut(ruled.filter(open_rows).select("normalized", "prefix", "season").distinct())
    fuzzy = _fuzzy_decisions(wanted, shows, usable, threshold)
    # Seasons are compared null-safely through a code no season has.
    no_season = F.lit(-(2**62)).cast("bigint")
    code = F.coalesce("season", no_season).alias("_season")
    decided = ruled.withColumn("_season", code).join(
        fuzzy.select("normalized", "prefix", code, "_fuzzy"), ["normalized", "prefix", "_season"], "left"
    )
    final = F.coalesce("_rule", F.when(open_rows, F.col("_fuzzy")))
    return decided.withColumn("_d", final).select(*titles.columns, "normalized", "_d.*")


def matched(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("anilist_id").isNotNull())


def unmatched(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("anilist_id").isNull())


def best_scores(misses: DataFrame, shows: DataFrame, level: int = 85, cuts=BEST_CUTS) -> DataFrame:
    """Best raw score per unmatched title; null if nothing is alike or the title
    carries too little to compare.

    The similarity join is exact above its threshold, so titles that grams can find are done first; the
    best of the others is looked for with falling cuts.
    """
    variants = title_variants(shows).select(sort_tokens(F.col("variant")).alias("variant")).distinct()
    texts = (
        misses.filter(is_informative(F.col("normalized")))
        .select(sort_tokens(F.col("normalized")).alias("text"))
        .distinct()
    )
    near = cut(similar_pairs(texts, variants, "text", "variant", level).groupBy("text").agg(F.max("score").alias("best_score")))
    rest = texts.join(near.select("text"), "text", "left_anti")
    far = best_ratios(rest, variants, "text", "variant", cuts).select("text", F.nullif("score", F.lit(0)).alias("best_score"))
    found = near.unionByName(far)
    text = F.when(is_informative(F.col("normalized")), sort_tokens(F.col("normalized")))
    return misses.withColumn("text", text).join(found, "text", "left").drop("text")


def stored_with_summary(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The result, written, and its :func:`match_summary`, counted by the same pass."""
    counts = {m: F.count_if(F.coalesce("method", F.lit("unmatched")) == m) for m in METHODS}
    stored, found = cut_counted(resolved, **counts)
    total = sum(found.values())
    rows = [(m, n, n / total) for m, n in found.items() if n]
    return stored, literal_rows(resolved.sparkSession, rows, "method string, items bigint, share double")


def match_summary(resolved: DataFrame) -> DataFrame:
    """Counts per method and the share of all rows; ``unmatched`` included."""
    counts = resolved.groupBy(F.coalesce("method", F.lit("unmatched")).alias("method")).agg(
        F.count(F.lit(1)).alias("items")
    )
    return counts.withColumn(
        "share", F.col("items") / F.sum("items").over(Window.partitionBy())
    )
