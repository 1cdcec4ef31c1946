"""Titles to catalogue entries.

The catalogue is the distinct part names (some with a season, an English name, a
synonym); the titles are the part names reordered, cut, joined or extended.
Overrides and episode ranges point some names at shows that exist or do not.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pulse.functions.metadata import corrected_title
from pulse.functions.ratios import fold_width
from pulse.functions.text import normalize_title, strip_symbols
from pulse.operators import intervals
from pulse.operators import resolve as ops
from pulse.operators import surveys
from pulse.plans import reception
from pulse.queries import registry
from pulse.queries import views as v
from pulse.session import cut, literal_rows


def _norm_sql(title: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({title}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def _sorted_sql(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, ' ')), ' ')"


CATALOGUE = """
cat AS (
  SELECT p_name AS name, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2, min(p_partkey) + 1 AS id
  FROM part GROUP BY p_name),
shows AS (
  SELECT id, name, concat(name, CASE id % 4 WHEN 0 THEN ' 2nd Season' WHEN 1 THEN ' Season 3' ELSE '' END) AS romaji,
         CASE WHEN id % 3 <> 0 THEN concat('The ', name) END AS english,
         [concat(w2, ' ', w1, ' saga'), '12'] AS synonyms, CASE WHEN id % 5 <> 0 THEN 'TV' END AS format
  FROM cat)"""

TITLES = CATALOGUE + f""",
raw_titles AS (
  SELECT CAST(p_partkey AS VARCHAR) AS infohash, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size % 4 AS BIGINT) END AS season,
         CAST(p_size AS BIGINT) AS episode,
         CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN concat(w2, ' ', w1) WHEN 2 THEN concat(w1, '-', w2, '!!')
              WHEN 3 THEN concat(p_name, ' - ', lower(p_type), ' days') WHEN 4 THEN left(p_name, length(p_name) - 1)
              WHEN 5 THEN concat(upper(p_name), ' Season') WHEN 6 THEN concat(p_type, ' ', w2) ELSE '12' END AS title
  FROM part JOIN cat ON name = p_name),
titles AS (
  SELECT *, {_norm_sql('title')} AS normalized,
         CASE WHEN contains(title, ' - ') THEN {_norm_sql("split_part(title, ' - ', 1)")} END AS prefix
  FROM raw_titles),
overrides AS (
  SELECT name AS normalized, id AS override_id FROM cat WHERE id % 6 = 0),
ranges AS (
  SELECT name AS normalized, 10 AS low, 20 AS high, id AS range_id FROM cat WHERE id % 7 = 0)"""


def catalogue(spark, sf_dir):
    words = F.split("p_name", " ")
    name, number = F.col("p_name"), F.col("anilist_id")
    return (
        v.table(spark, sf_dir, "part")
        .groupBy("p_name")
        .agg((F.min("p_partkey") + 1).alias("anilist_id"))
        .select(
            "anilist_id",
            number.alias("show_seq"),
            name.alias("name"),
            F.concat(
                name, F.when(number % 4 == 0, " 2nd Season").when(number % 4 == 1, " Season 3").otherwise("")
            ).alias("title_romaji"),
            F.when(number % 3 != 0, F.concat(F.lit("The "), name)).alias("title_english"),
            name.alias("title_native"),
            F.array(
                F.concat(F.get(words, F.lit(1)), F.lit(" "), F.get(words, F.lit(0)), F.lit(" saga")), F.lit("12")
            ).alias("synonyms"),
            F.when(number % 5 != 0, "TV").alias("format"),
        )
    )


def titles(spark, sf_dir):
    words = F.split("p_name", " ")
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    kind, name = F.col("p_partkey") % 8, F.col("p_name")
    title = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(second, F.lit(" "), first))
        .when(kind == 2, F.concat(first, F.lit("-"), second, F.lit("!!")))
        .when(kind == 3, F.concat(name, F.lit(" - "), F.lower("p_type"), F.lit(" days")))
        .when(kind == 4, F.substring(name, F.lit(1), F.length(name) - 1))
        .when(kind == 5, F.concat(F.upper(name), F.lit(" Season")))
        .when(kind == 6, F.concat("p_type", F.lit(" "), second))
        .otherwise("12")
    )
    return v.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("infohash"),
        title.alias("title"),
        F.when(F.col("p_size") % 5 != 0, (F.col("p_size") % 4).cast("bigint")).alias("season"),
        F.col("p_size").cast("bigint").alias("episode"),
    )


def rules(shows):
    """Targets that exist, and a range and an override whose target does not."""
    listed = shows.select("anilist_id", F.col("name").alias("normalized"))
    missing = F.lit(10**12)
    overrides = listed.filter(F.col("anilist_id") % 6 == 0).select(
        "normalized", F.col("anilist_id").alias("override_id")
    ).unionByName(
        listed.filter(F.col("anilist_id") % 6 == 1).select("normalized", missing.alias("override_id"))
    )
    spans = F.array(
        F.struct(F.lit(0).alias("rule_seq"), F.lit(5).alias("min_episode"), F.lit(30).alias("max_episode"),
                 missing.alias("range_id")),
        F.struct(F.lit(1).alias("rule_seq"), F.lit(10).alias("min_episode"), F.lit(20).alias("max_episode"),
                 F.col("anilist_id").alias("range_id")),
    )
    ranges = listed.filter(F.col("anilist_id") % 7 == 0).select("normalized", F.inline(spans))
    return overrides, ranges


SCORES = "RECURSIVE " + TITLES + f""",
variants AS (
  SELECT DISTINCT id, variant FROM (
    SELECT id, {_norm_sql('v')} AS variant FROM (SELECT id, unnest(list_concat([romaji, english], synonyms)) AS v FROM shows) WHERE v IS NOT NULL)
  WHERE length(variant) >= 3 AND regexp_matches(variant, '[a-z]')),
texts AS (
  SELECT DISTINCT {_sorted_sql('normalized')} AS a FROM titles WHERE length(normalized) >= 3
  UNION SELECT DISTINCT {_sorted_sql('prefix')} FROM titles WHERE length(prefix) >= 4),
targets AS (SELECT DISTINCT {_sorted_sql('variant')} AS b FROM variants),
dp AS (
  SELECT a, b, 0 AS i, list_transform(range(0, length(b)), lambda x: CAST(0 AS BIGINT)) AS row FROM texts, targets
  UNION ALL
  SELECT a, b, i + 1, list_transform(range(1, length(b) + 1), lambda j: list_max(cand[1:j])) FROM (
    SELECT a, b, i, list_transform(range(1, length(b) + 1), lambda k:
      greatest(row[k], coalesce(row[k - 1], 0) + CAST(substr(a, i + 1, 1) = substr(b, k, 1) AS BIGINT))) AS cand
    FROM dp WHERE i < length(a))),
ratios AS (
  SELECT a, b, CAST(round_even(200.0 * row[length(b)] / (length(a) + length(b)), 0) AS BIGINT) AS score FROM dp WHERE i = length(a)),
scored AS (SELECT a, id, score FROM ratios JOIN variants ON {_sorted_sql('variant')} = b),
wanted AS (SELECT DISTINCT normalized, prefix, season FROM titles WHERE length(normalized) >= 3 AND regexp_matches(normalized, '[a-z]')),
lifted AS (
  SELECT w.normalized, w.season, s.id, s.score,
         CASE WHEN w.season IS NOT NULL AND sh.format IS NOT NULL AND (
                contains(lower(romaji), concat('season ', w.season)) OR contains(lower(romaji), concat(w.season, 'nd season'))
                OR contains(lower(romaji), concat(w.season, 'rd season')) OR contains(lower(romaji), concat(w.season, 'th season')))
              THEN 10 ELSE 0 END AS bonus
  FROM (SELECT DISTINCT normalized, season FROM wanted) w JOIN scored s ON s.a = {_sorted_sql('w.normalized')} JOIN shows sh ON sh.id = s.id),
best AS (
  SELECT *, row_number() OVER (PARTITION BY normalized, season ORDER BY score + bonus DESC, id) AS n FROM lifted),
prefix_best AS (
  SELECT a, id, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS n FROM scored),
resolved AS (
  SELECT t.infohash, t.normalized, t.season, i.informative,
    CASE WHEN NOT i.informative THEN NULL WHEN r.range_id IS NOT NULL THEN 'episode_range' WHEN o.override_id IS NOT NULL THEN 'manual_override'
         WHEN b.score + b.bonus >= 85 THEN CASE WHEN b.bonus > 0 AND t.season <> 0 THEN 'season_aware' ELSE 'fuzzy' END
         WHEN po.override_id IS NOT NULL THEN 'manual_override' WHEN p.score >= 85 THEN 'fuzzy' END AS method,
    CASE WHEN NOT i.informative THEN NULL WHEN r.range_id IS NOT NULL THEN r.range_id WHEN o.override_id IS NOT NULL THEN o.override_id
         WHEN b.score + b.bonus >= 85 THEN b.id WHEN po.override_id IS NOT NULL THEN po.override_id WHEN p.score >= 85 THEN p.id END AS anilist_id,
    CAST(CASE WHEN NOT i.informative THEN NULL WHEN r.range_id IS NOT NULL OR o.override_id IS NOT NULL THEN 100
         WHEN b.score + b.bonus >= 85 THEN b.score + b.bonus WHEN po.override_id IS NOT NULL THEN 100 WHEN p.score >= 85 THEN p.score END AS DOUBLE) AS score,
    CASE WHEN NOT i.informative OR r.range_id IS NOT NULL THEN NULL WHEN o.override_id IS NOT NULL THEN t.season
         WHEN b.score + b.bonus >= 85 THEN CASE WHEN b.bonus > 0 THEN t.season END WHEN po.override_id IS NOT NULL THEN t.season END AS season_matched
  FROM titles t
  JOIN (SELECT infohash, length(normalized) >= 3 AND regexp_matches(normalized, '[a-z]') AS informative FROM titles) i USING (infohash)
  LEFT JOIN ranges r ON r.normalized = t.normalized AND t.episode BETWEEN low AND high
  LEFT JOIN overrides o ON o.normalized = t.normalized
  LEFT JOIN best b ON b.normalized = t.normalized AND b.season IS NOT DISTINCT FROM t.season AND b.n = 1
  LEFT JOIN overrides po ON po.normalized = t.prefix
  LEFT JOIN prefix_best p ON p.a = {_sorted_sql('t.prefix')} AND p.n = 1)"""


def _resolved(spark, sf_dir):
    shows = cut(catalogue(spark, sf_dir))
    return shows, ops.resolve(titles(spark, sf_dir), shows, *rules(shows))


@registry.add(f"""WITH {SCORES}
SELECT infohash, anilist_id, method, score, season_matched, romaji AS matched_title FROM resolved LEFT JOIN shows ON id = anilist_id""")
def resolve_titles(spark, sf_dir):
    """The whole cascade; the SQL compares every title with every variant."""
    _, resolved = _resolved(spark, sf_dir)
    return resolved.select("infohash", "anilist_id", "method", "score", "season_matched", "matched_title")


@registry.add(f"""WITH {SCORES}
SELECT coalesce(method, 'unmatched') AS method, count(*) AS items, count(*) / CAST((SELECT count(*) FROM resolved) AS DOUBLE) AS share
FROM resolved GROUP BY ALL""")
def match_summary(spark, sf_dir):
    return ops.match_summary(_resolved(spark, sf_dir)[1])


@registry.add(f"""WITH {SCORES}
SELECT coalesce(method, 'unmatched') AS method, count(*) AS items, count(*) / CAST((SELECT count(*) FROM resolved) AS DOUBLE) AS share
FROM resolved GROUP BY ALL""")
def match_summary_while_writing(spark, sf_dir):
    """The same counts, taken by the pass that stores the result."""
    return ops.stored_with_summary(_resolved(spark, sf_dir)[1])[1]


@registry.add(f"""WITH {SCORES}
SELECT infohash, CASE WHEN informative THEN (SELECT nullif(max(score), 0) FROM ratios WHERE a = {_sorted_sql('resolved.normalized')}) END AS best_score
FROM resolved WHERE anilist_id IS NULL""")
def best_score_of_unmatched(spark, sf_dir):
    shows, resolved = _resolved(spark, sf_dir)
    scored = ops.best_scores(ops.unmatched(cut(resolved)), shows)
    return scored.select("infohash", F.col("best_score").cast("bigint").alias("best_score"))


@registry.add(f"""WITH {TITLES}
SELECT infohash, range_id AS anilist_id FROM titles t JOIN ranges r ON r.normalized = t.normalized AND episode BETWEEN low AND high""")
def episode_range_matches(spark, sf_dir):
    shows = catalogue(spark, sf_dir)
    spans = ops.range_rules(rules(shows)[1], shows)
    rows = titles(spark, sf_dir).withColumn("normalized", normalize_title(F.col("title"))).join(spans, "normalized")
    target = ops.range_target(F.col("episode"), F.col("_ranges"))["range_id"].alias("anilist_id")
    return rows.select("infohash", target).filter(F.col("anilist_id").isNotNull())


@registry.add(f"""WITH {TITLES}
SELECT infohash, range_id, low, high FROM titles t JOIN ranges r ON r.normalized = t.normalized AND episode BETWEEN low AND high
UNION ALL SELECT infohash, 1000000000000, 5, 30 FROM titles t JOIN ranges r ON r.normalized = t.normalized AND episode BETWEEN 5 AND 30""")
def titles_in_ranges(spark, sf_dir):
    """All ranges that hold a title's episode, as an interval join within equal titles."""
    ranges = rules(catalogue(spark, sf_dir))[1].select("normalized", F.col("min_episode").alias("low"), F.col("max_episode").alias("high"), "range_id")
    rows = titles(spark, sf_dir).select("infohash", "episode", normalize_title(F.col("title")).alias("normalized"))
    met = intervals.overlapping(rows, ranges, ("episode", "episode"), ("low", "high"), ["normalized"])
    return met.select("infohash", "range_id", "low", "high")


@registry.add(f"""WITH {TITLES}
SELECT infohash, override_id AS anilist_id FROM titles JOIN overrides USING (normalized)""")
def override_matches(spark, sf_dir):
    shows = catalogue(spark, sf_dir)
    usable = ops.override_rules(rules(shows)[0], shows)
    rows = titles(spark, sf_dir).withColumn("normalized", normalize_title(F.col("title")))
    return rows.join(usable, "normalized").select("infohash", F.col("override_id").alias("anilist_id"))


@registry.add(f"""WITH {CATALOGUE}
SELECT DISTINCT id AS anilist_id, variant FROM (
  SELECT id, {_norm_sql('v')} AS variant FROM (SELECT id, unnest(list_concat([romaji, english], synonyms)) AS v FROM shows) WHERE v IS NOT NULL)
WHERE length(variant) >= 3 AND regexp_matches(variant, '[a-z]')""")
def title_variants(spark, sf_dir):
    return ops.title_variants(catalogue(spark, sf_dir)).select("anilist_id", "variant")


@registry.add("""SELECT p_partkey AS anilist_id, n AS season FROM (
  SELECT p_partkey, lower(concat(p_name, CASE p_partkey % 3 WHEN 0 THEN concat(' Season ', p_size) WHEN 1 THEN concat(' ', p_size, 'th Season 1') ELSE concat(' ', p_size, 'st season') END)) AS title FROM part),
  (SELECT unnest(range(0, 100)) AS n)
WHERE contains(title, concat('season ', n)) OR contains(title, concat(n, 'nd season')) OR contains(title, concat(n, 'rd season')) OR contains(title, concat(n, 'th season'))""")
def bonus_seasons(spark, sf_dir):
    """Seasons a title earns the bonus for, found as plain text."""
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 3
    tail = (
        F.when(kind == 0, F.concat(F.lit(" Season "), size))
        .when(kind == 1, F.concat(F.lit(" "), size, F.lit("th Season 1")))
        .otherwise(F.concat(F.lit(" "), size, F.lit("st season")))
    )
    shows = v.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("anilist_id"), F.concat("p_name", tail).alias("title_romaji"), F.lit("TV").alias("format")
    )
    return ops.bonus_seasons(shows)


@registry.add("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'oshi no ko' ELSE concat(' OSHI no ', p_name) END AS corrected FROM part""")
def corrected_titles(spark, sf_dir):
    title = F.when(F.col("p_partkey") % 2 == 0, " Oshi No ").otherwise(F.concat(F.lit(" OSHI no "), "p_name"))
    return v.table(spark, sf_dir, "part").select("p_partkey", corrected_title(title).alias("corrected"))


@registry.add("""SELECT doc_id, concat('reゼロガ12', regexp_replace(lower(nfc_normalize(text)), '[\\p{P}\\p{S}\\p{Z}\\s]', '', 'g')) AS norm FROM documents""")
def folded_texts(spark, sf_dir):
    """Width-folded texts without spaces, punctuation and symbols. SQL has only the
    canonical form, which is the same where no compatibility characters occur; those of the
    full-width and half-width title in front are known."""
    titled = F.concat(F.lit("Ｒｅ：ゼロ　ｶﾞ「１２」！ "), F.col("text"))
    return v.table(spark, sf_dir, "documents").select("doc_id", strip_symbols(fold_width(titled)).alias("norm"))


def _folded_sql(title: str) -> str:
    return f"lower(regexp_replace({title}, '[\\p{{P}}\\p{{S}}\\p{{Z}}\\s]', '', 'g'))"


def _broadcasts(spark, sf_dir):
    day = F.col("infohash").cast("int") % 28 + 1
    answers = (day + 30, 40 - day, F.lit(20), F.lit(6), F.lit(4))
    return titles(spark, sf_dir).select(
        "title",
        "episode",
        F.concat(F.lit("2024-01-"), F.lpad(day.cast("string"), 2, "0")).alias("aired_at"),
        *[a.cast("double").alias(n) for n, a in zip(surveys.PERCENTAGES, answers, strict=True)],
    )


SURVEYED = "RECURSIVE " + TITLES + f""",
survey AS (SELECT title, episode, CAST(infohash AS INTEGER) % 28 + 1 AS day, {_folded_sql('title')} AS norm FROM titles),
names AS (
  SELECT {_folded_sql('v')} AS norm, min(id) AS exact_id
  FROM (SELECT id, unnest(list_concat([name, romaji, english], synonyms)) AS v FROM shows) WHERE v IS NOT NULL GROUP BY 1),
natives AS (SELECT {_folded_sql('name')} AS b, min(id) AS id FROM shows GROUP BY 1),
open_norms AS (SELECT DISTINCT norm AS a FROM survey WHERE norm <> 'redbolt' AND norm NOT IN (SELECT norm FROM names)),
pairs AS (SELECT a, b FROM open_norms, natives),
oriented AS (
  SELECT a, b, a AS short, b AS long FROM pairs WHERE length(a) <= length(b) AND length(a) >= 8
  UNION ALL SELECT a, b, b, a FROM pairs WHERE length(b) <= length(a) AND length(b) >= 8),
stretches AS (
  SELECT a, b, a AS x, b AS y FROM pairs
  UNION SELECT a, b, short, substr(long, greatest(s, 0) + 1, s + length(short) - greatest(s, 0))
  FROM (SELECT *, unnest(range(1 - length(short), length(long))) AS s FROM oriented)),
dp AS (
  SELECT x, y, 0 AS i, list_transform(range(0, length(y)), lambda z: CAST(0 AS BIGINT)) AS row FROM (SELECT DISTINCT x, y FROM stretches)
  UNION ALL
  SELECT x, y, i + 1, list_transform(range(1, length(y) + 1), lambda j: list_max(cand[1:j])) FROM (
    SELECT x, y, i, list_transform(range(1, length(y) + 1), lambda k:
      greatest(row[k], coalesce(row[k - 1], 0) + CAST(substr(x, i + 1, 1) = substr(y, k, 1) AS BIGINT))) AS cand
    FROM dp WHERE i < length(x))),
likeness AS (
  SELECT a, b, max(round_even(200.0 * row[length(y)] / (length(x) + length(y)), 0)) AS score
  FROM stretches JOIN dp USING (x, y) WHERE i = length(x) GROUP BY a, b),
alike AS (
  SELECT a, id, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS n FROM likeness JOIN natives USING (b) WHERE score >= 90),
placed AS (
  SELECT coalesce(CASE WHEN norm = 'redbolt' THEN 1 END, exact_id, id) AS anilist_id, episode, day, title
  FROM survey LEFT JOIN names USING (norm) LEFT JOIN alike ON a = norm AND n = 1)"""


@registry.add(f"""WITH {SURVEYED}
SELECT anilist_id, episode, CAST(30 + arg_min(day, [lpad(CAST(day AS VARCHAR), 2, '0'), title]) AS DOUBLE) AS very_good_pct,
       CAST(386 + arg_min(day, [lpad(CAST(day AS VARCHAR), 2, '0'), title]) AS DOUBLE) / 100 AS mean_score
FROM placed WHERE anilist_id IS NOT NULL GROUP BY ALL""")
def survey_matches(spark, sf_dir):
    """Survey rows of every part title against the catalogue's native titles; the
    SQL compares every stretch of every pair. Each broadcast has its own answers, so the earliest shows."""
    rows = _broadcasts(spark, sf_dir)
    shows = cut(catalogue(spark, sf_dir))
    matched = surveys.match_surveys(rows, shows, surveys.title_map(spark, {"Red Bolt": 1}))
    return matched.select("anilist_id", "episode", "very_good_pct", "mean_score")


@registry.add(f"""WITH {SURVEYED},
new AS (
  SELECT anilist_id, episode, CAST(30 + arg_min(day, [lpad(CAST(day AS VARCHAR), 2, '0'), title]) AS DOUBLE) AS very_good_pct
  FROM placed WHERE anilist_id IS NOT NULL AND day % 2 = 0 GROUP BY ALL),
old AS (SELECT DISTINCT anilist_id, episode, 1.0::DOUBLE AS very_good_pct FROM placed WHERE anilist_id IS NOT NULL AND day % 3 = 0)
SELECT anilist_id, episode, very_good_pct FROM new
UNION ALL SELECT * FROM old WHERE (anilist_id, episode) NOT IN (SELECT (anilist_id, episode) FROM new)""")
def survey_update(spark, sf_dir):
    """An export with a row for every second day's titles, on top of stored surveys."""
    shows = cut(catalogue(spark, sf_dir))
    listed = surveys.title_map(spark, {"Red Bolt": 1})
    rows = _broadcasts(spark, sf_dir)
    day = F.substring("aired_at", 9, 2).cast("int")
    known = surveys.match_surveys(rows.filter(day % 3 == 0), shows, listed)
    at = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    stored = known.withColumns({"very_good_pct": F.lit(1.0), "source_url": F.lit("old"), "fetched_at": at})
    listed_seasons = [("Winter 2024", "winter", 2024), ("Spring 2024", "spring", 2024)]
    seasons = literal_rows(spark, listed_seasons, "name string, season string, year int")
    export = rows.withColumn("season_code", F.when(day % 2 == 0, "2024A").otherwise("2023D"))
    table = reception.update_surveys(cut(stored), export, seasons, shows, listed, datetime(2024, 2, 1), "new")
    return table.select("anilist_id", "episode", "very_good_pct")
