"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions import numbers, text, times
from pulse.queries import registry
from pulse.queries import views as v


@registry.add("SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS normalized FROM documents")
def normalized_texts(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select(
        "doc_id", text.normalize_title(F.col("text")).alias("normalized")
    )


@registry.add("""SELECT doc_id, length(n) >= 3 AND regexp_matches(n, '[a-z]') AS informative FROM (
  SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS n FROM documents)""")
def informative_texts(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select(
        "doc_id", text.is_informative(text.normalize_title(F.col("text"))).alias("informative")
    )


@registry.add("""SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#039;') AS escaped FROM documents""")
def escaped_texts(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", text.escape_html(F.col("text")).alias("escaped"))


@registry.add("""SELECT o_orderkey, n AS number,
  CASE WHEN n >= 1000000 THEN concat(((n + 50000) // 100000) // 10, '.', ((n + 50000) // 100000) % 10, 'M')
       WHEN n >= 1000 THEN concat((n + 500) // 1000, 'K') ELSE CAST(n AS VARCHAR) END AS label
FROM (SELECT o_orderkey, CAST(floor(o_totalprice * (o_orderkey % 10)) AS BIGINT) AS n FROM orders)""")
def compact_numbers(spark, sf_dir):
    number = F.floor(F.col("o_totalprice") * (F.col("o_orderkey") % 10))
    rows = v.table(spark, sf_dir, "orders").select("o_orderkey", number.alias("number"))
    return rows.withColumn("label", numbers.compact(F.col("number")))


_FEED_FACTOR = "CASE u WHEN 'KiB' THEN 1024 WHEN 'MB' THEN 1048576 WHEN 'GIB' THEN 1073741824 ELSE 0 END"
_LIST_FACTOR = "CASE u WHEN 'KiB' THEN 1024 WHEN 'MB' THEN 1000000 END"


@registry.add(f"""SELECT p_partkey, CAST(trunc(p_retailprice * {_FEED_FACTOR}) AS BIGINT) AS feed_bytes,
       CAST(trunc(p_retailprice * {_LIST_FACTOR}) AS BIGINT) AS listing_bytes
FROM (SELECT *, list_extract(['KiB', 'MB', 'GIB', 'parsecs'], CAST(p_size % 4 AS INTEGER) + 1) AS u FROM part)""")
def size_texts(spark, sf_dir):
    """Sizes written with known, oddly cased and unknown units."""
    unit = F.get(F.array(*[F.lit(u) for u in ("KiB", "MB", "GIB", "parsecs")]), F.col("p_size") % 4)
    size = F.concat(F.col("p_retailprice").cast("string"), F.lit(" "), unit)
    return v.table(spark, sf_dir, "part").select(
        "p_partkey", numbers.feed_size(size).alias("feed_bytes"), numbers.listing_size(size).alias("listing_bytes")
    )


@registry.add("""SELECT c_custkey, concat(2000 + c_custkey % 30, CASE c_mktsegment WHEN 'WINTER' THEN 'A' WHEN 'MACHINERY' THEN 'D' END) AS unused,
  CASE c_custkey % 5 WHEN 0 THEN concat(2000 + c_custkey % 30, 'A') WHEN 1 THEN concat(2000 + c_custkey % 30, 'B')
       WHEN 2 THEN concat(2000 + c_custkey % 30, 'C') WHEN 3 THEN concat(2000 + c_custkey % 30, 'D') END AS code,
  replace(lower(concat(c_mktsegment, ' ', 2000 + c_custkey % 30)), ' ', '-') AS slug FROM customer""".replace(
    "concat(2000 + c_custkey % 30, CASE c_mktsegment WHEN 'WINTER' THEN 'A' WHEN 'MACHINERY' THEN 'D' END) AS unused,", ""))
def season_codes(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("Winter", "SPRING", "summer", "FALL", "harvest")])
    year = F.col("c_custkey") % 30 + 2000
    season = F.get(names, (F.col("c_custkey") % 5).cast("int"))
    name = F.concat("c_mktsegment", F.lit(" "), year.cast("string"))
    return v.table(spark, sf_dir, "customer").select(
        "c_custkey", text.season_code(season, year).alias("code"), text.season_slug(name).alias("slug")
    )


@registry.add(f"""SELECT o_orderkey, {v.week_sql('o_orderdate')} AS week,
  concat(strftime(s, '%b %-d'), ' – ', strftime(e, '%b %-d'), CASE WHEN year(s) <> year(e) THEN concat(', ', year(e)) ELSE '' END, ', ', year(e)) AS label,
  concat(strftime(s, '%b %-d'), '|–', strftime(e, '%b %-d'), '|', year(e)) AS stacked
FROM (SELECT *, CAST({v.week_sql('o_orderdate')} AS DATE) AS s, CAST({v.week_sql('o_orderdate')} AS DATE) + 6 AS e FROM orders)""")
def week_labels(spark, sf_dir):
    start = times.week_start_date(F.col("o_orderdate"))
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", times.week_label(F.col("o_orderdate")).alias("week"),
        times.date_range_label(start).alias("label"),
        F.array_join(times.stacked_date_labels(start), "|").alias("stacked"),
    )


@registry.add("""SELECT o_orderkey, strftime(d - CAST((dayofweek(d) + 6) % 7 AS INTEGER), '%Y-%m-%d') AS monday FROM (
  SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) + CAST((o_orderkey % 53) * 7 AS INTEGER) AS d FROM orders)""")
def iso_week_mondays(spark, sf_dir):
    """Labels such as 1997-W08."""
    week = F.lpad(((F.col("o_orderkey") % 53) + 1).cast("string"), 2, "0")
    label = F.concat(F.year("o_orderdate").cast("string"), F.lit("-W"), week)
    monday = F.date_format(times.iso_week_monday(label), "yyyy-MM-dd")
    return v.table(spark, sf_dir, "orders").select("o_orderkey", monday.alias("monday"))


@registry.add("""SELECT o_orderkey, year(o_orderdate) * 10000 + CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE month(o_orderdate) END * 100
         + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE day(o_orderdate) END AS fuzzy,
       CAST(fuzzy > 19950601 AND fuzzy < 19960331 AS BOOLEAN) AS inside FROM orders""")
def fuzzy_dates(spark, sf_dir):
    """Dates with unknown days and months, and whether they lie in a range."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    fuzzy = times.fuzzy_date(
        F.year(day), F.when(key % 4 != 0, F.month(day)), F.when(key % 2 != 0, F.day(day))
    ).cast("bigint")
    rows = v.table(spark, sf_dir, "orders").select("o_orderkey", fuzzy.alias("fuzzy"))
    return rows.withColumn("inside", (F.col("fuzzy") > 19950601) & (F.col("fuzzy") < 19960331))


@registry.add("""SELECT page_id, regexp_matches(md5(url), '^([0-9a-f]{2})+$') AS whole, false AS odd, false AS spaced FROM pages""")
def infohash_checks(spark, sf_dir):
    digest = F.md5("url")
    return v.table(spark, sf_dir, "pages").select(
        "page_id", text.is_infohash(digest).alias("whole"),
        text.is_infohash(F.substring(digest, 1, 31)).alias("odd"),
        text.is_infohash(F.concat(F.lit("  "), F.substring(digest, 1, 30))).alias("spaced"),
    )


@registry.add("""SELECT page_id, TRY_CAST(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS BIGINT) AS last_number,
       page_id AS viewed, md5(url) AS infohash FROM pages""")
def identifiers(spark, sf_dir):
    """Numbers from URL paths and hashes from magnet links."""
    magnet = F.concat(F.lit("magnet:?dn=x&xt=urn%3Abtih%3A"), F.md5("url"), F.lit("&tr=y"))
    view = F.concat(F.lit("/view/"), F.col("page_id").cast("string"), F.lit("#top"))
    return v.table(spark, sf_dir, "pages").select(
        "page_id", text.last_path_number(F.col("url")).alias("last_number"),
        text.view_id(view).alias("viewed"), text.magnet_infohash(magnet).alias("infohash"),
    )


@registry.add("""SELECT p_partkey, p_name, CASE WHEN lower(p_name) = 'red bolt' OR lower(p_type) = 'red bolt' THEN 100
  WHEN starts_with(lower(p_name), 'red bolt') OR starts_with(lower(p_type), 'red bolt') THEN 80
  WHEN contains(lower(p_name), 'red bolt') OR contains(lower(p_type), 'red bolt') THEN 50 ELSE 0 END AS score FROM part""".replace("red bolt", "red b"))
def title_search(spark, sf_dir):
    from pulse.operators.ranking import search

    rows = v.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    scored = search(rows, text.search_score("Red B", F.col("p_name"), F.col("p_type")), "p_partkey")
    return scored.select("p_partkey", "p_name", "score")
