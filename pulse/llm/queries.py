"""The dealt queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import (
    crosspolytope,
    dartminhash,
    decontamination,
    divergence,
    mixing,
    neighbours,
    packing,
    pages,
    pseudonyms,
    quality,
    resampling,
    suffixes,
    urls,
)
from pulse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
KEY = "rotate-me"
THRESHOLD = 0.7


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pseudonym_key(spark: SparkSession) -> str:
    """The secret of a job is its setting; tests go without."""
    return spark.conf.get("spark.pulse.pseudonymKey", KEY)


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


@register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 1024)


@register
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(quality.fold(F.col("doc_id")) == quality.HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@register
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dartminhash.classes(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("class").alias("class_id"), "n_copies", "n_links",
        (F.col("id") == F.col("class")).alias("kept"),
    )


@register
def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


URL_RULES = (("net/", False), ("example.net/en/", True), ("example.com/de/", False), ("org/fr/", True))


@register
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.rules(spark, URL_RULES))


def _link_sql(tag: str, mark: str, attribute: str) -> str:
    """The address in the first such tag; RE2 has no look-ahead, so the tags are listed and searched."""
    return rf"""regexp_extract(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<{tag}\b[^>]*'),
      lambda x: regexp_matches(x, '(?is){mark}') AND regexp_matches(x, '(?is){attribute}'))[1], '(?is){attribute}', 1)"""


_JUDGE_SQL = r"""CASE
    WHEN regexp_matches({host}, '(^|\.)example\.net$') AND starts_with({path}, '/en/') THEN 'example.net/en/'
    WHEN regexp_matches({host}, '(^|\.)example\.com$') AND starts_with({path}, '/de/') THEN 'example.com/de/'
    WHEN regexp_matches({host}, '(^|\.)org$') AND starts_with({path}, '/fr/') THEN 'org/fr/'
    WHEN regexp_matches({host}, '(^|\.)net$') AND starts_with({path}, '/') THEN 'net/' END"""

SQL["op5_url_filter"] = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
         [{_link_sql("link", r"rel\s*=\s*[\x22\x27]?canonical\b", r"\bhref\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)")},
          {_link_sql("meta", r"http-equiv\s*=\s*[\x22\x27]?refresh\b", r"\burl\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)")}] AS targets
  FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail, targets
  FROM parts
), pointed AS (SELECT host, path, concat(host, tail) AS key, unnest(targets) AS target FROM split WHERE host <> ''),
resolved AS (
  SELECT key, CASE WHEN contains(target, '://') THEN substr(target, instr(target, '://') + 3)
    WHEN starts_with(target, '//') THEN substr(target, 3) WHEN starts_with(target, '/') THEN concat(host, target)
    WHEN regexp_matches(target, '^[^:/?#]+:') THEN NULL WHEN regexp_matches(target, '^[?#]') THEN concat(host, path, target)
    ELSE concat(host, regexp_extract(path, '^(.*/)?'), CASE WHEN contains(path, '/') THEN '' ELSE '/' END, target) END AS target
  FROM pointed WHERE target <> ''
), links AS (
  SELECT DISTINCT key AS a, concat(translate(regexp_extract(target, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         regexp_extract(target, '^[^/?#]*([^#]*)', 1)) AS b FROM resolved WHERE target IS NOT NULL
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
members AS (SELECT b AS key, regexp_extract(b, '^[^/?]*') AS host, regexp_extract(b, '^[^/?]*([^?]*)', 1) AS path FROM (SELECT DISTINCT b FROM reach)),
ruled AS (SELECT key, {_JUDGE_SQL.format(host="host", path="path")} AS rule FROM members),
decided AS (
  SELECT r.a AS key, bool_or(rule IN ('example.net/en/', 'org/fr/')) AS any_allow, bool_or(rule IN ('net/', 'example.com/de/')) AS any_block
  FROM (SELECT a, b FROM reach UNION SELECT a, a FROM reach) r JOIN ruled ON ruled.key = r.b GROUP BY 1
), own AS (SELECT page_id, host, path, concat(host, tail) AS key, {_JUDGE_SQL.format(host="host", path="path")} AS rule FROM split)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN any_block AND NOT coalesce(any_allow, false) THEN 'block' ELSE 'allow' END AS verdict
FROM own LEFT JOIN decided USING (key)"""


@register
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# The same apportionment written out: every quotient of every seat is ranked.
SQL["op6_source_mixing"] = f"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), placed AS (
  SELECT *, md5(concat('mix|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', size)) AS place FROM rows
), sources AS (
  SELECT *, 1 + source_no % 3 AS weight FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source IS NULL, CAST(source AS BLOB)) - 1 AS source_no
    FROM placed GROUP BY source)
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum({mixing.MAX_PASSES} * source_size) OVER w, 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM sources
  WINDOW w AS (ORDER BY source_size / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT level AS water FROM levels WHERE level * weight <= {mixing.MAX_PASSES} * source_size
  ORDER BY source_size / weight, source_no LIMIT 1
), targets AS (
  SELECT *, round(least(CAST({mixing.MAX_PASSES} * source_size AS DOUBLE),
                        coalesce((SELECT water FROM water) * weight, {mixing.MAX_PASSES} * source_size)), 6) AS target
  FROM sources
), seats AS (SELECT CAST(round(sum(target) / {mixing.BLOCK_WORDS}) AS BIGINT) AS seats FROM targets),
won AS (
  SELECT source_no, count(*) AS quota FROM (
    SELECT source_no, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, source_no) AS rank
    FROM targets, (SELECT unnest(range((SELECT seats FROM seats))) AS seat) WHERE target > 0
  ) WHERE rank <= (SELECT seats FROM seats) GROUP BY source_no
), dealt AS (
  SELECT p.*, source_no, source_size, target, coalesce(quota, 0) AS blocks,
         CAST('0x' || substr(place, 1, 8) AS BIGINT) % greatest(1, CAST(ceil(source_size / {mixing.SHARD_WORDS}) AS BIGINT)) AS shard
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source LEFT JOIN won USING (source_no)
), shards AS (
  SELECT source_no, shard, blocks, CAST(sum(size) AS BIGINT) AS words FROM dealt GROUP BY ALL
), shard_won AS (
  SELECT source_no, shard, count(*) AS quota FROM (
    SELECT source_no, shard, blocks, row_number() OVER (PARTITION BY source_no ORDER BY words / (2 * seat + 1) DESC, shard) AS rank
    FROM (SELECT *, unnest(range(blocks)) AS seat FROM shards WHERE words > 0)
  ) WHERE rank <= blocks GROUP BY ALL
), runs AS (
  SELECT source_no, shard, words, least(coalesce(quota, 0) * {mixing.BLOCK_WORDS}, words * {mixing.MAX_PASSES}) AS taken,
         CAST('0x' || substr(md5(concat('mix|', source_no, '|', shard)), 1, 8) AS BIGINT) % words // {mixing.BLOCK_WORDS} * {mixing.BLOCK_WORDS} AS start
  FROM shards LEFT JOIN shard_won USING (source_no, shard) WHERE words > 0
), lines AS (
  SELECT d.doc_id, d.size, d.source_size, d.target, r.words, r.start, r.taken // r.words AS passes, r.start + r.taken % r.words AS stop,
         sum(size) OVER (PARTITION BY source_no, shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS begin
  FROM dealt d LEFT JOIN runs r USING (source_no, shard)
)
SELECT doc_id, size, source_size, target, CAST(coalesce(passes * size
  + greatest(0, least(begin + size, stop) - greatest(begin, start))
  + greatest(0, least(begin + size, stop - words) - begin), 0) AS BIGINT) AS taken
FROM lines"""


@register
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(table(spark, sf_dir, "embeddings"))


@register
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda r: r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        # What is left, to read; of a character that a removed run cuts, the rest becomes U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


@register
def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@register
def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark))
    return docs.select("doc_id", "text", "pii_spans", F.size("pii_spans").alias("n_spans"))


@register
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"))
    hits = F.aggregate(F.zip_with("leak.starts", "leak.ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    return marked.select(
        "doc_id", "leak.n_words", hits.alias("n_hit"), F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


_WORDS_SQL = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[]))"""

SQL["op11_benchmark_decontamination"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS words
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM items WHERE len(w) > 0)
), places AS (
  SELECT row_no, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS words
  FROM (SELECT row_no, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM docs, (SELECT DISTINCT k FROM windows))
), met AS (SELECT row_no, k, pos, item_id FROM places JOIN windows USING (k, words)),
hits AS (SELECT row_no, count(DISTINCT word) AS n_hit FROM (SELECT row_no, unnest(range(pos, pos + k)) AS word FROM met) GROUP BY row_no),
found AS (
  SELECT row_no, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM met GROUP BY row_no
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN found USING (row_no)"""


@register
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark"), keep=())
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 written out over the bytes of each distinct word.
SQL["op12_importance_resampling"] = f"""
WITH bits AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) t(i))
), docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS_SQL} AS w FROM documents),
doc_words AS (SELECT row_no, unnest(w) AS word FROM docs),
target_words AS (SELECT unnest({_WORDS_SQL}) AS word FROM benchmark),
hashed AS (
  SELECT word, xor(list_reduce(list_transform(range(0, len(hex(encode(word))), 2), lambda i: CAST('0x' || substr(hex(encode(word)), i + 1, 2) AS BIGINT)),
                               lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words), bits
), source AS (SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM doc_words) AS s_all, (SELECT count(*) FROM target_words) AS t_all),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE))
                                    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM source FULL JOIN target USING (bucket), totals
), weights AS (
  SELECT row_no, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM doc_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row_no
), scored AS (
  SELECT row_no, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(concat('2024:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (row_no)
), drawn AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row_no) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (row_no)"""


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


SQL["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (SELECT row_no, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10),
langs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counted GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN totals t USING (lang, source)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 10"""
