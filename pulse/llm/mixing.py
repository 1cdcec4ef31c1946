"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of the mix are equal blocks. Blocks go to sources by the highest quotients
target / (2k + 1), and those of a source to its shards by the highest quotients of their sizes,
so every shard has an integer quota. A shard's documents stand in a seeded order; the mix
takes the whole line as often as the quota holds it and then a run of blocks from a
seeded start (past the end it goes on at the beginning). Everything is DataFrame
operations; a document is moved once, as a row of a few numbers.

Sizes are words, runs of characters other than ASCII white space; a null text has
none. Null is a source of its own, last in order. Repeated rows are separate documents. A
source without words takes none; an empty table gives none. Texts of any length are counted whole. Other
columns are ignored, or pass through where the mixed documents are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import plain
from pulse.session import cut

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_WORDS = 4_000_000
MAX_PASSES = 3


def seeded(seed: str, *columns: str) -> Column:
    """A digest that any engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def targets(sources: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """Add `target` to (source_no, weight, source_size): shares of all words by weight, none above
    `max_passes` times its size, the excess shared again by weight.

    Sorted by size for weight, the first sources are full and the others stand at one level: the
    first level that doesn't overfill the next source. One row per source, one window.
    """
    full = F.col("source_size") * max_passes
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = sources.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= full
    first = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), "source_no", "level"))).over(everything)
    water = first["level"]
    target = F.least(full.cast("double"), F.coalesce(water * F.col("weight"), full.cast("double")))
    return leveled.withColumn("target", target).drop("level")


def apportion(rows: DataFrame, group: list[str], seats: str, votes: str, key: str) -> DataFrame:
    """Add `quota`: the `seats` of a group to its rows by Sainte-Laguë's highest quotients.

    A row gets at first the seats that are surely its own: those by its share, less some room in
    proportion. The rest are the highest of the quotients from there on; the room makes
    them about three for each row and not one for each seat. Equal quotients go by `key`.
    """
    window = Window.partitionBy(*group)
    total, count = F.sum(votes).over(window), F.count("*").over(window)
    share = F.when(total > 0, F.col(votes) / total).otherwise(0.0)
    shared = rows.withColumn("room", F.ceil(share * count) + 1).withColumn("ideal", share * F.col(seats))
    sure = shared.withColumn("sure", F.greatest(F.lit(0), F.floor(F.col("ideal")) - F.col("room")).cast("long"))
    sure = sure.withColumn("open", F.col(seats) - F.sum("sure").over(window))
    seat = F.explode(F.sequence(F.col("sure"), F.col("sure") + 2 * F.col("room") + 1))
    quotients = sure.where(F.col(votes) > 0).select(*group, key, votes, "open", seat.alias("seat"))
    order = window.orderBy((F.col(votes) / (2 * F.col("seat") + 1)).desc(), key)
    won = quotients.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("open"))
    extra = won.groupBy(*group, key).agg(F.count("*").alias("extra"))
    joined = sure.join(extra, [*group, key], "left")
    return joined.withColumn("quota", F.col("sure") + F.coalesce("extra", F.lit(0))).drop(
        "room", "ideal", "sure", "open", "extra"
    )


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, row_col: str | None) -> DataFrame:
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row_no"),
    ).withColumn("place", seeded(seed, "doc_id", "size"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    weights: tuple[int, ...] = (1, 2, 3),
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    max_passes: int = MAX_PASSES,
    row_col: str | None = None,
) -> DataFrame:
    """(doc_id, row_no, size, source, source_size, target, taken, passes, run_from, run_words, wrap_words) of each row.

    `taken` words of it are in the mix: `passes` times all, then `run_words` from word `run_from` on,
    then the first `wrap_words`. `row_no` is `row_col`, which tells repeated rows apart.
    """
    rows = cut(sizes(docs, id_col, text_col, source_col, seed, row_col))
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("source_no") % len(weights))
    known = by_source.withColumn("source_no", number).withColumn("weight", weight)
    aimed = targets(known, max_passes).withColumn("target", F.round("target", 6)).withColumn("all", F.lit(0))
    seats = F.round(F.sum("target").over(Window.partitionBy("all")) / block_words).cast("long")
    chosen = apportion(aimed.withColumn("seats", seats), ["all"], "seats", "target", "source_no")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    plan = cut(chosen.select(F.col("source").alias("own"), "source_no", "source_size", "target", "quota", shards.alias("shards")))
    number = lambda digest: F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    dealt = (
        rows.join(plan, F.col("source").eqNullSafe(F.col("own")))
        .withColumn("shard", F.pmod(number(F.col("place")), F.col("shards")))
        .drop("own", "shards")
    )
    of_shard = dealt.groupBy("source_no", "quota", "shard").agg(F.sum("size").alias("words"))
    quotas = apportion(of_shard.withColumnRenamed("quota", "blocks"), ["source_no"], "blocks", "words", "shard")
    words = F.least(F.col("quota") * block_words, F.col("words") * max_passes)
    start = F.pmod(number(seeded(seed, "source_no", "shard")), F.col("words"))
    runs = quotas.where("words > 0").select(
        "source_no", "shard", F.col("words").alias("line"),
        F.floor(words / F.col("words")).cast("long").alias("passes"),
        F.pmod(words, F.col("words")).cast("long").alias("rest"),
        (F.floor(start / block_words) * block_words).cast("long").alias("start"),
    )
    order = Window.partitionBy("source_no", "shard").orderBy("place", "doc_id", "size", "row_no")
    begin = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    joined = dealt.withColumn("begin", begin).join(runs, ["source_no", "shard"], "left")
    end = F.col("begin") + F.col("size")
    stop = F.col("start") + F.col("rest")
    zero = F.lit(0)
    run = F.greatest(zero, F.least(end, stop) - F.greatest("begin", "start"))
    wrap = F.greatest(zero, F.least(end, stop - F.col("line")) - F.col("begin"))
    parts = {"passes": F.col("passes"), "run_from": F.greatest(zero, F.col("start") - F.col("begin")), "run_words": run, "wrap_words": wrap}
    whole = joined.withColumns({k: F.coalesce(v, zero).cast("long") for k, v in parts.items()})
    taken = F.col("passes") * F.col("size") + F.col("run_words") + F.col("wrap_words")
    return whole.select("doc_id", "row_no", "size", "source", "source_size", "target", taken.alias("taken"), *parts)


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    length_col: str | None = "n_chars", **parameters,
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the words that are taken.

    A row that a run's edge cuts keeps its text from the first word taken to the last (white space
    before a word goes with it); `length_col`, where it exists, becomes its code points.
    """
    numbered = cut(docs.select(F.struct(*[plain(c) for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("row_no")))
    flat = numbered.select(
        F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"),
        F.col("row").getField(source_col).alias("source"), "row_no",
    )
    taken = mix(flat, "id", "text", "source", row_col="row_no", **parameters).where("taken > 0")
    part = lambda start, words: F.struct(start.cast("long").alias("start"), words.alias("words"))
    whole = F.array_repeat(part(F.lit(0), F.col("size")), F.col("passes").cast("int"))
    rest = F.array(part(F.col("run_from"), F.col("run_words")), part(F.lit(0), F.col("wrap_words")))
    parts = F.filter(F.concat(whole, rest), lambda p: p["words"] > 0)
    pieces = taken.select("row_no", "size", F.explode(parts).alias("part"))
    joined = numbered.join(pieces, "row_no")
    text = F.col("row").getField(text_col)
    # Java's pattern of white space and a word: the words of a cut text with what stands before them.
    words = F.regexp_extract_all(text.cast("string"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    piece = F.array_join(F.slice(words, (F.col("part.start") + 1).cast("int"), F.col("part.words").cast("int")), "")
    new = F.when(F.col("part.words") < F.col("size"), piece).otherwise(text)
    mixed = joined.select("row", new.alias("new"))
    own = {text_col: F.col("new")}
    if length_col in docs.columns:
        own[length_col] = F.length("new").cast(docs.schema[length_col].dataType)
    return mixed.select(*[own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
