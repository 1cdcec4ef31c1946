"""Exact similarity joins without comparing every pair.

Two texts whose ratio reaches a cut must share a minimum number of q-grams: with
``m`` characters matched in order out of total length ``L``, at least
(2q-1)m - (q-1)(L+1) grams survive, and ratio >= cut means m >= cut * L / 2.
If every text lists its grams in one fixed order, two texts sharing T grams must
already meet within the first N-T+1 of each. So the join is an equi join on
those leading grams; the order is by how many texts have a gram, rarest first, counted
on the data, so it suits any script. Longer grams are rarer but fewer survive, so each pair
of texts is looked for with the longest grams its total length allows. Only the texts go through the
join; what meets and has fitting lengths is made distinct and scored.

Below a cut of about 0.78 two texts need not share any pair of neighbouring characters. There every pair
may reach the cut, and texts are compared in blocks, within equal values of ``on`` where it is given.

Repeated grams are numbered, which makes a multiset overlap a set overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.ratios import PARTIAL_FROM, best_in_block, likeness, ratio
from pulse.session import cut as stored

_SLACK = 1e-9
_BLOCKS = 64


def lowest_ratio(threshold: int) -> float:
    """The smallest fraction that can round to the threshold."""
    return max(threshold - 0.5, 0.5) / 100.0


def has_grams(cut: float) -> bool:
    """Pairs share a bigram only above this cut (texts of three or more characters)."""
    return 1.5 * cut - 1 > 1 / 6


def _share(cut: float, q: int) -> float:
    """Grams that survive per character of the total length, before (q - 1) are taken off."""
    return (2 * q - 1) * cut / 2 - (q - 1)


def _totals(cut: float) -> list[tuple[int, int, int]]:
    """(q, from, below): which grams are used for pairs of which total length."""
    share = _share(cut, 3)
    longer = int(2 / share) + 1 if share > 0.02 else 1 << 30
    return [(2, 0, longer), (3, longer, 1 << 30)]


def _grams(text: Column, q: int) -> Column:
    """Numbered grams, with their size in front so that those of different sizes don't meet."""
    count = F.length(text) - (q - 1)
    plain = F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(text, i, F.lit(q)))
    numbered = F.transform(
        plain,
        lambda g, i: F.concat(
            F.lit(str(q)), g, F.size(F.filter(F.slice(plain, F.lit(1), i), lambda e: e == g)).cast("string")
        ),
    )
    return F.when(count >= 1, numbered).otherwise(F.array().cast("array<string>"))


def _shortest_partner(length: Column, cut: float) -> Column:
    return F.ceil(length * (cut / (2 - cut)) - _SLACK)


def _longest_partner(length: Column, cut: float) -> Column:
    return F.floor(length * ((2 - cut) / cut) + _SLACK)


def _needed(total: Column, cut: float, q: int) -> Column:
    """Grams that texts of this total length must share to reach the cut."""
    return F.greatest(F.ceil(total * _share(cut, q) - (q - 1) - _SLACK), F.lit(1)).cast("int")


def _texts(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("text")).filter(F.col("text").isNotNull()).distinct()


def _frequencies(texts: DataFrame, q: int) -> DataFrame:
    return texts.select(F.explode(_grams(F.col("text"), q)).alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("texts_with")
    )


def _leading(texts: DataFrame, frequencies: DataFrame, q: int, needed: Column) -> DataFrame:
    """(text, gram): of each text the rarest grams that it takes to meet every partner.

    A text has as many rows as characters, so its window is bounded by its length.
    """
    listed = texts.withColumn("grams", _grams(F.col("text"), q)).withColumn("lead", F.size("grams") - needed + 1)
    rows = listed.filter(F.col("lead") >= 1).select("text", "lead", F.explode("grams").alias("gram"))
    order = Window.partitionBy("text").orderBy(F.coalesce("texts_with", F.lit(0)), "gram")
    ranked = rows.join(frequencies, "gram", "left").withColumn("place", F.row_number().over(order))
    return ranked.filter((F.col("place") <= F.col("lead")) & F.col("texts_with").isNotNull()).select("text", "gram")


def candidate_pairs(left: DataFrame, right: DataFrame, a: str, b: str, threshold: int) -> DataFrame:
    """Distinct (a, b) that may reach the threshold, for cuts at which pairs share grams."""
    cut = lowest_ratio(threshold)
    lefts, rights = _texts(left, a), _texts(right, b)
    found = None
    for q, low, high in _totals(cut):
        frequencies = _frequencies(rights, q)
        sides = []
        for texts in (lefts, rights):
            size = F.length("text")
            least = F.greatest(size + _shortest_partner(size, cut), F.lit(low))
            possible = texts.filter(
                (size + _longest_partner(size, cut) >= low) & (size + _shortest_partner(size, cut) < high)
            )
            sides.append(_leading(possible, frequencies, q, _needed(least, cut, q)))
        met = sides[0].withColumnRenamed("text", a).join(sides[1].withColumnRenamed("text", b), "gram")
        short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
        fitting = met.filter(
            (short >= _shortest_partner(long, cut)) & (short + long >= low) & (short + long < high)
        ).select(a, b)
        found = fitting if found is None else found.unionByName(fitting)
    return found.distinct()


def similar_pairs(
    left: DataFrame,
    right: DataFrame,
    a: str,
    b: str,
    threshold: int,
    on: Sequence[str] = (),
) -> DataFrame:
    """Every pair with ratio(a, b) >= threshold, as left and right columns plus
    ``score``. ``on`` adds columns that must be equal; then pairs meet through these alone."""
    cut = lowest_ratio(threshold)
    if on:
        met = left.join(right, list(on))
    elif has_grams(cut):
        met = candidate_pairs(left, right, a, b, threshold).join(left, a).join(right, b)
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(_BLOCKS - 1))).alias("_block")
        blocks = right.withColumn("_block", F.pmod(F.xxhash64(b), F.lit(_BLOCKS)).cast("int"))
        met = left.select("*", every).join(blocks, "_block").drop("_block")
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    fitting = met.filter(short >= _shortest_partner(long, cut))
    return fitting.withColumn("score", ratio(F.col(a), F.col(b))).filter(F.col("score") >= threshold)


BEST_CUTS = (70, 55, 40, 1)
_PER_BLOCK = 512


def best_ratios(
    left: DataFrame, right: DataFrame, a: str, b: str, cuts: Sequence[int] = BEST_CUTS, per_block: int = _PER_BLOCK
) -> DataFrame:
    """(a, score, compared): the best ratio of each text of the left with any of the right, and with how many it was compared.

    Grams say nothing here, so every text of the left has to face every text of the right, in blocks of either
    side, but as counts of characters: two texts match at most as many characters in order as they have in
    common, which bounds the ratio. Of those whose bound reaches the cut the highest bounds are compared first, until the
    best ratio is no lower than the next bound. A best ratio at or above the cut is final, since no
    other pair can reach the cut; its text leaves, and the rest come again with the next cut. The last
    cut should be 1; a text that reaches none of them has no row.
    """
    open_texts, others = _texts(left, a), stored(_texts(right, b))
    sizes = others.count()
    blocks = lambda n: max(1, -(-n // per_block))
    compared = None
    found = None
    for level in cuts:
        open_texts = stored(open_texts)
        count = open_texts.count()
        if not count or not sizes:
            break
        one, two = blocks(count), blocks(sizes)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        salt = lambda n: F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")
        lefts = open_texts.select("text", F.lit(True).alias("left"), salt(one).alias("one"), every(two).alias("two"))
        rights = others.select("text", F.lit(False).alias("left"), every(one).alias("one"), salt(two).alias("two"))
        met = lefts.unionByName(rights).groupBy("one", "two").applyInPandas(best_in_block(level), "text string, score int, compared long")
        best = stored(met.groupBy("text").agg(F.max("score").alias("score"), F.sum("compared").alias("compared")))
        if compared is not None:
            best = best.join(compared.select("text", F.col("compared").alias("before")), "text", "left").select(
                "text", "score", (F.col("compared") + F.coalesce("before", F.lit(0))).alias("compared")
            )
        done = best.filter(F.col("score") >= level)
        found = done if found is None else found.unionByName(done)
        compared = best.filter(F.col("score") < level)
        open_texts = compared.select("text")
    if found is None:
        found = open_texts.select("text", F.lit(0).alias("score"), F.lit(0).cast("long").alias("compared")).limit(0)
    return found.select(F.col("text").alias(a), "score", "compared")


def containing_pairs(left: DataFrame, right: DataFrame, a: str, b: str, threshold: int) -> DataFrame:
    """Every pair whose ratio, or for texts of eight or more characters the best
    ratio of the shorter within the longer, is >= threshold.

    A stretch of the longer text shares its grams with the whole of it, so the
    shorter text's leading grams meet all grams of the longer one. Either side
    may be the shorter; each pair is found in the branch of its length order.
    Identical texts are the caller's exact join, so single characters may be left out.
    """
    cut = lowest_ratio(threshold)

    def branch(short_texts: DataFrame, long_texts: DataFrame, short: str, long: str, strict: bool) -> DataFrame:
        size = F.length("text")
        least = size + _shortest_partner(size, cut)
        # Longer grams as soon as two of them must survive.
        several = F.ceil(least * _share(cut, 3) - 2 - _SLACK) >= 2
        met = None
        for q, chosen in ((2, ~several), (3, several)):
            lead = _leading(short_texts.filter(chosen), _frequencies(long_texts, q), q, _needed(least, cut, q))
            every = long_texts.select(F.col("text").alias(long), F.explode(_grams(F.col("text"), q)).alias("gram"))
            pairs = lead.withColumnRenamed("text", short).join(every, "gram").select(short, long)
            met = pairs if met is None else met.unionByName(pairs)
        in_order = F.length(short) < F.length(long) if strict else F.length(short) <= F.length(long)
        fits = (F.length(short) >= PARTIAL_FROM) | (F.length(short) >= _shortest_partner(F.length(long), cut))
        return met.filter(in_order & fits).distinct().select(a, b)

    lefts, rights = _texts(left, a), _texts(right, b)
    both = branch(lefts, rights, a, b, False).unionByName(branch(rights, lefts, b, a, True))
    scored = both.withColumn("score", likeness(F.col(a), F.col(b))).filter(F.col("score") >= threshold)
    return scored.join(left, a).join(right, b)
