"""How sources of a language differ from each other and from the language in their terms.

Terms are runs of letters and other non-ASCII characters, A-Z lower-cased: one translate table lowers
letters and blanks separators in one pass, a split gives the terms, and a Counter of each document its
frequencies. Tasks add these up by (lang, source) before anything is shuffled, so that a
row that leaves a task is a term of a group and not of a document.

Each language keeps the terms that stand in at least `least_docs` of its documents. A group's share of a kept
term is p = 1 + floor(1e9 * (count + 2) / (N + 2 V)), N its occurrences of kept terms, V the language's kept
terms; the divergence of two shares is floor((p - q)^2 / (p + q)). All of it is exact arithmetic in integers and
decimals.

A group's terms against its language are a join and the highest ten, which Spark cuts to ten in
each task before the shuffle. Sources against each other are all pairs of a language by what is asked, so they
are taken in blocks: sources are dealt over blocks and terms over chunks by hash, a task has the
terms of one chunk in two blocks of sources as two matrices, and gives a sum for each pair. Terms
that neither block has differ by a constant, which is added at the end.

Null text, lang and source are empty texts. A group without terms has only its pseudo-counts. Repeated rows count
as often as they occur. Long texts are read in stretches; a document's counter has as many entries as
it has distinct terms. Values that tie go by the bytes of the item. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, plain
from pulse.llm.words import LETTERS, word_lists
from pulse.session import cut

LEAST_DOCS = 10
TOP = 10
SOURCES_PER_BLOCK = 64
TERMS_PER_CHUNK = 4096
_UNIT = 1_000_000_000
_HELD = 400_000


def _count_terms(held: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        documents: dict[tuple, Counter] = defaultdict(Counter)
        repeats: dict[tuple, Counter] = defaultdict(Counter)  # occurrences beyond the first of a document

        def flush() -> Iterator[pd.DataFrame]:
            rows = [
                (lang, source, term.decode("utf-8", "surrogatepass"), n + repeats[lang, source][term], n)
                for (lang, source), terms in documents.items() for term, n in terms.items()
            ]
            documents.clear()
            repeats.clear()
            if rows:
                yield pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

        for frame in frames:
            for lang, source, text in zip(frame["lang"], frame["source"], frame["text"], strict=True):
                terms: Counter = Counter()
                for words in word_lists(text, LETTERS):
                    terms.update(words)
                documents[lang, source].update(terms.keys())
                more = repeats[lang, source]
                for term, n in terms.items():
                    if n > 1:
                        more[term] += n - 1
            if sum(map(len, documents.values())) > held:
                yield from flush()
        yield from flush()

    return run


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, held: int = _HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group."""
    bounded_batches(docs.sparkSession)
    named = docs.select(*[
        F.coalesce(plain(c).cast("string"), F.lit("")).alias(a)
        for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    counted = named.mapInPandas(_count_terms(held), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count in a group of so many occurrences, in decimals, since the product passes 64 bits."""
    wide = "decimal(20,0)"
    floor = F.call_function("div", F.lit(_UNIT).cast("decimal(10,0)") * (count + 2).cast(wide), (total + 2 * terms).cast(wide))
    return F.when(total + 2 * terms > 0, floor + 1).otherwise(1).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over one chunk's terms for the pairs between two blocks of sources; rows without term are the groups."""
    groups = frame[frame["term"].isna()].sort_values("source")
    counted = frame[frame["term"].notna()]
    names = groups["source"].to_numpy()
    base = groups["p"].to_numpy(np.int64)
    term, kinds = pd.factorize(counted["term"])
    p = np.repeat(base[:, None], len(kinds), 1)
    p[np.searchsorted(names.astype(str), counted["source"].to_numpy(str)), term] = counted["p"].to_numpy(np.int64)
    block = groups["block"].to_numpy()
    low, high = int(frame["low"].iloc[0]), int(frame["high"].iloc[0])
    out = []
    for a in np.flatnonzero(block == low):
        others = np.flatnonzero((block == high) & ((np.arange(len(names)) > a) if low == high else True))
        if not len(others):
            continue
        gap = p[others] - p[a]
        value = (gap * gap // (p[others] + p[a])).sum(1)
        gap = base[others] - base[a]
        out.append(pd.DataFrame({
            "source": names[a], "item": names[others], "value": value, "terms": len(kinds),
            "rest": gap * gap // (base[others] + base[a]),
        }))
    columns = ["lang", "source", "item", "value", "terms", "rest"]
    if not out:
        return pd.DataFrame(columns=columns)
    return pd.concat(out).assign(lang=frame["lang"].iloc[0])[columns]


def source_pairs(
    sparse: DataFrame, groups: DataFrame, sources_per_block: int = SOURCES_PER_BLOCK, terms_per_chunk: int = TERMS_PER_CHUNK
) -> DataFrame:
    """(lang, source, item, value) of both orders of all pairs of sources of a language.

    `sparse`: lang, source, term, p of the terms that a group has. `groups`: lang, source, p of a
    count of 0, terms (V) and the language's number of groups.
    """
    blocks = F.ceil(F.col("groups") / sources_per_block)
    chunks = F.greatest(F.lit(1), F.ceil(F.col("terms") / terms_per_chunk))
    placed = groups.select(
        "lang", "source", "p", blocks.alias("blocks"), chunks.alias("chunks"), F.pmod(F.xxhash64("source"), blocks).alias("block")
    )
    of_group = placed.select(
        "*", F.lit(None).cast("string").alias("term"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    )
    of_term = sparse.join(placed.drop("p"), ["lang", "source"]).withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    rows = of_group.unionByName(of_term.select(*of_group.columns))
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    sums = (
        spread.select("lang", "source", "term", "p", "block", "low", "high", "chunk")
        .groupBy("lang", "low", "high", "chunk")
        .applyInPandas(_pair_block, "lang string, source string, item string, value long, terms long, rest long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"), F.sum("terms").alias("met"), F.max("rest").alias("rest"))
    )
    langs = groups.groupBy("lang").agg(F.max("terms").alias("terms"))
    value = F.col("value") + (F.col("terms") - F.col("met")) * F.col("rest")
    pairs = sums.join(langs, "lang").select("lang", "source", "item", value.alias("value"))
    return pairs.union(pairs.select("lang", F.col("item"), F.col("source"), "value"))


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS,
    top: int = TOP, sources_per_block: int = SOURCES_PER_BLOCK, terms_per_chunk: int = TERMS_PER_CHUNK,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group: part `pair` has all other sources of its language, part
    `term` its `top` terms that are more frequent than in the language."""
    counted = cut(term_counts(docs, lang_col, source_col, text_col))
    of_lang = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = cut(of_lang.where(F.col("docs") >= least_docs).drop("docs"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    here = cut(counted.drop("docs").join(kept, ["lang", "term"]))
    totals = here.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select(*[
        F.coalesce(plain(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))
    ]).distinct()
    sizes = named.groupBy("lang").agg(F.count("*").alias("groups"))
    groups = cut(
        named.join(totals, ["lang", "source"], "left").join(terms, "lang", "left").join(sizes, "lang")
        .fillna(0, ["total", "terms", "lang_total"])
    )
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    sparse = cut(here.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")))
    base = groups.withColumn("p", share(F.lit(0), F.col("total"), F.col("terms")))
    pairs = source_pairs(sparse.drop("q"), base, sources_per_block, terms_per_chunk)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    by_pair = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)}).select(*columns)
    own = sparse.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    by_term = own.withColumns({"part": F.lit("term"), "rank": F.row_number().over(order)}).where(F.col("rank") <= top)
    return by_pair.union(by_term.select(*columns))
