"""Near-duplicate documents by DartMinHash signatures and banded joining.

An element of weight w owns the region [0, w) x [0, infinity) of (position, rank). Darts are thrown by
hash: unit strips of the position axis get arrivals with exponential gaps along the rank axis, each
dart falls on one of `coordinates` coordinates, and a document hits the darts in the regions of its
elements. Its signature is the earliest dart on every coordinate. A document only looks at ranks up
to a bound that shrinks with its total weight, so it sees about k log k darts beside one
arrival for each strip, however large it is (after Christiani, 2020).

Two signatures agree on a coordinate with the probability of the weighted Jaccard similarity.
Documents that agree on all coordinates of a band meet. What meets is compared exactly:
the shared share of the distinct shingles. Links of at least the threshold make classes.

No bucket is compared pair by pair where that can be avoided: equal texts are one
document from the start; then each bucket links its members to one of them, then to the member
with the most links, and only members that are still in different classes are compared with
each other, in blocks of bounded size. The classes are those of all pairs that share a band
(with 24 bands of 5, a pair of similarity 0.8 is missed once in ten thousand times).

Null text counts as empty; texts without words are equal to each other and to nothing else.
Rows with the same text are one class whatever their ids; rows without id take no part and
are kept by `near_dedup`. An id that stands on unrelated texts can name several classes: `component` tells
them apart, and `near_dedup` keeps a row of each. An empty table gives an empty result. Texts of any length are
hashed whole. Other columns pass through or are ignored, whatever their names.

Before members of one bucket in different classes are compared exactly, a sketch of 1,024 bins drops pairs that are four
standard errors below the threshold: of pairs right at it about three in 100,000, fewer above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, components, plain
from pulse.llm.hashing import batches, mixed, shingle_sets, uniform
from pulse.session import cut

BANDS = 24
ROWS = 5
WORDS = 5
THRESHOLD = 0.8
BLOCK = 512
SKETCH = 1024
_SALT = np.uint64(0xD1B54A32D192ED03)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 1 << 15


def throw(elements: np.ndarray, weights: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """The earliest dart on each coordinate, as 32-bit numbers, of many documents at a time.

    `elements` are hashes, `weights` above 0; those of document i stand from first[i] to first[i + 1],
    at least one. Gives (document, coordinate).
    """
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    bound = coordinates * (np.log(coordinates) + 2) / np.add.reduceat(weights, first[:-1])
    strips = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), strips)
    strip = np.arange(len(owner)) - np.repeat(np.cumsum(strips) - strips, strips)
    key = mixed(elements[owner] + strip.astype(np.uint64) * _SALT)
    inside = weights[owner] - strip  # a dart counts if its position in the strip lies below
    live = [key, np.zeros(len(key)), inside, doc[owner], np.zeros(len(key), np.uint64)]
    earliest = np.full(n * coordinates, np.inf)
    dart = np.zeros(n * coordinates, np.uint64)
    while True:
        waiting = []
        while len(live[0]):
            key, rank, inside, doc, thrown = live
            # The next darts of each strip: one if there are many strips, more where few are left.
            more = np.arange(max(1, min(64, _AT_ONCE // len(key))), dtype=np.uint64)
            seed = mixed(key[:, None] + (thrown[:, None] + more + np.uint64(1)) * _GOLDEN)
            arrival = rank[:, None] + np.cumsum(-np.log(uniform(seed)), axis=1)
            early = arrival <= bound[doc][:, None]
            count = early.sum(1)
            row, _ = np.nonzero(early)
            bits, when = mixed(seed[early] ^ _SALT), arrival[early]
            at = ((bits >> np.uint64(32)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64) + doc[row] * coordinates
            if (inside < 1).any():
                hit = uniform(mixed(bits + np.uint64(1))) <= inside[row]
                at, when, bits = at[hit], when[hit], bits[hit]
            before = earliest[at]
            np.minimum.at(earliest, at, when)
            won = (when == earliest[at]) & (when < before)
            dart[at[won]] = bits[won]
            reached = np.where(count > 0, arrival[np.arange(len(key)), np.maximum(count, 1) - 1], rank)
            live = [key, reached, inside, doc, thrown + count.astype(np.uint64)]
            done = count < len(more)
            waiting.append([x[done] for x in live])
            live = [x[~done] for x in live]
        # Documents with a coordinate that no dart has hit look at higher ranks.
        open_docs = np.isinf(earliest.reshape(n, coordinates)).any(1)
        if not open_docs.any():
            return (dart & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(n, coordinates)
        bound[open_docs] *= 2
        rest = [np.concatenate(x) for x in zip(*waiting, strict=True)]
        again = open_docs[rest[3]]
        live = [x[again] for x in rest]


def signatures(texts: DataFrame, words: int, coordinates: int, count_repeats: bool) -> DataFrame:
    """(id, x, y, shingles, signature) of (id, text): two hashes of the text, its sorted distinct
    shingles as 32-bit numbers, and the darts. Texts without words are equal and have no signature."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    hashed = texts.select(
        "id",
        F.when(blank, 0).otherwise(F.xxhash64("text")).alias("x"),
        F.when(blank, 0).otherwise(F.xxhash64(F.lit(1), "text")).alias("y"),
        "text",
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for low, high in batches(texts):
                found, counts, first = shingle_sets(texts[low:high], words)
                some = np.flatnonzero(np.diff(first))
                darts = np.full(high - low, None, object)
                if len(some):
                    weights = counts.astype(np.float64) if count_repeats else np.ones(len(found))
                    rows = throw(found, weights, np.append(first[some], len(found)), coordinates)
                    darts[some] = [r.tobytes() for r in rows]
                short = (found >> np.uint64(32)).astype("<u4")
                elements = [np.unique(short[a:b]).tobytes() for a, b in zip(first, first[1:], strict=False)]
                yield frame[["id", "x", "y"]][low:high].assign(shingles=elements, signature=darts)

    return hashed.mapInPandas(run, "id long, x long, y long, shingles binary, signature binary")


def _jaccard(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b) of texts t those whose shingles are similar enough."""
    left = texts.select(F.col("t").alias("a"), F.col("shingles").alias("left"))
    right = texts.select(F.col("t").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x), bool)
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            p, q = np.frombuffer(p, "<u4"), np.frombuffer(q, "<u4")
            if min(len(p), len(q)) >= threshold * max(len(p), len(q)):
                shared = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                out[i] = shared >= threshold * (len(p) + len(q) - shared) - 1e-9
        return pd.Series(out)

    return both.where(similar("left", "right")).select("a", "b")


def sketches(texts: DataFrame) -> DataFrame:
    """(t, sketch): the smallest shingle of each of SKETCH bins, as its last byte and whether there is one.

    Of a text with few shingles the bins hold nearly all of them, of a long one a sample.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for shingles in frame["shingles"]:
                values = np.frombuffer(shingles, "<u4")
                bins = np.zeros(SKETCH, "<u2")
                # In falling order, so that the smallest of a bin is written last.
                mix = (values[::-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                bins[(mix % np.uint64(SKETCH)).astype(np.int64)] = (mix >> np.uint64(20)).astype("<u2") & 255 | 256
                out.append(bins.tobytes())
            yield pd.DataFrame({"t": frame["t"], "sketch": out})

    return texts.select("t", "shingles").mapInPandas(run, "t long, sketch binary")


def _cross_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts of one bucket, in different classes, whose sketches are similar enough.

    `members` are (bucket, t, class, signature, sketch). Those outside the largest class of their
    bucket meet all members, in blocks of about BLOCK on either side; a pair that shares several
    buckets is given by one of them. Four standard errors below the threshold are enough.
    """
    least = threshold - 4 * np.sqrt(threshold * (1 - threshold) / SKETCH)
    by_class = members.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    sizes = by_class.groupBy("bucket").agg(
        F.max(F.struct("n", "class")).alias("most"), F.sum("n").alias("members")
    ).select(
        "bucket", F.col("most.class").alias("main"),
        F.ceil((F.col("members") - F.col("most.n")) / BLOCK).cast("int").alias("one_blocks"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("two_blocks"),
    )
    rows = members.join(sizes, "bucket")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    salt = lambda n: F.pmod(F.xxhash64("t"), F.col(n)).cast("int")
    own = ["bucket", "t", "class", "signature", "sketch"]
    ones = rows.where("class <> main").select(*own, salt("one_blocks").alias("one"), numbers("two_blocks").alias("two"), F.lit(True).alias("left"))
    twos = rows.select(*own, numbers("one_blocks").alias("one"), salt("two_blocks").alias("two"), F.lit(False).alias("left"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["left"]], frame[~frame["left"]]
        out = [np.zeros((0, 2), np.int64)]
        if len(left) and len(right):
            y = np.array([np.frombuffer(s, "<u2") for s in right["sketch"]])
            full = y > 0
            bands = np.array([np.frombuffer(s, f"S{4 * ROWS}") for s in right["signature"]])
            ids, kinds = right["t"].to_numpy(), right["class"].to_numpy()
            band = int(frame["bucket"].iloc[0].split(":")[0])
            for t, kind, signature, sketch in zip(*[left[c] for c in ("t", "class", "signature", "sketch")], strict=True):
                x = np.frombuffer(sketch, "<u2")
                has = x > 0
                same = (y[:, has] == x[has]).sum(1)
                good = (same >= least * (full.sum(1) + has.sum() - full[:, has].sum(1))) & (kinds != kind)
                good = np.flatnonzero(good)
                first = (bands[good] == np.frombuffer(signature, f"S{4 * ROWS}")).argmax(1)
                good = ids[good[first == band]]
                out.append(np.stack([np.minimum(good, t), np.maximum(good, t)], 1))
        rows = np.concatenate(out)
        return pd.DataFrame({"a": rows[:, 0], "b": rows[:, 1]})

    return ones.union(twos).groupBy("bucket", "one", "two").applyInPandas(compare, "a long, b long").distinct()


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    bands: int = BANDS,
    count_repeats: bool = False,
) -> DataFrame:
    """(id, x, y, class, component, n_copies, n_links) of every row with an id: two hashes of the text, the
    smallest id of its class, a number of the class that no other class has, the rows with exactly its text,
    and the different texts found to be linked to it.

    `count_repeats` weighs a shingle by its occurrences, in the signatures alone: what meets is
    always compared by distinct shingles.
    """
    bounded_batches(docs.sparkSession)
    coordinates = bands * ROWS
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).where("id IS NOT NULL")
    # t numbers the rows of the written table; copies of a text go by the number of one of them.
    base = cut(signatures(rows, words, coordinates, count_repeats).withColumn("t", F.monotonically_increasing_id()))
    copies = base.groupBy("x", "y").agg(F.min(F.struct("id", "t")).alias("first"), F.count("*").alias("n_copies"))
    members = cut(base.select("id", "x", "y").join(copies, ["x", "y"]))
    chosen = copies.select(F.col("first.t").alias("t"))
    signed = cut(base.where("signature IS NOT NULL").select("t", "signature").join(chosen, "t", "left_semi"))
    width = 4 * ROWS
    bucket = F.expr(
        f"transform(sequence(0, {bands - 1}), i -> concat(i, ':', hex(substring(signature, i * {width} + 1, {width}))))"
    )
    banded = signed.select("t", F.explode(bucket).alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("t").alias("hub")).where("n > 1").drop("n")
    buckets = cut(banded.join(crowded, "bucket"))
    # Only texts that met somebody are compared: their shingles are moved once and kept apart.
    shingles = cut(base.select("t", "shingles").join(buckets.select("t").distinct(), "t", "left_semi"))
    stars = buckets.where("t <> hub").select(F.col("hub").alias("a"), F.col("t").alias("b")).distinct()
    tried = cut(stars)
    links = cut(_jaccard(tried, shingles, threshold))
    for _ in range(2):
        # Members of a bucket that are still in different classes are led to its member with the most links.
        degree = links.select(F.explode(F.array("a", "b")).alias("t")).groupBy("t").agg(F.count("*").alias("degree"))
        state = _with_class(buckets.select("bucket", "t"), links).join(degree, "t", "left").fillna(0, ["degree"])
        hub = F.max(F.struct("degree", "t", "class")).alias("hub")
        low_high = F.min("class").alias("low"), F.max("class").alias("high")
        mixed_up = state.groupBy("bucket").agg(*low_high, hub).where("low <> high").select(
            "bucket", F.col("hub.t").alias("hub"), F.col("hub.class").alias("hub_class")
        )
        more = state.join(mixed_up, "bucket").where("class <> hub_class").select(
            F.least("hub", "t").alias("a"), F.greatest("hub", "t").alias("b")
        )
        more = cut(more.distinct().join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(more)
        links = cut(links.union(_jaccard(more, shingles, threshold)))
    state = cut(_with_class(buckets.select("bucket", "t"), links))
    unsettled = state.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    open_rows = cut(state.join(unsettled.select("bucket"), "bucket"))
    open_texts = open_rows.select("t").distinct()
    known = sketches(shingles.join(open_texts, "t", "left_semi")).join(signed, "t")
    rest = cut(_cross_pairs(open_rows.join(known, "t"), threshold).join(tried, ["a", "b"], "left_anti"))
    links = cut(links.union(_jaccard(rest, shingles, threshold)))
    degree = links.select(F.explode(F.array("a", "b")).alias("t")).groupBy("t").agg(F.count("*").alias("n_links"))
    firsts = cut(_with_class(members.select(F.col("first.t").alias("t"), F.col("first.id").alias("first_id")).distinct(), links))
    names = firsts.groupBy("class").agg(F.min("first_id").alias("class_id"))
    named = firsts.join(names, "class").join(degree, "t", "left").select(
        "t", F.col("class_id").alias("class"), F.col("class").alias("component"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    columns = ["id", "x", "y", "class", "component", "n_copies", "n_links"]
    return members.withColumn("t", F.col("first.t")).join(named, "t").select(*columns)


def _with_class(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`class` of the text t: its component's smallest number, or its own."""
    found = components(links).withColumnRenamed("id", "t")
    return rows.join(found, "t", "left").withColumn("class", F.coalesce("component", "t")).drop("component")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows without copies and near copies: of each class the row with its smallest id stays.

    Rows that repeat an id and a text are one; which of their other columns stay is decided by
    order. Rows without id all stay.
    """
    found = cut(classes(docs, id_col, text_col, **parameters))
    kept = found.where("id = class").groupBy("component", "id", "x", "y").agg(F.count("*").alias("rows"))
    # One id with several texts in its class: the smallest hash. One id that names several classes: each stays.
    kept = cut(kept.groupBy("component").agg(F.min(F.struct("id", "x", "y", "rows")).alias("k")).select("k.*"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    # The row is one struct column, so that its columns may have any names.
    prepared = docs.select(
        F.struct(*[plain(c) for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.when(blank, 0).otherwise(F.xxhash64(text)).alias("x"),
        F.when(blank, 0).otherwise(F.xxhash64(F.lit(1), text)).alias("y"),
    )
    names = ["id", "x", "y"]
    once = prepared.join(kept.where("rows = 1"), names, "left_semi").select("row.*")
    result = once.unionByName(prepared.where("id IS NULL").select("row.*"))
    repeated = kept.where("rows > 1")
    if not repeated.isEmpty():
        many = prepared.join(repeated, names).groupBy(*names).agg(F.min("row").alias("row"))
        result = result.unionByName(many.select("row.*"))
    return result
