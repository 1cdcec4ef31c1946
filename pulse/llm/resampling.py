"""Drawing documents towards a target's distribution by importance weights.

Features are the runs of `low` to `high` words of a text, hashed into buckets. A bucket's gain
says how much more frequent it is in the target than in the documents; a document's weight is the mean gain of
its features, and its score the weight with Gumbel noise from a hash of its id, so that the highest
scores are a draw without replacement in proportion to the weights.

Texts are read once: every document becomes the array of its buckets (two bytes a feature), from
which counts and then weights are taken by array operations against the table of gains, whose
size is the number of buckets. The cutoff of the draw is found by bracketing: a quantile sketch of the
scores proposes two bounds, exact counts of the rows outside say whether the cutoff is between them, the
bracket is widened until it is, and only its rows are sorted.

Rows are in order of score (highest first), id (null last), and their place in the stored table, which
tells repeated rows apart. Null and empty texts have no features and weight 0; a null id is an empty
text in the hash. Texts of any length are read in stretches. An empty table, or one without documents long
enough, draws nothing; an empty target counts 0 in all buckets. Other columns pass through; where
one has a result's name, that gets underscores. Only the columns in `keep` are stored on the way, so a text is not
written again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, plain
from pulse.llm.ranges import ranked
from pulse.llm.words import LETTERS_AND_DIGITS, word_lists
from pulse.session import cut

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
MARGIN = 0.001
ACCURACY = 10_000
_UNIT = 1000


def features(text: str | None, low: int, high: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words of a text and the buckets of its features."""
    n, found, before = 0, [], []
    for words in word_lists(text, LETTERS_AND_DIGITS):
        n += len(words)
        for k in range(low, high + 1):
            # Runs that end in this stretch; those before it were counted there.
            joined = before[len(before) - min(k - 1, len(before)) :] + words
            runs = joined if k == 1 else [b" ".join(joined[i : i + k]) for i in range(len(joined) - k + 1)]
            found.append(np.fromiter(map(crc32, runs), np.uint32, len(runs)) % np.uint32(buckets))
        before = (before + words)[-(high - 1) :] if high > 1 else []
    return n, np.concatenate(found) if found else np.zeros(0, np.uint32)


def _stored(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def bucketed(texts: DataFrame, text_col: str, low: int, high: int, buckets: int, name: str = "found") -> DataFrame:
    """The rows with a struct of `words` and `buckets`, the latter an array in bytes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [features(t, low, high, buckets) for t in batch]
            yield pd.DataFrame({"words": [n for n, _ in rows], "buckets": [b.astype(_stored(buckets)).tobytes() for _, b in rows]})

    return texts.withColumn(name, F.pandas_udf(run, "words long, buckets binary")(plain(text_col).cast("string")))


def bucket_counts(found: DataFrame, column: str, buckets: int) -> list[int]:
    """Features in each bucket; each task adds up its own arrays."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(buckets, np.int64)
        for frame in frames:
            for data in frame["data"]:
                counts += np.bincount(np.frombuffer(data, _stored(buckets)), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": some, "n": counts[some]})

    rows = found.select(F.col(column).alias("data")).mapInPandas(run, "bucket int, n long")
    counts = [0] * buckets
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """A thousand times the logarithm of how much likelier each bucket is in the target, rounded down."""
    s_all, t_all, size = sum(source), sum(target), len(source)
    return np.array(
        [
            math.floor(_UNIT * math.log(float(t + 1) * float(t_all_s) / (float(s + 1) * float(t_all + size))))
            for s, t in zip(source, target, strict=True)
            for t_all_s in [s_all + size]
        ],
        np.int64,
    )


def scored(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: str = SEED, prefix: str = "", keep: Sequence[str] = (),
) -> DataFrame:
    """The rows, stored, with the columns to keep, n_words, n_features, weight, score and the place `at` of the row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    found = f"{prefix}found"
    kept = list(dict.fromkeys([id_col, *keep]))
    arrays = cut(bucketed(docs, text_col, low, high, buckets, found).select(*[plain(c) for c in kept], found))
    of_target = cut(bucketed(target.select(plain(target_text_col).alias("text")), "text", low, high, buckets).select("found"))
    table = gains(bucket_counts(arrays, f"{found}.buckets", buckets), bucket_counts(of_target, "found.buckets", buckets))

    def weigh(batch: pd.Series) -> pd.Series:
        lists = [np.frombuffer(data, _stored(buckets)) for data in batch]
        return pd.Series([int(table[x].sum()) // len(x) if len(x) else 0 for x in lists], dtype="int64")

    size = F.octet_length(f"{found}.buckets") / F.lit(_stored(buckets).itemsize)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(plain(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-float(_UNIT) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    weighed = arrays.withColumns({
        f"{prefix}n_words": F.col(f"{found}.words"), f"{prefix}n_features": size.cast("long"),
        f"{prefix}weight": F.pandas_udf(weigh, "long")(F.col(f"{found}.buckets")),
        f"{prefix}at": F.monotonically_increasing_id(),
    })
    return cut(weighed.withColumn(f"{prefix}score", F.col(f"{prefix}weight") + noise).drop(found))


def bracket(rows: DataFrame, score: str, draw: int, margin: float = MARGIN, accuracy: int = ACCURACY) -> tuple[DataFrame, int]:
    """Rows among which the `draw`-th highest score is, and how many are above all of them (0 < draw <= rows).

    The sketch's bounds hold if exact counts say so; otherwise the margin grows, at last to all rows.
    """
    total = rows.count()
    share = 1 - (draw - 0.5) / total
    while True:
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = rows.agg(F.percentile_approx(score, ends, accuracy)).first()[0]
        above, inside = rows.agg(F.count_if(F.col(score) > high), F.count_if(F.col(score).between(low, high))).first()
        if above < draw <= above + inside:
            return rows.where(F.col(score).between(low, high)), above
        margin = max(4 * margin, 1 / accuracy)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id",
    margin: float = MARGIN, accuracy: int = ACCURACY, keep: Sequence[str] | None = None, **parameters,
) -> DataFrame:
    """All rows with n_words, n_features, weight, score and rank: 1, 2, 3, ... for the drawn ones, null for others.
    Of the documents' columns all are kept if `keep` is None, else the id and those named."""
    prefix = ""
    names = ["n_words", "n_features", "weight", "score", "rank", "at", "found"]
    while any(prefix + n in docs.columns for n in names):
        prefix += "_"
    rows = scored(docs, target, id_col=id_col, prefix=prefix, keep=docs.columns if keep is None else keep, **parameters)
    score, at, rank = prefix + "score", prefix + "at", prefix + "rank"
    long_enough = rows.where(F.col(prefix + "n_words") >= least_words)
    draw = long_enough.count() * percent // 100
    key = F.struct(-F.col(score), plain(id_col).isNull(), plain(id_col), F.col(at))
    order = [F.col(score).desc(), plain(id_col).asc_nulls_last(), F.col(at)]
    none = F.lit(None).cast("long").alias(rank)
    if not draw:
        return rows.select(*[plain(c) for c in rows.columns if c != at], none)
    around, above = bracket(long_enough.select(plain(id_col), score, at), score, draw, margin, accuracy)
    last = ranked(around, order, "place").where(F.col("place") == draw - above).select(key.alias("key"))
    # The cutoff is one row; its key goes back into the plan as a literal.
    found = last.select("key.*").first()
    is_drawn = _not_behind(rows, found, score, id_col, at) & (F.col(prefix + "n_words") >= least_words)
    flagged = rows.withColumn("drawn_", is_drawn)
    chosen = ranked(flagged.where("drawn_"), order, rank)
    columns = [plain(c) for c in rows.columns if c != at]
    return chosen.select(*columns, rank).union(flagged.where("NOT drawn_").select(*columns, none))


def _not_behind(rows: DataFrame, last, score: str, id_col: str, at: str):
    """Whether a row stands at the cutoff or before it."""
    less, is_null, id_value, place = last
    id_type = rows.schema[id_col].dataType
    limit, here = F.lit(id_value).cast(id_type), plain(id_col)
    if is_null:
        tied = here.isNotNull() | (F.col(at) <= place)
    else:
        tied = F.coalesce((here < limit) | ((here == limit) & (F.col(at) <= place)), F.lit(False))
    return (F.col(score) > -less) | ((F.col(score) == -less) & tied)
