"""String similarity on matched characters in order (longest common subsequence).

ratio = 200 * LCS / (len a + len b), rounded half to even. Spark's own
``levenshtein`` prices a substitution at 1 and gives other numbers, so this is
one of the few places that leaves the JVM, in Arrow batches and only for pairs
that native filters could not rule out.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTIAL_FROM = 8  # fixed value: both texts at least this long


def _masks(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def lcs_length(masks: dict[str, int], size: int, other: str) -> int:
    """Bit-parallel LCS (Hyyrö 2004): one word operation per character."""
    full = (1 << size) - 1
    row = full
    for ch in other:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if not total:
        return 100.0
    return 200.0 * lcs_length(_masks(b), len(b), a) / total


def window_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any stretch of the longer one that
    is as long, or shorter at either end."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    best = _best_window(short, long)
    if len(a) == len(b) and best < 100.0:
        best = max(best, _best_window(long, short))
    return best


def _best_window(short: str, long: str) -> float:
    size, masks = len(short), _masks(short)
    best = 0.0
    for start in range(1 - size, len(long)):
        piece = long[max(start, 0) : start + size]
        if 2.0 * len(piece) / (size + len(piece)) * 100 <= best:
            continue
        best = max(best, 200.0 * lcs_length(masks, size, piece) / (size + len(piece)))
    return best


@F.pandas_udf(T.IntegerType())
def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    cache: dict[str, dict[str, int]] = {}
    scores = []
    for a, b in zip(left, right, strict=True):
        masks = cache.get(b)
        if masks is None:
            masks = cache[b] = _masks(b)
        total = len(a) + len(b)
        scores.append(round(200.0 * lcs_length(masks, len(b), a) / total) if total else 100)
    return pd.Series(scores, dtype="int32")


@F.pandas_udf(T.IntegerType())
def likeness(left: pd.Series, right: pd.Series) -> pd.Series:
    """The ratio, or for longer texts the best stretch if that is higher."""
    scores = []
    for a, b in zip(left, right, strict=True):
        score = round(indel_ratio(a, b))
        if min(len(a), len(b)) >= PARTIAL_FROM:
            score = max(score, round(window_ratio(a, b)))
        scores.append(score)
    return pd.Series(scores, dtype="int32")


def _counts(texts: list[str], alphabet: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(texts), len(alphabet)), np.int16)
    for i, text in enumerate(texts):
        for c, n in Counter(text).items():
            out[i, alphabet[c]] = n
    return out


def best_in_block(level: int):
    """For a block of texts on the left and one on the right: of each left text the best ratio of at least the level
    (or 0) and how many were compared to find it."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lefts, rights = frame["text"][frame["left"]].tolist(), frame["text"][~frame["left"]].tolist()
        alphabet = {c: i for i, c in enumerate(sorted(set().union(*lefts, *rights)))}
        ours, theirs = _counts(lefts, alphabet), _counts(rights, alphabet)
        sizes = np.array([len(t) for t in rights])
        rows = []
        for text, own in zip(lefts, ours, strict=True):
            total = sizes + len(text)
            common = np.minimum(own, theirs).sum(1, dtype=np.int64) if rights else np.zeros(0)
            # Two empty texts are alike.
            bound = np.rint(np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100))
            best = compared = 0
            masks = _masks(text)
            for i in np.argsort(-bound, kind="stable"):
                if bound[i] < level or bound[i] <= best:
                    break
                compared += 1
                best = max(best, round(200.0 * lcs_length(masks, len(text), rights[i]) / total[i]) if total[i] else 100)
            rows.append((text, best if best >= level else 0, compared))
        return pd.DataFrame(rows, columns=["text", "score", "compared"])

    return run


_FOLDED_AT_ONCE = 64


@F.arrow_udf(T.StringType())
def fold_width(text: pa.Array) -> pa.Array:
    """NFKC, for which Spark has no built-in. Few texts at a time are Python's; the rest of a batch stays in Arrow."""
    folded = [pa.array([], pa.string())]
    for i in range(0, len(text), _FOLDED_AT_ONCE):
        texts = text.slice(i, _FOLDED_AT_ONCE).to_pylist()
        folded.append(pa.array([t if t is None else unicodedata.normalize("NFKC", t) for t in texts], pa.string()))
    return pa.concat_arrays(folded)
