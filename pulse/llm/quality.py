"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded (hashed byte trigrams, character
classes and repetition, then a dense layer); a gated attention gives each a weight, and the
weighted mean of the encodings is scored. Only documents are labelled: the attention learns
from them which passages matter (Ilse, Tomczak and Welling, 2018).

Encoding works on whole batches of bytes in numpy, and the score of a document needs nothing
but its text, so scoring is one pass without a shuffle. Null and empty texts are one passage
without any bytes and get its score. Rows are scored one by one: repeated rows get equal
scores, an empty table gives none. Without labels of both kinds every score is 0.5. Texts of any length are
scored whole. Other columns pass through, and one with the name of the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches
from pulse.llm.hashing import batches, mixed, prefix_sums, stretches, word_spans
from pulse.session import cut

PASSAGE = 1024
TRIGRAMS = 256
HIDDEN = 32
HELD_OUT = 2
SHRINK = 400

_KINDS = 10


def _kind_table() -> np.ndarray:
    """Classes of bytes: letters by case, digits, white space, sentence marks, brackets, others, non-ASCII."""
    kind = np.full(256, 7, np.int64)
    kind[list(range(97, 123))] = 0
    kind[list(range(65, 91))] = 1
    kind[list(range(48, 58))] = 2
    kind[[9, 11, 12, 13, 32]] = 3
    kind[10] = 4
    kind[list(b".,;:?'\"-")] = 5
    kind[list(b"()[]{}<>/\\|=_")] = 6
    kind[list(b"!")] = 8
    kind[128:] = 9
    return kind


_KIND = _kind_table()
DIMENSIONS = TRIGRAMS + _KINDS + 3


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of the texts, and where each text's passages start (with the end)."""
    data = [t.encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    counts = -(-sizes // PASSAGE)
    first = np.concatenate([[0], np.cumsum(counts)])
    joined = np.frombuffer(b"".join(data), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    total = int(first[-1])
    # Byte i of a text of k passages lies in passage i * k // size: passages of nearly equal length.
    doc = np.repeat(np.arange(len(texts)), sizes)
    within = np.arange(len(joined)) - begin[doc]
    passage = first[doc] + within * counts[doc] // sizes[doc]
    features = np.zeros((total, DIMENSIONS), np.float32)
    length = np.bincount(passage, minlength=total)
    # Frequencies of a short passage are drawn towards none: it tells little.
    scale = length[:, None] + SHRINK
    kinds = np.bincount(passage * _KINDS + _KIND[joined], minlength=total * _KINDS).reshape(total, _KINDS)
    features[:, TRIGRAMS : TRIGRAMS + _KINDS] = np.sqrt(kinds / scale)
    if len(joined) > 2:
        wide = joined.astype(np.uint32)
        code = wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D)
        code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(24)
        same = doc[:-2] == doc[2:]
        grams = np.bincount((passage[:-2] * TRIGRAMS + code)[same], minlength=total * TRIGRAMS)
        features[:, :TRIGRAMS] = np.sqrt(grams.reshape(total, TRIGRAMS) / scale)
    start, end = word_spans(joined)
    if len(start):
        at = passage[start]
        ids = stretches(prefix_sums(joined), start, end)
        words = np.bincount(at, minlength=total)
        _, one = np.unique(mixed(ids ^ mixed(at.astype(np.uint64))), return_index=True)
        many = np.maximum(words, 1)
        features[:, -3] = np.bincount(at[one], minlength=total) / many
        features[:, -2] = np.bincount(at, weights=end - start, minlength=total) / many / 10
        features[:, -1] = words / length * 5
    return features, first


@dataclass
class Model:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the score (c, d)."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        starts, sizes = first[:-1], np.diff(first)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        s = (v * u) @ p["a"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[doc])
        share = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(share[:, None] * h, starts)
        return {"doc": doc, "h": h, "v": v, "u": u, "share": share, "z": z, "p": _sigmoid(z @ p["c"] + p["d"])}

    def score(self, texts: list[str]) -> np.ndarray:
        x, first = passages(texts)
        return self.forward((x.astype(np.float64) - self.mean) / self.spread, first)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gradients(model: Model, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    p, f = model.weights, model.forward(x, first)
    doc, h, v, u, share = f["doc"], f["h"], f["v"], f["u"], f["share"]
    error = (f["p"] - y) / len(y)
    dz = error[:, None] * p["c"]
    dh = share[:, None] * dz[doc]
    towards = (h * dz[doc]).sum(1)
    ds = share * (towards - np.add.reduceat(share * towards, first[:-1])[doc])
    dgate = ds[:, None] * p["a"]
    dv, du = dgate * u * (1 - v * v), dgate * v * u * (1 - u)
    dpre = (dh + dv @ p["v"].T + du @ p["u"].T) * (1 - h * h)
    return {
        "w": x.T @ dpre, "b": dpre.sum(0), "v": h.T @ dv, "u": h.T @ du,
        "a": (v * u).T @ ds, "c": f["z"].T @ error, "d": error.sum(),
    }


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 25, batch: int = 128, seed: int = 7) -> Model:
    """Adam on the log loss of the documents; nothing but their labels is known of the passages. Scales x in place."""
    rng = np.random.default_rng(seed)
    mean, spread = x.mean(0), x.std(0) + np.float32(0.01)
    x -= mean
    x /= spread
    gate = HIDDEN // 2
    shape = {"w": (x.shape[1], HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, gate), "u": (HIDDEN, gate), "a": (gate,), "c": (HIDDEN,), "d": ()}
    weights = {k: rng.normal(size=s) / np.sqrt(s[0] if s else 1) * (k not in "bd") for k, s in shape.items()}
    model = Model(mean, spread, weights)
    moment = {k: np.zeros(s) for k, s in shape.items()}
    square = {k: np.zeros(s) for k, s in shape.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = first[rows + 1] - first[rows]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            pick = np.repeat(first[rows] - begin[:-1], sizes) + np.arange(begin[-1])
            step += 1
            for k, g in _gradients(model, x[pick], begin, y[rows]).items():
                g = g + 1e-4 * weights[k]
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] = weights[k] - rate * moment[k] / (np.sqrt(square[k]) + 1e-8)
    return model


def fold(doc_id: Column) -> Column:
    """0 to 3; rows of fold 2 are held out. Without an id there is no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_documents: int = 6000,
    max_passages: int = 32_768,
) -> Model | None:
    """Fit on at most `max_documents` labelled documents outside the held-out fold, chosen by a hash of the
    id, with all their passages. In the order of the hash each is taken whole if it still fits into
    `max_passages` passages, half of them for either label and then what is left for both. Only their
    features reach the driver.

    Labels of one id are averaged, null labels are none. None if there are not labels of both kinds; an error if
    there are, but all texts of one are too long to be taken.
    """
    bounded_batches(docs.sparkSession)
    key = F.col(id_col).cast("long")
    known = (
        labels.select(key.alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .where(F.col("label").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_documents)
    )
    texts = docs.select(key.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # At most max_documents rows of two numbers.
    sample = texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in batches(frame["text"].tolist()):
                x, first = passages(frame["text"].tolist()[a:b])
                fits = [(s, e) if e - s <= max_passages else (s, s) for s, e in zip(first, first[1:], strict=False)]
                bags = [x[s:e].astype("<f4").tobytes() for s, e in fits]
                yield pd.DataFrame({"doc_id": frame["doc_id"][a:b], "label": frame["label"][a:b], "x": bags})

    encoded = sample.mapInPandas(encode, "doc_id long, label int, x binary").where("length(x) > 0")
    # Copies of one id would let the sample grow with the data: one text of each stays.
    bags = cut(encoded.groupBy("doc_id").agg(F.max(F.struct("label", "x")).alias("bag")).select("doc_id", "bag.*"))
    size = (F.length("x") / (4 * DIMENSIONS)).cast("long").alias("size")
    sizes = bags.select("doc_id", "label", size).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    taken = docs.sparkSession.createDataFrame([(d,) for d in _chosen(sizes, max_passages)], "doc_id long")
    bags = bags.join(F.broadcast(taken), "doc_id").orderBy("doc_id").toArrow()
    y = bags["label"].to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        kinds = texts.join(F.broadcast(known), "doc_id").agg(F.count_distinct("label")).first()[0]
        if kinds > 1:
            raise ValueError(f"no labelled text of one kind has at most {max_passages // 2} passages: raise max_passages")
        return None
    x = [np.frombuffer(b.as_buffer(), "<f4").reshape(-1, DIMENSIONS) for b in bags["x"]]
    first = np.concatenate([[0], np.cumsum([len(b) for b in x])])
    return fit(np.concatenate(x), first, y)


def _chosen(sizes: list[tuple[int, int, int]], most: int) -> list[int]:
    """Of (id, label, passages) the ids of those that fit, each label into its half and the rest into what is left."""
    taken: dict[int, int] = {}
    for label in (0, 1):
        room = most // 2
        for doc_id, kind, size in sizes:
            if kind == label and size <= room:
                taken[doc_id] = size
                room -= size
    room = most - sum(taken.values())
    for doc_id, _, size in sizes:
        if doc_id not in taken and size <= room:
            taken[doc_id] = size
            room -= size
    return list(taken)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """The rows with one more column: the probability that the whole text is of label 1."""
    clash = name in docs.columns
    rows = docs.drop(name) if clash else docs
    if model is None:
        return rows.withColumn(name, F.lit(0.5))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        texts = texts.fillna("").tolist()
        parts = [model.score(texts[a:b]) for a, b in batches(texts)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return rows.withColumn(name, scored(F.col(text_col).cast("string")))
