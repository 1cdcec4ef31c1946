import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import quality
from pulse.llm.common import table
from tests.conftest import SF_DIR

DATA = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(table(spark, DATA, "documents"), table(spark, DATA, "labels"))


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    scored = quality.score(docs.join(labels.select("doc_id", "quality"), "doc_id"), model)
    rows = scored.where(quality.fold(F.col("doc_id")) == quality.HELD_OUT).select("quality", "score").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert ((s >= 0.7) == y).mean() > 0.93
    good, bad = s[y == 1], s[y == 0]
    assert (good[:, None] > bad).mean() > 0.98


def test_scores_depend_on_the_text_alone(spark, model):
    rows = [(1, "Plain words in a row.", "a"), (2, "Plain words in a row.", "b"), (3, None, "c"), (4, "", "d"), (5, "x" * 300_000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert got[1] == pytest.approx(got[2], abs=1e-9) and got[3] == pytest.approx(got[4], abs=1e-9)
    assert all(0 <= v <= 1 for v in got.values())
    alone = model.score(["Plain words in a row."])[0]
    assert alone == pytest.approx(got[1], abs=1e-9)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, labels) is None
    assert [r.score for r in quality.score(docs, None).collect()] == [0.5]
    assert quality.score(docs.limit(0), None).count() == 0


def test_held_out_labels_are_not_learned(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == quality.HELD_OUT]
    docs = spark.createDataFrame([(i, "some text") for i in held], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in held], "doc_id long, quality int")
    assert quality.train(docs, labels) is None


def test_all_passages_of_a_document_are_learned(spark, monkeypatch):
    learned = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != quality.HELD_OUT][:12]
    sizes = {d: 100 * 1024 - 1 if k == 0 else (1 + k % 3) * 1024 - 1 for k, d in enumerate(learned)}
    docs = spark.createDataFrame([(d, "ab c " * (n // 5) + "x" * (n % 5)) for d, n in sizes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(d, k % 2) for k, d in enumerate(learned)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "fit", lambda x, first, y: (len(x), np.diff(first).tolist()))
    full = [(n + 1) // 1024 for _, n in sorted(sizes.items())]
    assert quality.train(docs, labels) == (sum(full), full)
    # Fewer documents, but whole ones; a text above the bound goes alone.
    total, some = quality.train(docs, labels, max_passages=12)
    rest = iter(full)
    assert 9 < total <= 12 and all(n in rest for n in some) and 100 not in some


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    x, first = rng.normal(size=(12, quality.DIMENSIONS)), np.array([0, 3, 4, 12])
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fit(x, first, y, epochs=1)
    z = (x - model.mean) / model.spread

    def loss():
        p = model.forward(z, first)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, gradient in quality._gradients(model, z, first, y).items():
        weight = model.weights[name] = np.array(model.weights[name], float)
        at = (0,) * weight.ndim
        slope = []
        for step in (1e-5, -1e-5):
            weight[at] += step
            slope.append(loss())
            weight[at] -= step
        assert np.asarray(gradient)[at] == pytest.approx((slope[0] - slope[1]) / 2e-5, abs=1e-6)


def test_giant_texts_keep_no_others_from_the_fit(spark, monkeypatch):
    """The two first by hash don't fit together; both labels are learned from those after them."""
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 4 != quality.HELD_OUT]
    order = [r.doc_id for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").orderBy(F.xxhash64("doc_id")).collect()]
    passages = {d: 20 if k < 2 else 1 + k % 2 for k, d in enumerate(order)}
    docs = spark.createDataFrame([(d, "x" * (n * 1024 - 1)) for d, n in passages.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(k in (1, 5, 9))) for k, d in enumerate(order)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "fit", lambda x, first, y: (sorted(np.diff(first).tolist()), y.sum()))
    sizes, good = quality.train(docs, labels, max_passages=32)
    assert sum(sizes) <= 32 and len(sizes) > 10 and good >= 2
    with pytest.raises(ValueError, match="passages"):
        quality.train(docs, labels.where(F.col("doc_id").isin(order[1:5:1]) ), max_passages=8)


def test_chosen_documents_fit():
    sizes = [(1, 0, 90), (2, 1, 90), (3, 0, 10), (4, 1, 10), (5, 0, 45), (6, 1, 45), (7, 0, 1)]
    assert sorted(quality._chosen(sizes, 100)) == [3, 4, 5, 7]
    assert sorted(quality._chosen(sizes, 400)) == [1, 2, 3, 4, 5, 6, 7]
    assert quality._chosen([], 10) == []


def test_score_is_that_of_a_plain_computation(spark, model):
    """Passage by passage and neuron by neuron."""
    p = model.weights
    sigmoid = lambda t: 1 / (1 + np.exp(-t))
    for text in ("", "Short one.", "Line one here.\n" * 300, "é漢 x!" * 900):
        x, first = quality.passages([text])
        assert first.tolist() == [0, -(-(len(text.encode()) + 1) // 1024)]
        hidden, weight = [], []
        for row in (x - model.mean) / model.spread:
            h = np.array([np.tanh(sum(row * p["w"][:, j]) + p["b"][j]) for j in range(quality.HIDDEN)])
            gate = [np.tanh(sum(h * p["v"][:, j])) * sigmoid(sum(h * p["u"][:, j])) for j in range(len(p["a"]))]
            hidden.append(h)
            weight.append(np.exp(sum(g * a for g, a in zip(gate, p["a"], strict=True))))
        mean = sum(w * h for w, h in zip(weight, hidden, strict=True)) / sum(weight)
        assert model.score([text])[0] == pytest.approx(sigmoid(sum(mean * p["c"]) + p["d"]), abs=1e-6)
