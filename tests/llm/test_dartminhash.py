import random

import numpy as np
import pytest

from pulse.llm import dartminhash as dart
from pulse.llm.hashing import shingle_sets

SCHEMA = "doc_id long, text string, x long, class string"


def texts_of(rng, n, words):
    vocabulary = [f"w{i}" for i in range(3000)]
    return [" ".join(rng.choices(vocabulary, k=words)) for _ in range(n)]


def mutated(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute(rows):
    """Classes of all pairs of at least 0.8, over rows with an id."""
    sets = {}
    for k, (i, text) in enumerate(rows):
        w = (text or "").split()
        sets[k] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset([()])
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                parent[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    return sorted((i, min(ids[find(k)])) for k, (i, _) in enumerate(rows))


@pytest.fixture
def corpus():
    rng = random.Random(5)
    rows = []
    for text in texts_of(rng, 30, 120):
        rows.append(text)
        rows += [mutated(rng, text, c) for c in (1, 2, 3, 6)]
    hub = texts_of(rng, 1, 150)[0]
    rows += [mutated(rng, hub, rng.randrange(1, 5)) for _ in range(120)] + [hub] * 15
    rows += ["", None, "  \n", "one two", "one two", "one two three four five"]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 7])
def test_classes_equal_brute_force(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(dart, "BLOCK", block)
    docs = spark.createDataFrame([(i, t, 0, "?") for i, t in corpus], SCHEMA)
    got = sorted((r.id, r["class"]) for r in dart.classes(docs).collect())
    assert got == brute(corpus)


def test_near_dedup_keeps_one_of_each(spark, corpus):
    docs = spark.createDataFrame([(i, t, 0, "?") for i, t in corpus], SCHEMA)
    kept = dart.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(corpus)})


def test_repeated_rows_ids_and_nulls(spark):
    rows = [(1, "a b c d e f", 0, ""), (1, "a b c d e f", 0, ""), (1, "a b c d e f", 1, ""), (2, "a b c d e f", 0, ""), (None, "a b c d e f", 0, ""), (3, "other words", 0, ""), (3, "unlike these", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert dart.classes(docs).count() == 6
    kept = sorted((r.doc_id is None, r.doc_id, r.text) for r in dart.near_dedup(docs).collect())
    assert [k[:2] for k in kept][-1] == (True, None)
    assert [k[1] for k in kept if not k[0]].count(1) == 1 and 2 not in [k[1] for k in kept]


def test_an_id_on_unrelated_texts_loses_none_of_them(spark):
    rows = [(3, "other words", 0, ""), (3, "unlike these", 0, ""), (0, "p q r s t u v", 0, ""), (0, "a b c d e f g", 0, "")]
    rows += [(7, "p q r s t u v", 0, ""), (8, "a b c d e f g", 0, ""), (0, "a b c d e f g", 0, ""), (5, "alone", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = sorted((r.doc_id, r.text) for r in dart.near_dedup(docs).collect())
    assert kept == [(0, "a b c d e f g"), (0, "p q r s t u v"), (3, "other words"), (3, "unlike these"), (5, "alone")]
    assert len({r.component for r in dart.classes(docs).collect()}) == 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert dart.classes(docs).count() == 0 and dart.near_dedup(docs).count() == 0


def similarity(elements, a, b, k):
    one = dart.throw(np.concatenate([elements, elements]), np.concatenate([a, b]), np.array([0, len(a), 2 * len(a)]), k)
    return (one[0] == one[1]).mean()


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    elements = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = rng.random(400) * 4 + 0.1, rng.random(400) * 4 + 0.1
    k = 2000
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(similarity(elements, a, b, k) - true) < 4 * np.sqrt(true * (1 - true) / k)


def test_signatures_of_few_and_many_elements():
    rng = np.random.default_rng(3)
    many = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    one, _, _ = shingle_sets(["a b c"], 5)
    sizes = np.cumsum([0, 1, 45_000, 45_000, 3])
    elements = np.concatenate([one, many[:45_000], many[5_000:], many[:3]])
    got = dart.throw(elements, np.ones(len(elements)), sizes, 120)
    assert got.shape == (4, 120) and abs((got[1] == got[2]).mean() - 0.8) < 0.2
    # Alone or among others, a document has one signature.
    assert (dart.throw(one, np.ones(1), np.array([0, 1]), 120)[0] == got[0]).all()
    assert (dart.throw(many[:3], np.ones(3), np.array([0, 3]), 120)[0] == got[3]).all()


def test_shingle_sets_follow_the_texts():
    texts = ["a b c d e f", "", "x y", "a b c d e f a b c d e", "  a  b\nc d\te f ", " \n"]
    values, counts, first = shingle_sets(texts, 5)
    sets = [dict(zip(values[a:b], counts[a:b], strict=True)) for a, b in zip(first, first[1:], strict=False)]
    assert [len(s) for s in sets] == [2, 0, 1, 6, 2, 0]
    assert sets[0] == sets[4] and set(sets[0]) < set(sets[3]) and sum(sets[3].values()) == 7


def test_counts_weigh_repeats(spark):
    docs = spark.createDataFrame([(1, "p q r s t u " * 40, 0, ""), (2, "p q r s t u " * 39, 0, "")], SCHEMA)
    assert {r["class"] for r in dart.classes(docs, count_repeats=True).collect()} == {1}
