import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import decontamination
from pulse.llm.words import LETTERS, LETTERS_AND_DIGITS, joined_words, word_lists

DOCS = "doc_id long, text string, leak string, items int"
ITEMS = "item_id long, text string, words string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window):
    out = []
    lists = [(i, words(t)) for i, t in items]
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, x in lists:
            k = min(window, len(x))
            for a in range(len(x) - k + 1 if x else 0):
                for b in range(len(w) - k + 1):
                    if w[b : b + k] == x[a : a + k]:
                        hit.update(range(b, b + k))
                        found.add(item_id)
        out.append((doc_id, len(w), sorted(hit), sorted(str(i) for i in found if i is not None)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["of", "The", "é漢", "x9", "in", "a", "Ñu", "so", "me", "to"])
    prose = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(i, prose(rng.randrange(1, 25))) for i in range(20)]
    items += [(90, None), (91, ""), (92, "..."), (93, items[3][1]), (93, items[4][1]), (None, items[5][1]), (7, items[7][1].upper())]
    docs = [(i, prose(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, f"{prose(9)} {rng.choice(items[:20])[1]}. {prose(7)}") for i in range(30)]
    docs += [(200, None), (201, ""), (202, "--"), (203, items[0][1]), (203, items[0][1]), (None, items[1][1])]
    docs += [(204, " ".join(t or "" for _, t in items) * 3)]
    return docs, items


def collected(df):
    rows = df.select("doc_id", "leak_.*").collect()
    return [(r.doc_id, r.n_words, [w for a, b in zip(r.starts, r.ends, strict=True) for w in range(a, b)], list(r["items"])) for r in rows]


def key(row):
    return (row[0] is None, row[0] or 0, str(row))


@pytest.mark.parametrize(("window", "block_bytes", "shard"), [(10, 4_000_000, 1_000_000), (4, 4_000_000, 50), (3, 200, 7), (1, 400, 64)])
def test_equal_to_brute_force(spark, window, block_bytes, shard):
    docs, items = corpus(window)
    marked = decontamination.mark(
        spark.createDataFrame([(i, t, "?", 0) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, "?") for i, t in items], ITEMS),
        window=window, block_bytes=block_bytes, words_per_shard=shard,
    )
    assert marked.columns == ["doc_id", "text", "leak", "items", "leak_"]
    assert sorted(collected(marked), key=key) == sorted(brute(docs, items, window), key=key)


def test_long_texts_are_cut_into_overlapping_stretches(spark):
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(3000))
    parts = text.split()
    items = [(i, " ".join(parts[a : a + 13])) for i, a in enumerate(range(0, 2987, 61))]
    docs = [(1, text), (2, "z " * 3000 + items[9][1])]
    marked = decontamination.mark(
        spark.createDataFrame([(i, t, "?", 0) for i, t in docs], DOCS), spark.createDataFrame([(i, t, "?") for i, t in items], ITEMS), words_per_shard=100,
    )
    assert sorted(collected(marked)) == sorted(brute(docs, items, 10))


def test_empty_tables(spark):
    docs, items = corpus(1)
    docs = spark.createDataFrame([(i, t, "?", 0) for i, t in docs], DOCS)
    items = spark.createDataFrame([(i, t, "?") for i, t in items], ITEMS)
    assert decontamination.mark(docs.limit(0), items).count() == 0
    clean = decontamination.mark(docs, items.limit(0))
    assert sorted(collected(clean), key=key) == sorted(((i, len(words(t)), [], []) for i, t in corpus(1)[0]), key=key)
    assert decontamination.longest_matches(docs, items.limit(0)).count() == 0


def test_affected_documents_go(spark):
    docs, items = corpus(2)
    frame = spark.createDataFrame([(i, t, "?", 0) for i, t in docs], DOCS)
    kept = decontamination.remove_contaminated(frame, spark.createDataFrame([(i, t, "?") for i, t in items], ITEMS), window=8)
    assert kept.columns == frame.columns
    want = sorted((i or -1, t or "") for (i, t), (_, _, hit, _) in zip(docs, brute(docs, items, 8), strict=True) if not hit)
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == want


def test_longest_matches_and_where_they_are(spark):
    docs, items = corpus(4)
    got = decontamination.longest_matches(
        spark.createDataFrame([(i, t, "?", 0) for i, t in docs if i is not None], DOCS).repartition(4),
        spark.createDataFrame([(i, t, "?") for i, t in items[:20]], ITEMS), words_per_shard=300,
    ).collect()
    texts = {}
    for i, t in docs:
        texts.setdefault(str(i), []).append(words(t))
    lists = {str(i): words(t) for i, t in items[:20]}
    for r in got:
        x = lists[r.item_ids[0]][r.item_start :]
        longest = max(
            next((n for n in range(min(len(x), len(w) - b), 0, -1) if w[b : b + n] == x[:n]), 0)
            for found in texts.values() for w in found for b in range(len(w))
        )
        assert r.length == longest
        assert any(w[r.start : r.start + r.length] == x[:longest] for w in texts[r.id])
    assert len(got) == sum(len(set(range(len(x)))) for x in {tuple(x): x for x in lists.values()}.values())


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(0)
    for n, k in ((300, 1), (400, 2), (500, 9)):
        numbers = rng.integers(1, k + 1, n)
        order = decontamination.suffix_array(decontamination.packed(numbers, 4, 3), 3, 32)
        assert sorted(order) == list(range(n))
        keys = [tuple(numbers[i : i + 32]) for i in order]
        assert keys == sorted(keys)


def test_words(spark):
    text = "A1-b É_漢 x\tZZ\x00q"
    assert [w.decode() for x in word_lists(text, LETTERS_AND_DIGITS, 3) for w in x] == words(text)
    assert [w.decode() for x in word_lists(text, LETTERS) for w in x] == ["a", "b", "É", "漢 x", "zz", "q"]
    df = spark.createDataFrame([(text,), (None,), ("a[b]\\c^d-e",)], "t string")
    got = [r[0] for r in df.select(joined_words(F.col("t"), LETTERS_AND_DIGITS)).collect()]
    assert got == [" ".join(words(text)), "", "a b c d e"]
