import hashlib
import os
import random

import numpy as np
import pytest

from pulse.llm import suffixes
from pulse.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, x string, start int"


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdéß漢", k=rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(30) for _ in range(5)]
    texts = [prose(rng.randrange(1, 80)) for _ in range(40)]
    texts += [f"{prose(10)} {rng.choice(passages)} {prose(10)}" for _ in range(60)]
    texts += [texts[0]] * 4 + ["ab" * 300, "x" * 500, "", None, "short", passages[0][:99], passages[0]]
    texts.append(f"{passages[1]} {prose(5)} {passages[1]}")
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute(rows, length):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int))).reshape(-1, 2)
        out.append((i, len(d), [tuple(map(int, e)) for e in edges], bytes(np.frombuffer(d, np.uint8)[~gone])))
    return sorted(out)


@pytest.mark.parametrize(("shard_bytes", "ranges_per_shard"), [(2_000_000, 2048), (500, 1), (3000, 3)])
def test_equal_to_brute_force(spark, shard_bytes, ranges_per_shard):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "?", 0) for i, t in rows], SCHEMA)
    got = suffixes.remove_repeats(docs, length=100, gram=16, shard_bytes=shard_bytes, ranges_per_shard=ranges_per_shard)
    got = sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in got.collect())
    assert got == brute(rows, 100)


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_CHUNK", 70)
    rows = corpus(2)[:60]
    docs = spark.createDataFrame([(i, t, "?", 0) for i, t in rows], SCHEMA)
    got = suffixes.remove_repeats(docs, length=50, gram=8)
    assert sorted((r.doc_id, bytes(r.kept)) for r in got.collect()) == [(r[0], r[3]) for r in brute(rows, 50)]


def test_repeated_rows_and_ids(spark):
    rows = [(1, "q" + "abc" * 50), (1, "q" + "abc" * 50), (1, "different"), (None, "xyz" * 40), (2, "é" * 10)]
    docs = spark.createDataFrame([(i, t, "?", 0) for i, t in rows], SCHEMA)
    got = suffixes.remove_repeats(docs, length=60, gram=16).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in got) == [(0, 120, 0), (1, 9, 9), (1, 151, 0), (1, 151, 0), (2, 20, 20)]


def test_query_catches_passages_of_over_fifty_words_from_400_bytes_on(spark, tmp_path):
    rng = random.Random(3)
    # Words of four to nine bytes with their space: 51 of the short ones have under 400 bytes, of the long ones more.
    prose = lambda n, size: " ".join("".join(rng.choices("abcdeé", k=size)) for _ in range(n))
    short, under, exact, long = prose(51, 3), prose(70, 7), prose(70, 7), prose(51, 8)
    under, exact = [p.encode()[: size - 2].decode(errors="ignore") for p, size in ((under, 399), (exact, 400))]
    under, exact = under.ljust(399 - len(under.encode()) + len(under), "x"), exact.ljust(400 - len(exact.encode()) + len(exact), "x")
    assert [len(p.encode()) for p in (under, exact)] == [399, 400] and len(short.encode()) < 399 and len(long.encode()) > 400
    # Other letters around each passage, so that no two documents share a byte more than it.
    marks = iter("ABCDEFGHIJKLMNOPQRSTUVWX")
    texts = [f"{prose(30, 5)}{m}{p}{m}{prose(30, 6)}" for p in (short, under, exact, long) for m in (next(marks) for _ in range(6))]
    texts += [prose(120, 5) for _ in range(6)] + ["", None]
    rows = list(enumerate(texts))
    spark.createDataFrame([(i, t, "?", 0) for i, t in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(QUERIES["op8_suffix_array_dedup"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    expected = brute(rows, 400)
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in got] == [
        (i, n, sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace"))
        for i, n, runs, kept in expected
    ]
    # n_bytes is of the input; what was caught shows in n_removed.
    assert [r.n_bytes for r in got] == [len((t or "").encode()) for t in texts]
    assert [r.n_removed > 0 for r in got] == [False] * 12 + [True] * 12 + [False] * 8


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for n, k in ((400, 2), (300, 1), (600, 5)):
        data = rng.integers(0, k, n).astype(np.uint8)
        order = suffixes.suffix_array(data, 64)
        text = data.tobytes()
        keys = [text[i : i + 64] for i in order]
        shared = suffixes.common_prefixes(data, order)
        for a, b in zip(order, order[1:], strict=False):
            same = 0
            while max(a, b) + same < n and data[a + same] == data[b + same]:
                same += 1
            assert shared[b] == same
        # Zero bytes stand for what is behind the end, so only whole prefixes are in order.
        whole = [x for x in keys if len(x) == 64]
        assert whole == sorted(whole)


def test_common_prefixes_behind_a_byte_that_differs():
    # "Sabc..." comes right after "Rabc..." with no byte in common, and "abc..." right after "abc..." with all of them.
    data = np.frombuffer(b"Rabcdefgh!Sabcdefgh~", np.uint8)
    text = data.tobytes()
    order = suffixes.suffix_array(data, 64)
    shared = suffixes.common_prefixes(data, order)
    for a, b in zip(order, order[1:], strict=False):
        assert shared[b] == len(os.path.commonprefix([text[a:], text[b:]]))


def test_smallest_in_windows_takes_the_last_of_equals():
    values = np.random.default_rng(1).integers(0, 20, 200).astype(np.uint64) << np.uint64(40)
    for width in (1, 6, 50, 200):
        got = suffixes.smallest_in_windows(values, width)
        assert list(got) == [i + width - 1 - int(np.argmin(values[i : i + width][::-1])) for i in range(201 - width)]
