import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import packing
from pulse.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, length long, piece string"


def reference_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_TOKEN] for t in texts]


def check(rows, ids, capacity):
    """Every document is there once, cut as agreed, and sequences are gapless and full at most."""
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(documents) == set(ids)
    for doc_id, pieces in documents.items():
        at, whole = 0, ids[doc_id]
        for number, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at)
            assert 0 < r.length <= capacity and (number == 0 or r.length == capacity)
            data = np.array(whole[at : at + r.length], "<u4").tobytes()
            assert zlib.crc32(data) == r.ids_crc32
            at += r.length
        assert at == len(whole) and len(pieces) == -(-len(whole) // capacity)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


def test_pack_is_whole_and_tight(spark):
    rng = random.Random(3)
    words = "alpha beta gamma delta <|endoftext|> naïve 漢字 🙂 \n\n   tab\t".split(" ")
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 20, 60, 200]))) for i in range(300)}
    texts[300] = None
    docs = spark.createDataFrame([(k, v, 7, "x") for k, v in texts.items()], SCHEMA)
    ids = dict(zip(texts, reference_ids(texts.values()), strict=True))
    rows = packing.pack(docs, tokenizer_path(), 64).collect()
    used = check(rows, ids, 64)
    least = -(-sum(map(len, ids.values())) // 64)
    assert used <= 1.03 * least + 1


def test_equal_rows_and_ties(spark):
    docs = spark.createDataFrame([(i, "same words here", 0, "") for i in range(50)], SCHEMA)
    ids = dict.fromkeys(range(50), reference_ids(["same words here"])[0])
    n = len(ids[0])
    assert check(packing.pack(docs, tokenizer_path(), 3 * n + 1).collect(), ids, 3 * n + 1) == 17


def test_empty_table_and_bounds(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(docs, tokenizer_path(), 1024).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_path(), 0)


def test_sequences_hold_the_tokens(spark):
    texts = {i: "word " * (i * 13 % 40) for i in range(60)}
    docs = spark.createDataFrame([(k, v, 0, "") for k, v in texts.items()], SCHEMA)
    packed = packing.pack(docs, tokenizer_path(), 32)
    built = packing.sequences(docs, packed.select("doc_id", "piece", "start", "length", "sequence_id", "offset"), tokenizer_path())
    ids = dict(zip(texts, reference_ids(texts.values()), strict=True))
    total = built.agg(F.sum(F.size("ids")), F.max(F.size("ids"))).first()
    assert total[0] == sum(map(len, ids.values())) and total[1] <= 32


def test_one_document_per_task_of_a_round(spark):
    """A sweep is best-fit: each gap takes the largest document that fits."""
    matches, docs, gaps = packing.sweep([(3, 0, 2), (5, 0, 1), (9, 0, 1)], [(4, 10, 1), (8, 11, 2)], 12)
    assert sorted(m[0] for m in matches) == [3, 3, 5]
    assert docs == [(9, 0, 1)]
    assert sorted(gaps) == [(1, 10, 1), (3, 12, 1), (5, 11, 1)] or sorted(g[0] for g in gaps) == [1, 3, 5]


@pytest.mark.parametrize("size", [1, 7, 64])
def test_many_tasks_of_runs(spark, monkeypatch, size):
    """Sizes spread over several tasks give a whole packing too."""
    monkeypatch.setattr(packing, "RANGES", 16)
    runs = spark.createDataFrame([(s, 10 + s % 3) for s in range(size, 100, 3)], "size long, n long")
    placed = packing.place(runs, 100).collect()
    want = {r.size: r.n for r in runs.collect()}
    got = {}
    filled = {}
    for r in placed:
        got[r.size] = got.get(r.size, 0) + r.n
        for i in range(r.n):
            filled.setdefault(r.sequence_id + i, []).append((r.offset, r.size))
    assert got == want
    for pieces in filled.values():
        at = 0
        for offset, s in sorted(pieces):
            assert offset == at
            at += s
        assert at <= 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_tight_as_plain_best_fit(spark, seed):
    """One document after the other, largest first, each into the sequence with the least room that holds it."""
    from bisect import bisect_left, insort

    rng = random.Random(seed)
    sizes = [max(1, min(1024, int(rng.lognormvariate(5, 1.2)))) for _ in range(4000)]
    rooms, used = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        if at == len(rooms):
            used += 1
            room = 1024
        else:
            room = rooms.pop(at)
        insort(rooms, room - size)
    runs = spark.createDataFrame([(s, sizes.count(s)) for s in set(sizes)], "size long, n long")
    placed = packing.place(runs, 1024).collect()
    filled = {}
    for r in placed:
        for i in range(r.n):
            filled[r.sequence_id + i] = filled.get(r.sequence_id + i, 0) + r.size
    assert sum(filled.values()) == sum(sizes) and max(filled.values()) <= 1024
    assert len(filled) <= 1.01 * used + 1
