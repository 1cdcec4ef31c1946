import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pulse.llm import resampling
from pulse.llm.ranges import ranked

DOCS = "doc_id long, text string, score string, rank int"


def features(text, low, high):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return w, [" ".join(w[i : i + k]) for k in range(low, high + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, percent, least, low=1, high=1, buckets=resampling.BUCKETS):
    def counted(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, low, high)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counted([x for _, x in docs]), counted(target)
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)
    ]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        w, found = features(text, low, high)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((i, doc_id, len(w), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[2] >= least), key=lambda r: (-r[5], r[1] is None, r[1] or 0))
    rank = {r[0]: n + 1 for n, r in enumerate(order[: len(order) * percent // 100])}
    return [(r[1], r[3], r[4], r[5], rank.get(r[0])) for r in rows]


def corpus(seed=0, copies=0):
    rng = random.Random(seed)
    prose = lambda n, k: " ".join(rng.choice("BbcÉdeXyz") + rng.choice("aei") * rng.randrange(1, k) for _ in range(n))
    docs = [(i, prose(rng.randrange(0, 60), rng.choice([3, 6]))) for i in range(200)]
    docs += [(300, None), (301, ""), (None, prose(30, 3)), (None, prose(40, 3)), (302, "..."), (303, "w " * 5000)]
    docs += [(1000, docs[5][1] + " " + prose(30, 4))] * copies
    return docs, [prose(20, 3) for _ in range(10)] + [None, ""]


def result(df, prefix="_"):
    names = [f"{prefix}{c}" for c in ("n_features", "weight", "score", "rank")]
    return sorted([tuple(r) for r in df.select("doc_id", *names).collect()], key=str)


def frames(spark, docs, target):
    return spark.createDataFrame([(i, t, "?", 0) for i, t in docs], DOCS), spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize(("percent", "low", "high", "buckets"), [(10, 1, 1, 10_000), (50, 1, 3, 500), (100, 2, 2, 70_000), (0, 1, 1, 100)])
def test_equal_to_brute_force(spark, percent, low, high, buckets):
    docs, target = corpus(percent)
    got = resampling.resample(*frames(spark, docs, target), percent=percent, low=low, high=high, buckets=buckets)
    assert got.columns[:4] == ["doc_id", "text", "score", "rank"]
    assert result(got) == sorted(brute(docs, target, percent, 20, low, high, buckets), key=str)


def test_repeated_rows_are_ranked_each(spark):
    docs, target = corpus(3, copies=120)
    assert result(resampling.resample(*frames(spark, docs, target), percent=40)) == sorted(brute(docs, target, 40, 20), key=str)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    """A sketch of two entries proposes bounds that exact counts refuse."""
    rows = spark.range(5000).select((F.col("id") * F.col("id") % 4999).alias("score"))
    values = sorted((r[0] for r in rows.collect()), reverse=True)
    for draw in (1, 2, 499, 2500, 4999, 5000):
        for accuracy, margin in ((2, 0.0), (10_000, 0.001)):
            inside, above = resampling.bracket(rows, "score", draw, margin, accuracy)
            held = sorted((r[0] for r in inside.collect()), reverse=True)
            assert above < draw <= above + len(held)
            assert held[draw - above - 1] == values[draw - 1]
            if accuracy > 2 and 10 < draw < 4990:
                assert len(held) < 100


def test_result_is_the_same_through_a_poor_sketch(spark):
    docs, target = corpus(8)
    got = resampling.resample(*frames(spark, docs, target), percent=30, accuracy=2, margin=0.0)
    assert result(got) == sorted(brute(docs, target, 30, 20), key=str)


def test_columns_to_keep(spark):
    docs, target = corpus(2)
    got = resampling.resample(*frames(spark, docs, target), keep=())
    assert got.columns[0] == "doc_id" and "text" not in got.columns
    assert result(got, "_") == sorted(brute(docs, target, 10, 20), key=str)


def test_empty_tables(spark):
    docs, target = corpus(1)
    a, b = frames(spark, docs, target)
    assert resampling.resample(a.limit(0), b).count() == 0
    assert result(resampling.resample(a, b.limit(0))) == sorted(brute(docs, [], 10, 20), key=str)


def test_ranks_cross_ranges(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"))
    got = ranked(rows, [F.col("k").desc(), F.col("i")], "rank", rows_per_task=70).collect()
    want = sorted(((r.k, r.i) for r in got), key=lambda r: (-r[0], r[1]))
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))


def test_long_texts_are_read_in_stretches(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    whole = resampling.features(text, 1, 4, 997)
    monkeypatch.setattr(resampling, "word_lists", lambda t, table: ([w.encode()] for w in t.split()))
    n, found = resampling.features(text, 1, 4, 997)
    assert n == whole[0] == 500 and sorted(found) == sorted(whole[1])
