import random
import re

import pytest
from pyspark.sql import functions as F

from pulse.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, size string"


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "c", "tiny", None])
        size = rng.choice([0, 1, 5, 40, 300]) if source != "tiny" else 3
        rows.append((i, "\n".join(f"é{j}" for j in range(size)), source, 0, "?"))
    rows.append((n, None, "a", 0, "?"))
    rows.append((n + 1, " \t\n", "blank", 0, "?"))
    rows += [rows[0]] * 5
    return rows


def filled(sizes, weights):
    """Targets by pouring the excess again and again."""
    total, targets, full = sum(sizes), [0.0] * len(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in full)
        rest = [i for i in range(len(sizes)) if i not in full]
        weight = sum(weights[i] for i in rest)
        for i in full:
            targets[i] = 3.0 * sizes[i]
        for i in rest:
            targets[i] = left * weights[i] / weight
        over = {i for i in rest if targets[i] > 3 * sizes[i]}
        if not over:
            return targets
        full |= over


def webster(seats, votes):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def names_in_order(rows):
    return sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))


@pytest.mark.parametrize("shard_words", [4_000_000, 700])
def test_targets_quotas_and_bounds(spark, shard_words):
    rows = corpus()
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), block_words=8, shard_words=shard_words).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = names_in_order(rows)
    sizes = [sum(size(r[1]) for r in rows if r[2] == s) for s in names]
    targets = filled(sizes, [1 + i % 3 for i in range(len(names))])
    for i, s in enumerate(names):
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[i]}
        assert own[0].target == pytest.approx(targets[i], abs=1e-5)
        assert abs(sum(r.taken for r in own) - targets[i]) <= 8 + 1
        assert all(0 <= r.taken <= 3 * r.size for r in own)


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(4)
    votes = [rng.randrange(1, 10_000) for _ in range(40)] + [1_000_000, 0]
    frame = spark.createDataFrame([(0, i, float(v), 997) for i, v in enumerate(votes)], "g int, k int, v double, seats long")
    got = {r.k: r.quota for r in mixing.apportion(frame, ["g"], "seats", "v", "k").collect()}
    assert [got[i] for i in range(len(votes))] == webster(997, votes)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(corpus(2), SCHEMA)
    key = ["doc_id", "size", "taken"]
    one = sorted(map(tuple, mixing.mix(docs.repartition(7)).select(*key).collect()))
    two = sorted(map(tuple, mixing.mix(docs.coalesce(1)).select(*key).collect()))
    assert one == two


def test_mixed_documents_hold_what_is_taken(spark):
    rows = [r for r in corpus(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = {r.source: r.t for r in mixing.mix(docs, block_words=8).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    out = mixing.mixed_documents(docs, block_words=8)
    assert out.columns == docs.columns
    words = {}
    originals = {r[0]: r[1] for r in rows}
    for r in out.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
        assert r.n_chars == len(r.text) or r.text == originals[r.doc_id]
        assert r.text.strip() in originals[r.doc_id]
    assert {k: v for k, v in taken.items() if v} == words


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs).count() == 0 and mixing.mixed_documents(docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, "")], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(spark.createDataFrame(corpus(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
