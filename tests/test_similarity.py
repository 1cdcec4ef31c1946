"""Ratios by hand and similarity joins against comparing every pair."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.functions.ratios import fold_width, indel_ratio, window_ratio
from pulse.functions.text import strip_symbols
from pulse.operators.similarity import candidate_pairs, containing_pairs, similar_pairs
from tests.conftest import SF_DIR


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=80), st.text("abc ", max_size=80))
def test_ratio_is_the_common_subsequence(a, b):
    expected = 100.0 if not a + b else 200.0 * lcs(a, b) / (len(a) + len(b))
    assert indel_ratio(a, b) == expected


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=1, max_size=8), st.text("ab", min_size=1, max_size=14))
def test_window_ratio_tries_every_stretch(a, b):
    short, long = sorted((a, b), key=len)
    pieces = {long[max(s, 0): s + len(short)] for s in range(1 - len(short), len(long))}
    best = max(200.0 * lcs(short, p) / (len(short) + len(p)) for p in pieces)
    assert window_ratio(a, b) >= best - 1e-9
    if len(a) != len(b):
        assert window_ratio(a, b) == pytest.approx(best)


def test_worked_examples():
    assert round(indel_ratio("spy x family", "spy x family season 3")) == 73
    assert round(indel_ratio("golden kamuy", "golden kamuy saishuushou")) == 67
    assert window_ratio("2nd season", "show 2nd season part") == 100.0


def words(seed, count):
    pick = random.Random(seed)
    base = ["season", "show", "hero", "world", "life", "magic", "school", "another", "x"]
    texts = set()
    while len(texts) < count:
        text = " ".join(sorted(pick.sample(base, pick.randrange(1, 5))))
        letters = list(text)
        for _ in range(pick.randrange(4)):
            at = pick.randrange(len(letters))
            letters[at: at + pick.randrange(2)] = pick.choice(["", "a", "s", "e1"])
        text = "".join(letters).strip()
        if len(text) >= 3:
            texts.add(text)
    return sorted(texts)


@pytest.mark.parametrize("threshold", [95, 85, 75, 60, 30])
def test_similar_pairs_is_exact(spark, threshold):
    left, right = words(1, 70), words(2, 60)
    expected = {
        (a, b, s) for a in left for b in right if (s := round(200.0 * lcs(a, b) / (len(a) + len(b)))) >= threshold
    }
    ldf = spark.createDataFrame([(x,) for x in left], "a string")
    rdf = spark.createDataFrame([(x,) for x in right], "b string")
    rows = similar_pairs(ldf, rdf, "a", "b", threshold).collect()
    assert len(rows) == len({(r["a"], r["b"]) for r in rows})
    assert {(r["a"], r["b"], r["score"]) for r in rows} == expected


def test_containing_pairs_is_exact(spark):
    pick = random.Random(5)
    left = [w.replace(" ", "") for w in words(3, 50)]
    right = sorted({"".join(pick.sample("abcdefgh", 3)) + w.replace(" ", "") + pick.choice(["", "part2"]) for w in words(4, 40)})
    left = sorted(set(left) - set(right))

    def score(a, b):
        best = round(indel_ratio(a, b))
        return max(best, round(window_ratio(a, b))) if min(len(a), len(b)) >= 8 else best

    expected = {(a, b, s) for a in left for b in right if (s := score(a, b)) >= 90}
    ldf = spark.createDataFrame([(x,) for x in left], "a string")
    rdf = spark.createDataFrame([(x,) for x in right], "b string")
    rows = containing_pairs(ldf, rdf, "a", "b", 90).collect()
    assert {(r["a"], r["b"], r["score"]) for r in rows} == expected
    assert expected


def test_no_pair_of_inputs_is_compared_blindly(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("a"))
    plan = similar_pairs(df, df.withColumnRenamed("a", "b"), "a", "b", 85)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(("threshold", "share"), [(85, 0.18), (90, 0.07)])
def test_few_pairs_are_candidates(spark, threshold, share):
    """Of 3,000 distinct openings of the given texts, whose words are made of a few syllables, at most such a
    share of all pairs is looked at."""
    tables = [("documents", "text"), ("pages", "html"), ("benchmark", "text")]
    openings = None
    for name, column in tables:
        texts = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.1')}/{name}.parquet")
        words = F.regexp_replace(F.lower(F.regexp_replace(column, "<[^>]*>", " ")), r"[^\p{L} ]+", " ")
        part = texts.select(F.trim(F.substring(F.trim(F.regexp_replace(words, " +", " ")), 1, 60)).alias("t"))
        openings = part if openings is None else openings.union(part)
    cut_at = F.pmod(F.xxhash64("t"), F.lit(50)) + 10
    texts = openings.select(F.substring("t", F.lit(1), cut_at.cast("int")).alias("t")).filter(F.length("t") >= 10)
    texts = texts.distinct().orderBy(F.xxhash64("t")).limit(3000)
    found = candidate_pairs(texts.withColumnRenamed("t", "a"), texts.withColumnRenamed("t", "b"), "a", "b", threshold)
    count = texts.count()
    assert count > 2000
    assert found.count() < share * count * count


def test_fold_width(spark):
    row = spark.createDataFrame([("Ｒｅ：ゼロ　2nd「Season」！",)], "t string").select(
        strip_symbols(fold_width(F.col("t"))).alias("n")
    ).first()
    assert row["n"] == "reゼロ2ndseason"


def test_best_ratios_are_those_of_all_pairs_with_few_compared(spark):
    from pulse.functions.ratios import indel_ratio
    from pulse.operators.similarity import best_ratios

    pick = random.Random(9)
    words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randrange(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(pick.choices(words, k=n))
    rights = sorted({text(pick.randrange(1, 5)) for _ in range(700)} | {"zz", ""})
    near = [r[: len(r) // 2] + text(1) for r in pick.choices(rights, k=120)]
    lefts = sorted({*near, *(text(pick.randrange(1, 6)) for _ in range(150)), "0123", "zz", ""})
    a = spark.createDataFrame([(t,) for t in lefts] + [(lefts[3],), (None,)], "a string")
    b = spark.createDataFrame([(t,) for t in rights] + [(rights[3],), (None,)], "b string")
    want = {x: max(round(indel_ratio(x, y)) for y in rights) for x in lefts}
    for cuts, per_block in (((70, 55, 40, 1), 512), ((90, 1), 100)):
        got = best_ratios(a, b, "a", "b", cuts, per_block).collect()
        assert {r["a"]: r["score"] for r in got} == {x: s for x, s in want.items() if s}
    first = sum(r["compared"] for r in best_ratios(a, b, "a", "b").collect())
    assert first < 0.25 * len(lefts) * len(rights)
    assert best_ratios(a, b.limit(0), "a", "b").count() == 0 and best_ratios(a.limit(0), b, "a", "b").count() == 0
