import random

import pytest

from pulse.operators.intervals import overlapping


def pairs(left, right):
    return sorted(
        (k, i, j) for k, i, a, b in left for m, j, c, d in right
        if k == m and None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b
    )


def sides(seed, longest):
    pick = random.Random(seed)

    def rows(n):
        out = []
        for i in range(n):
            start = pick.randrange(-2000, 2000)
            end = start + pick.choice([0, 1, pick.randrange(8), pick.randrange(longest)])
            out.append((f"k{pick.choice([0, 0, 1, 2])}", i, start, end))
        return out + [("k0", n, None, 5), ("k0", n + 1, 5, None), ("k0", n + 2, 5, 4), (out[0])]

    return rows(150), rows(100)


@pytest.mark.parametrize("longest", [2, 50, 10**9])
def test_equal_to_all_pairs(spark, longest):
    left, right = sides(longest, longest)
    a = spark.createDataFrame(left, "k string, i long, a long, b long")
    b = spark.createDataFrame(right, "k string, j long, c int, d long" if longest < 100 else "k string, j long, c long, d long")
    met = overlapping(a, b, ("a", "b"), ("c", "d"), ["k"])
    assert met.columns == ["k", "i", "a", "b", "j", "c", "d"]
    assert sorted((r.k, r.i, r.j) for r in met.collect()) == pairs(left, right)
    same = [("", *r[1:]) for r in left], [("", *r[1:]) for r in right]
    met = overlapping(a.drop("k"), b.drop("k"), ("a", "b"), ("c", "d"))
    assert sorted(("", r.i, r.j) for r in met.collect()) == pairs(*same)


def test_an_interval_costs_two_rows_a_level(spark):
    """The join is an equi join of a few rows for each interval, however long that is."""
    left = spark.createDataFrame([(i, i * 10, i * 10 + 10**12) for i in range(20)], "i long, a long, b long")
    points = spark.range(500).selectExpr("id AS j", "id * 7 AS c", "id * 7 AS d")
    met = overlapping(left, points, ("a", "b"), ("c", "d"))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert met.count() == sum(7 * j >= 10 * i for i in range(20) for j in range(500))


def test_empty_sides(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "i long, a long, b long")
    none = spark.createDataFrame([], "j long, c long, d long")
    assert overlapping(rows, none, ("a", "b"), ("c", "d")).count() == 0
    assert overlapping(rows.limit(0), none, ("a", "b"), ("c", "d")).count() == 0
