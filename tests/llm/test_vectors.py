import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulse.llm import crosspolytope, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, part int"


def rows_of(seed=0, n=300, d=64):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    hub = x[0]
    near = [(hub + rng.normal(size=d) * 0.1 * rng.random()).astype(np.float32) for _ in range(150)]
    x = np.concatenate([x, near, x[:20], x[5:6] * 3])
    return [(int(i * 2), v.tolist(), int(i % 3), 0) for i, v in enumerate(x)] + [
        (5001, None, 1, 0), (5003, [0.0] * d, 1, 0), (5005, [float("nan")] + [1.0] * (d - 1), 1, 0),
        (5007, [float("inf")] + [1.0] * (d - 1), 1, 0), (5009, x[0].tolist(), None, 0), (5011, [], 1, 0),
    ]


def brute(rows, threshold=0.93):
    good = [(i, np.array(v, float), l) for i, v, l, _ in rows if v and l is not None and np.isfinite(v).all() and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    label = np.array([l for *_, l in good])
    near = (unit @ unit.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    comp = np.arange(len(good))
    ids = np.array([g[0] for g in good])
    comp = ids.copy()
    while True:
        new = np.minimum(comp, np.where(near, comp, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == comp).all():
            break
        comp = new
    out = {r[0]: (0, r[0], True) for r in rows}
    return out | {int(i): (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, near.sum(1), comp, strict=True)}


@pytest.mark.parametrize("block", [1024, 16])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(crosspolytope, "BLOCK", block)
    rows = rows_of()
    got = crosspolytope.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(rows)


def test_small_vectors_copies_and_empty_tables(spark):
    rows = [(i, [1.0, 0.0] if i < 9 else [0.0, 1.0], 0, 0) for i in range(12)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (8, 0) if i < 9 else (2, 9) for i in range(12)}
    assert crosspolytope.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_close_vectors_pass_the_signs():
    """Every pair at the threshold is let through, whichever of its 64 signs differ."""
    rng = np.random.default_rng(4)
    a = crosspolytope.unit(rng.normal(size=(400, 64)))
    r = rng.normal(size=a.shape)
    r = crosspolytope.unit(r - (r * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * r
    keys = ["label", "size", "table", "code"]
    rows = pd.DataFrame({"label": "x", "size": 64, "table": 0, "code": np.repeat(np.arange(400), 2), "t": np.arange(800)})
    signs = np.stack([crosspolytope.sketch(a), crosspolytope.sketch(b)], 1).ravel()
    passed = pd.concat(crosspolytope._may_link(keys, 0.93)(iter([rows.assign(signs=signs, home=True)])))
    assert sorted(passed["t"]) == list(range(800))


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5, 8, 11, 14])
def test_pairs_at_the_threshold_meet_however_fine_the_buckets(bits):
    rng = np.random.default_rng(bits)
    a = crosspolytope.unit(rng.normal(size=(1500, 64)))
    r = rng.normal(size=a.shape)
    r = crosspolytope.unit(r - (r * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * r
    tables = crosspolytope.tables_for(bits)
    x, y = (crosspolytope.corners(v, tables, crosspolytope.PROBES, bits) for v in (a, b))
    met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any((1, 2))
    assert met.mean() >= 0.975


def test_buckets_keep_their_size_as_rows_grow():
    """Unrelated vectors that a vector meets in a table: as many among 8,000 as among 1,000."""
    met = []
    for n in (1000, 8000):
        x = crosspolytope.unit(np.random.default_rng(n).normal(size=(n, 64)))
        codes = crosspolytope.corners(x, 2, crosspolytope.PROBES, crosspolytope.doublings(n))
        home, count = np.unique(codes[:, 0, 0], return_counts=True)
        at = np.minimum(np.searchsorted(home, codes[:, 0]), len(home) - 1)
        met.append(np.where(home[at] == codes[:, 0], count[at], 0).sum() / n)
    assert met[1] < 1.5 * met[0]


def test_links_with_doubled_buckets(spark):
    rows = rows_of(2)
    got = crosspolytope.near_vectors(spark.createDataFrame(rows, SCHEMA), rows_per_code=20).collect()
    want = brute(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    links = sum(w[0] for w in want.values())
    assert sum(f[0] for f in found.values()) >= 0.98 * links
    assert all(found[i][0] <= want[i][0] for i in want)


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(crosspolytope.hadamard(crosspolytope.hadamard(x)), x)


def exact(rows, k):
    good = [(i, np.array(v, float)) for i, v, *_ in rows if v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    out = {}
    for i, v in good:
        if i % 20 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            d[ids == i] = np.inf
            out[i] = [(int(ids[j]), d[j]) for j in np.lexsort((ids, d))[:k] if np.isfinite(d[j])]
    return out


@pytest.mark.parametrize("rows_per_part", [10**6, 250, 40])
def test_search_finds_most_neighbours(spark, rows_per_part):
    rows = rows_of(1, 3000)
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, rows_per_part=rows_per_part)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = exact(rows, 10)
    hits = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    if rows_per_part > 10**5:
        assert {q: [v for v, _ in g] for q, g in got.items()} == {q: [v for v, _ in w] for q, w in want.items()}
    for q, g in got.items():
        assert g == sorted(g, key=lambda x: (x[1], x[0]))


def test_few_candidates_and_none(spark):
    rows = [(0, [1.0, 2.0], 0, 0), (20, [1.0, 2.5], 0, 0), (3, [5.0, 5.0], 0, 0), (4, None, 0, 0)]
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert neighbours.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_partition_is_balanced_and_follows_the_graph():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(100, 8)) + 8 * np.eye(8)[k] for k in range(4)])
    graph = neighbours.nearest(x, x, 5, skip_self=True)
    part = neighbours.balanced_parts(x, graph, 4)
    assert set(np.bincount(part)) == {100}
    assert (part[:, None] == part[graph]).mean() > 0.95


def test_router_finds_97_of_100_neighbours():
    x = np.random.default_rng(1).normal(size=(3000, 16))
    router = neighbours.fit(x, 16)
    queries, base = x[:300], x[300:]
    rank = np.argsort(router.ranked(queries), axis=1)
    home = router.logits(base).argmax(1)[neighbours.nearest(queries, base, 10)]
    assert (np.take_along_axis(rank, home, 1) < router.visits).mean() >= 0.97


def clustered(spark, n, centres, d=16):
    """Vectors around centres, written by Spark's own random numbers; a hundred queries of any table."""
    rng = np.random.default_rng(7)
    places = spark.createDataFrame([(i, (8 * rng.normal(size=d)).tolist()) for i in range(centres)], "c int, centre array<double>")
    noise = F.array(*[F.randn(100 + j) for j in range(d)])
    rows = spark.range(n).select(F.col("id").alias("vec_id"), (F.pmod(F.xxhash64("id"), F.lit(centres))).cast("int").alias("c"), noise.alias("noise"))
    moved = F.zip_with("centre", "noise", lambda a, b: a + b)
    return rows.join(F.broadcast(places), "c").select("vec_id", moved.alias("embedding"))


def test_rows_compared_stay_level_as_the_table_grows(spark):
    """A tree of one level, and of two; neighbours are found in leaves of about the same size."""
    compared = {}
    for n in (4_000, 40_000):
        rows = clustered(spark, n, n // 100).cache()
        is_query = F.col("vec_id") % (n // 100) == 0
        given = neighbours._usable(rows, "vec_id", "embedding")
        index, sent = neighbours.partitioned(given, given.where(is_query), 10, 1024, 50, 16, 0.97)
        sizes = index.groupBy("node").agg(F.count("*").alias("rows"))
        assert sizes.agg(F.sum("rows")).first()[0] == n
        compared[n] = sent.join(sizes, "node").agg(F.sum("rows")).first()[0] / 100
        found = neighbours.search(rows, is_query, sample_rows=1024, rows_per_part=50, most_parts=16).collect()
        pdf = rows.toPandas()
        x, ids = np.array(pdf["embedding"].tolist()), pdf["vec_id"].to_numpy()
        hits = 0
        for q in range(0, n, n // 100):
            d = ((x - x[ids == q][0]) ** 2).sum(1)
            d[ids == q] = np.inf
            hits += len({r.vec_id for r in found if r.query_id == q} & set(ids[np.argsort(d)[:10]].tolist()))
        assert hits >= 0.9 * 1000
        rows.unpersist()
    assert compared[40_000] < 2.5 * compared[4_000] and compared[40_000] < 0.05 * 40_000


def test_equal_vectors_and_repeated_ids(spark):
    """A part that can't be divided is compared whole; ids that repeat on other vectors are one query."""
    rows = [(i, [1.0, 2.0, 3.0], 0, 0) for i in range(300)] + [(400, [1.0, 2.0, 3.5], 0, 0), (400, [0.5, 2.0, 3.0], 0, 0)]
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, rows_per_part=20, sample_rows=200).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    assert got[0] == [(i, 0.0) for i in range(1, 11)] and got[100] == [(i, 0.0) for i in range(10)]
    assert got[400] == [(i, 0.5) for i in range(10)]
