"""Approximate nearest neighbours by learned partitions.

The table is a tree of partitions. A node's neighbour graph, taken of a bounded sample of its rows, is cut into
parts of equal size with few edges between them: recursive bisection, each cut refined by balanced
swaps of the vectors that gain most. A small network learns to tell from a vector alone the parts of its
neighbours (Dong et al., 2020). It puts every row of the node into its most probable part, and sends a query
to several most probable parts. Parts with more than four times `rows_per_part` rows are nodes again, fitted on
a sample of their own rows, so a leaf has about as many rows in a table of any size. In the leaves a query
reaches, all rows are compared with it by the exact distance in double precision.

How far a query looks in a node is measured, not guessed: up to `TESTS` sample vectors that took no part in the fit
are compared with all rows of the node, as these are routed, and the smallest probability is taken that holds `aim` of
their nearest (its root, if there are several levels): a query visits its most probable parts until they have that
probability together. Where vectors have neighbourhoods, most queries visit one part of each node; where
they have none, as random ones, nearly all, and no partition can help.

Every step is a job over all nodes of a level: samples are fitted in tasks, rows and queries meet
their node's network in blocks of bounded size. So a part with very many equal vectors is many tasks; one that its
network can't divide stays as it is, and is compared in blocks.

Equal distances go by the smaller id. Vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part. Rows without an id are left out. A query's own rows are those with its
id; a repeated query is searched once, by the smallest of its vectors; a repeated candidate counts with each of its
rows. With fewer than `k` candidates all are found. Other columns are ignored, whatever their names. An empty table
gives none.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches
from pulse.session import cut

SAMPLE = 8_192
ROWS_PER_PART = 250
MOST_PARTS = 64
BLOCK = 8_192
AIM = 0.97
TESTS = 128


def nearest(x: np.ndarray, y: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """For each row of x the k nearest rows of y, in blocks."""
    out = np.empty((len(x), k), np.int64)
    norms = (y * y).sum(1)
    for at in range(0, len(x), 1024):
        near = norms - 2 * (x[at : at + 1024] @ y.T)
        if skip_self:
            rows = np.arange(len(near))
            near[rows, at + rows] = np.inf
        best = np.argpartition(near, k - 1, axis=1)[:, :k]
        order = np.argsort(np.take_along_axis(near, best, 1), axis=1)
        out[at : at + 1024] = np.take_along_axis(best, order, 1)
    return out


def bisect(x: np.ndarray, heads: np.ndarray, tails: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Halves of equal size with few of the edges (heads, tails) between them."""
    n = len(x)
    centred = x - x.mean(0)
    axis = rng.normal(size=x.shape[1])
    for _ in range(8):
        axis = centred.T @ (centred @ axis)
        axis /= np.linalg.norm(axis) or 1
    side = np.zeros(n, bool)
    side[np.argsort(centred @ axis, kind="stable")[n // 2 :]] = True
    best, fewest = side, np.inf
    for _ in range(40):
        across = side[heads] != side[tails]
        cost = across.sum()
        if cost < fewest:
            best, fewest = side.copy(), cost
        gain = np.bincount(heads, np.where(across, 1, -1), n) + np.bincount(tails, np.where(across, 1, -1), n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        good = int((gain[left[:m]] + gain[right[:m]] > 0).sum())
        if not good:
            break
        # Half of the good swaps at a time: neighbours that change sides together would swap for ever.
        good = max(1, good // 2)
        side = side.copy()
        side[left[:good]], side[right[:good]] = True, False
    return best


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Part of each vector: `parts`, a power of two, of sizes that differ by one at most per level."""
    rng = np.random.default_rng(seed)
    n = len(x)
    heads, tails = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        inside = part[heads] == part[tails]
        new = part * 2
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            place = np.zeros(n, np.int64)
            place[rows] = np.arange(len(rows))
            own = inside & (part[heads] == p)
            new[rows] += bisect(x[rows], place[heads[own]], place[tails[own]], rng)
        part = new
    return part


@dataclass
class Router:
    """One hidden layer; `visits` parts are searched for each query."""

    mean: np.ndarray
    scale: float
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    c: np.ndarray
    visits: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x - self.mean) / self.scale @ self.w + self.b) @ self.v + self.c

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")

    def before(self, x: np.ndarray) -> np.ndarray:
        """Of each part the probability of all that are more probable for a vector."""
        logits = self.logits(x)
        share = np.exp(logits - logits.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        order = np.argsort(-logits, axis=1, kind="stable")
        sorted_share = np.take_along_axis(share, order, 1)
        out = np.empty_like(share)
        np.put_along_axis(out, order, np.cumsum(sorted_share, 1) - sorted_share, 1)
        return out


def learn(x: np.ndarray, share: np.ndarray, hidden: int = 128, epochs: int = 30, batch: int = 256, seed: int = 6) -> Router:
    """Adam on the cross-entropy with the shares of parts among a vector's neighbours."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), float(x.std()) or 1.0
    d, parts = x.shape[1], share.shape[1]
    router = Router(mean, scale, rng.normal(size=(d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.normal(size=(hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts))
    x = (x - mean) / scale
    names = ("w", "b", "v", "c")
    first = {k: np.zeros_like(getattr(router, k)) for k in names}
    second = {k: np.zeros_like(getattr(router, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            h = np.maximum(0, x[rows] @ router.w + router.b)
            z = h @ router.v + router.c
            z = np.exp(z - z.max(1, keepdims=True))
            error = (z / z.sum(1, keepdims=True) - share[rows]) / len(rows)
            dh = (error @ router.v.T) * (h > 0)
            step += 1
            for k, g in zip(names, (x[rows].T @ dh, dh.sum(0), h.T @ error, error.sum(0)), strict=True):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(router, k, getattr(router, k) - 0.002 * move)
    return router


def fit(sample: np.ndarray, parts: int, k: int = 10, aim: float = AIM) -> Router | None:
    """Partition and router from a sample; None if one part is enough."""
    test = max(1, len(sample) // 10)
    queries, base = sample[:test], sample[test:]
    if parts < 2 or len(base) < 8 * parts:
        return None
    graph = nearest(base, base, min(k, len(base) - 1), skip_self=True)
    part = balanced_parts(base, graph, parts)
    around = np.concatenate([part[:, None], part[graph]], 1)
    share = np.zeros((len(base), parts))
    np.add.at(share, (np.arange(len(base))[:, None], around), 1 / around.shape[1])
    router = learn(base, share)
    # The index holds a vector where the router puts it, so that is where the test looks for it.
    home = router.logits(base).argmax(1)
    true = nearest(queries, base, min(k, len(base)))
    rank = np.argsort(router.ranked(queries), axis=1)
    needed = np.take_along_axis(rank, home[true], 1)
    found = np.array([(needed <= v).mean() for v in range(parts)])
    router.visits = int(np.argmax(found >= aim)) + 1
    return router


def _fit_node(k: int, aim: float):
    """The network of one node from its sample, with the vectors to test it; none where the sample has no parts to learn."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(frame["place"].to_numpy(), kind="stable")
        ids = frame["vec_id"].to_numpy()[order]
        sample = np.array(frame["vector"].iloc[order].tolist(), np.float64)
        router = fit(sample, int(frame["parts"].iloc[0]), k, aim)
        # The fit leaves a tenth out.
        tests = min(TESTS, max(1, len(sample) // 10))
        rows = [] if router is None else [(int(frame["node"].iloc[0]), pickle.dumps((router, ids[:tests], sample[:tests])))]
        return pd.DataFrame(rows, columns=["node", "router"])

    return run


def _place_rows(k: int):
    """Rows of a block of a node at their most probable part; and of the block, the nearest rows to each test
    vector with the probability of the parts that it visits before theirs (rows with a `test`)."""
    columns = ["vec_id", "vector", "node", "test", "distance", "passed"]

    def run(rows: pd.DataFrame, routers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(routers):
            return pd.DataFrame(columns=columns)
        router, ids, tests = pickle.loads(routers["router"].iloc[0])
        x = np.array(rows["vector"].tolist(), np.float64)
        home, node = router.logits(x).argmax(1), int(rows["node"].iloc[0])
        placed = rows[["vec_id", "vector"]].assign(node=_child(node, home), test=None, distance=None, passed=None)
        near = (x * x).sum(1) - 2 * (tests @ x.T)
        near[ids[:, None] == rows["vec_id"].to_numpy()] = np.inf
        best = np.argpartition(near, min(k, len(x)) - 1, axis=1)[:, :k]
        passed = router.before(tests)
        test = np.repeat(np.arange(len(tests)), best.shape[1])
        best = best.ravel()
        found = pd.DataFrame({
            "vec_id": rows["vec_id"].to_numpy()[best], "vector": None, "node": node, "test": test,
            "distance": near[test, best], "passed": passed[test, home[best]],
        })
        found = found[np.isfinite(found["distance"])]
        return pd.concat([placed.astype(object), found.astype(object)])[columns]

    return run


def _child(node, part):
    """The number of a part of a node."""
    return node * (MOST_PARTS + 1) + 1 + part


def _send_queries(queries: pd.DataFrame, routers: pd.DataFrame) -> pd.DataFrame:
    columns = ["vec_id", "vector", "node"]
    if not len(queries) or not len(routers):
        return pd.DataFrame(columns=columns)
    router, _, _ = pickle.loads(routers["router"].iloc[0])
    before = router.before(np.array(queries["vector"].tolist(), np.float64))
    query, part = np.nonzero(before <= routers["reach"].iloc[0])
    return queries[columns].iloc[query].assign(node=_child(queries["node"].to_numpy()[query], part))


def _in_blocks(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of the nodes, in blocks by a hash."""
    return rows.join(nodes, "node").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")


def partitioned(
    given: DataFrame, asked: DataFrame, k: int, sample_rows: int, rows_per_part: int, most_parts: int, aim: float
) -> tuple[DataFrame, DataFrame]:
    """(vec_id, vector, node) of every row at its leaf, and of every query at all the leaves it visits."""
    columns = ["vec_id", "vector", "node"]
    kind = given.schema["vector"].dataType.simpleString()
    shape = f"vec_id long, vector {kind}, node long"
    index = cut(given.withColumn("node", F.lit(0).cast("long")))
    sent = cut(asked.withColumn("node", F.lit(0).cast("long")))
    total = index.count()
    levels = max(1, math.ceil(math.log(max(1, total / (4 * rows_per_part))) / math.log(most_parts)))
    leaves, reached = [], []
    before = None
    while True:
        sizes = index.groupBy("node").agg(F.count("*").alias("rows"))
        if before is not None:
            # A part that holds nearly all of its node can't be divided.
            parent = F.floor((F.col("node") - 1) / (MOST_PARTS + 1)).cast("long")
            sizes = sizes.withColumn("parent", parent).join(before, "parent").select(
                "node", "rows", (F.col("rows") > 0.9 * F.col("parent_rows")).alias("whole")
            )
        else:
            sizes = sizes.withColumn("whole", F.lit(False))
        sizes = cut(sizes)
        wide = sizes.where((F.col("rows") > 4 * rows_per_part) & ~F.col("whole"))
        halvings = F.floor(F.log2(F.col("rows") / rows_per_part))
        parts = F.least(F.lit(most_parts), F.pow(F.lit(2), halvings)).cast("int")
        opened = wide.select("node", "rows", parts.alias("parts"))
        place = F.pmod(F.xxhash64("vec_id", "vector"), F.col("rows"))
        sample = index.join(opened, "node").withColumn("place", place).where(F.col("place") < sample_rows)
        routers = cut(sample.groupBy("node").applyInPandas(_fit_node(k, aim ** (1 / levels)), "node long, router binary"))
        split = cut(opened.join(routers.select("node"), "node").select("node", "rows"))
        if not split.count():
            leaves.append(index)
            reached.append(sent)
            break
        leaves.append(index.join(split.select("node"), "node", "left_anti").select(*columns))
        reached.append(sent.join(split.select("node"), "node", "left_anti").select(*columns))
        blocks = split.select("node", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
        spread = routers.join(blocks, "node").select("node", "router", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        by = ["node", "block"]
        routed = cut(
            _in_blocks(index, blocks).groupBy(*by).cogroup(spread.groupBy(*by))
            .applyInPandas(_place_rows(k), f"{shape}, test int, distance double, passed double")
        )
        tested = Window.partitionBy("node", "test").orderBy("distance", "vec_id")
        nearest_rows = routed.where("test IS NOT NULL").withColumn("n", F.row_number().over(tested)).where(F.col("n") <= k)
        reach = nearest_rows.groupBy("node").agg(F.percentile_approx("passed", aim ** (1 / levels), 10_000).alias("reach"))
        spread = spread.join(reach, "node", "left").withColumn("reach", F.coalesce("reach", F.lit(0.0)))
        sent = cut(_in_blocks(sent, blocks).groupBy(*by).cogroup(spread.groupBy(*by)).applyInPandas(_send_queries, shape))
        index = routed.where("test IS NULL").select(*columns)
        before = split.select(F.col("node").alias("parent"), F.col("rows").alias("parent_rows"))
    every, all_sent = leaves[0], reached[0]
    for more, more_sent in zip(leaves[1:], reached[1:], strict=True):
        every, all_sent = every.unionByName(more), all_sent.unionByName(more_sent)
    return every, all_sent


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    narrow = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(vector_col) if narrow else F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )


def search(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    sample_rows: int = SAMPLE,
    rows_per_part: int = ROWS_PER_PART,
    most_parts: int = MOST_PARTS,
    aim: float = AIM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for the rows where `is_query` (of `vec_id`) holds.

    A node's network is fitted on about `sample_rows` of its rows, chosen by a hash; every row is indexed. A node has
    at most `most_parts` parts, a power of two up to 64.
    """
    bounded_batches(rows.sparkSession)
    given = _usable(rows, id_col, vector_col)
    lengths = given.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return rows.sparkSession.createDataFrame([], schema)
    given = given.where(F.size("vector") == lengths[0])
    asked = given.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    index, sent = partitioned(given, asked, k, sample_rows, rows_per_part, most_parts, aim)
    blocks = cut(index.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    stored = _in_blocks(index, blocks)
    visits = sent.join(blocks, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def rerank(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(stored):
            y = np.array(stored["vector"].tolist(), np.float64)
            ids, norms = stored["vec_id"].to_numpy(), (y * y).sum(1)
            for a in range(0, len(queries), 1024):
                x = np.array(queries["vector"].iloc[a : a + 1024].tolist(), np.float64)
                near = norms - 2 * (x @ y.T)
                own = queries["vec_id"].to_numpy()[a : a + 1024]
                near[own[:, None] == ids] = np.inf
                last = np.partition(near, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                slack = 1e-9 * (1 + np.abs(last) + (x * x).sum(1))
                for i in range(len(x)):
                    best = np.flatnonzero(near[i] <= last[i] + slack[i])
                    best = best[ids[best] != own[i]]
                    exact = np.sqrt(((y[best] - x[i]) ** 2).sum(1))
                    order = np.lexsort((ids[best], exact))[:k]
                    out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[best[order]], "score": exact[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (
        visits.groupBy("node", "block")
        .cogroup(stored.groupBy("node", "block"))
        .applyInPandas(rerank, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
