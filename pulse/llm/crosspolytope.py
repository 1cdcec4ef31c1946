"""Near-duplicate vectors of one label by cross-polytope hashing.

A vector is turned by random signs and fast Hadamard transforms, three times over; the
coordinate of largest magnitude, with its sign, is its corner of the cross-polytope. A table
joins the corners of two such rotations into a bucket, and of further ones as the rows grow: each doubling of
the largest label above `rows_per_code` doubles the corners of a rotation of which only so many coordinates
are looked at, until it is whole and the next begins. So a bucket keeps its size whatever the number of rows,
unless vectors really are close. A vector lives in its bucket and
also visits the next likely ones (multiprobe); who meets is compared exactly, by the cosine in
double precision, and a pair that meets in several buckets counts in the first. Finer buckets part more pairs:
from the fifth doubling on each brings one more table. Pairs at a cosine of 0.93 meet in at least 98 of 100 cases
up to the fourteenth (tests measure it).

Equal vectors of a label are one from the start and count as often as they occur. A large bucket is cut
into blocks, and every pair of blocks is a group of bounded size, of which a task takes many at a time and
returns only sums and a spanning forest of its links, never pairs. Rows move with their vectors only when 64 signs
say that somebody in the bucket may be close.

Null labels and vectors that are null, all zero, or hold null or non-finite components
link with nothing: n_links 0, a component of their own. Rows without an id are left out. A
repeated id is one node with all its rows: its links are those of all of them. An empty table gives none. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, components, whole_groups
from pulse.session import cut

TABLES = 8
PROBES = 4
THRESHOLD = 0.93
BLOCK = 1024
ROWS_PER_CODE = 1000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        step *= 2
    return x.reshape(n, d) / np.sqrt(d)


def doublings(rows: int, rows_per_code: int = ROWS_PER_CODE) -> int:
    """How often the buckets are doubled for a label of so many rows."""
    return max(0, (max(rows, 1) - 1) // rows_per_code).bit_length()


def tables_for(bits: int, tables: int = TABLES) -> int:
    return tables + max(0, bits - 4)


def corners(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, bits: int = 0, seed: int = 11) -> np.ndarray:
    """(vector, table, probe): numbers of the buckets, the vector's own first; `bits` doublings beyond two rotations."""
    rng = np.random.default_rng(seed)
    n, d = vectors.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = vectors
    out = np.zeros((n, tables, probes), np.int64)
    # A rotation of `size` coordinates has twice as many corners, one of the first coordinate alone has two.
    whole = size.bit_length()
    looked_at = [size, size, *[size] * (bits // whole), *([1 << (bits % whole - 1)] if bits % whole else [])]
    for t in range(tables):
        code, cost = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for width in looked_at:
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], size))
            # Of few coordinates the other side of the best is a likely corner too.
            value = np.concatenate([x[:, :width], -x[:, :width]], 1) if width < 3 else x[:, :width]
            likely = value if width < 3 else np.abs(value)
            top = min(3, value.shape[1])
            best = np.argpartition(-likely, top - 1, axis=1)[:, :top]
            order = np.argsort(-np.take_along_axis(likely, best, 1), axis=1, kind="stable")
            best = np.take_along_axis(best, order, 1)
            value = np.take_along_axis(value, best, 1)
            if width < 3:
                corner, loss = best, (value[:, :1] - value) ** 2
            else:
                corner, loss = best * 2 + (value < 0), value[:, :1] ** 2 - value**2
            loss[:, 0] = -1  # its own corner goes first
            code = (code[:, :, None] * (2 * width) + corner[:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + loss[:, None, :]).reshape(n, -1)
            keep = np.argsort(cost, axis=1, kind="stable")[:, : 4 * probes]
            code, cost = np.take_along_axis(code, keep, 1), np.take_along_axis(cost, keep, 1)
        found = code[:, :probes]
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = found[:, :1]
    return out


def sketch(vectors: np.ndarray, seed: int = 12) -> np.ndarray:
    """64 signs of turned coordinates as a number; angles become differing bits."""
    rng = np.random.default_rng(seed)
    n, d = vectors.shape
    size = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :d] = vectors
    bits = np.zeros((n, 0), bool)
    while bits.shape[1] < 64:
        for _ in range(3):
            x = hadamard(x * rng.choice([-1.0, 1.0], size))
        bits = np.concatenate([bits, x[:, :64] > 0], axis=1)
    return np.packbits(bits[:, :64], axis=1).view(">u8")[:, 0].astype(np.int64)


def _may_link(keys: list[str], threshold: float):
    """Of small buckets, the rows that differ from another one, home or visited, in few enough signs.

    Five standard errors above the mean of the threshold's angle; vectors of fewer than 32
    components, whose signs depend on each other, always may.
    """
    share = np.arccos(min(1.0, threshold)) / np.pi
    most = int(64 * share + 5 * np.sqrt(64 * share * (1 - share))) + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            changed = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            group = np.cumsum(changed)
            # Without a sign: numpy counts the bits of a negative number's magnitude.
            signs, home = frame["signs"].to_numpy().astype(np.uint64), frame["home"].to_numpy()
            may = frame["size"].to_numpy() < 32
            at, step = np.arange(len(frame)), 1
            while len(at):
                at = at[at + step < len(frame)]
                at = at[group[at] == group[at + step]]
                near = np.bitwise_count(signs[at] ^ signs[at + step]) <= most
                near &= home[at] | home[at + step]
                may[at[near]] = may[at[near] + step] = True
                step += 1
            yield frame.loc[may, [*keys, "t", "home"]]

    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes is connected to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compare(keys: list[str], threshold: float, tables: int, probes: int, bits: int):
    """Sums and a spanning forest of the links of many groups at a time, a group being a pair of blocks of a bucket."""

    def pairs_of(vectors: np.ndarray, t: np.ndarray, home: np.ndarray, block: np.ndarray, one: int, two: int) -> np.ndarray:
        left, right = np.flatnonzero(home & (block == one)), np.flatnonzero(block == two)
        sides = [(left, right)] if one == two else [(left, right), (np.flatnonzero(home & (block == two)), np.flatnonzero(block == one))]
        found = []
        for x, y in sides:
            i, j = np.nonzero(vectors[x] @ vectors[y].T >= threshold)
            i, j = x[i], y[j]
            # Two that are both at home are seen from either side: once is enough.
            once = np.where(home[j], t[i] < t[j], t[i] != t[j])
            found.append(np.stack([i[once], j[once]]))
        return np.concatenate(found, 1)

    def links_of(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = unit(np.array(frame["vector"].tolist(), np.float64))
        home, table = frame["home"].to_numpy(), frame["table"].to_numpy()
        block, t, m = frame["block"].to_numpy(), frame["t"].to_numpy(), frame["copies"].to_numpy()
        one, two = frame["one"].to_numpy(), frame["two"].to_numpy()
        start = np.flatnonzero((frame[keys] != frame[keys].shift()).any(axis=1).to_numpy())
        pairs = [
            pairs_of(vectors[a:b], t[a:b], home[a:b], block[a:b], one[a], two[a]) + a
            for a, b in zip(start, np.append(start[1:], len(frame)), strict=True)
        ]
        i, j = np.concatenate([*pairs, np.zeros((2, 0), np.int64)], 1)
        if not len(i):
            return pd.DataFrame({"t": [], "links": [], "root": []})
        linked = np.unique(np.concatenate([i, j]))
        codes = np.zeros((len(t), tables, probes), np.int64)
        codes[linked] = corners(vectors[linked], tables, probes, bits)
        met = np.zeros(len(i), bool)
        for k in range(tables):
            at_one, at_two = (codes[i, k, :1] == codes[j, k]).any(1), (codes[j, k, :1] == codes[i, k]).any(1)
            met |= (k < table[i]) & (at_one | at_two)
            # In one table they may meet at either's home: the home of the smaller number counts.
            met |= (k == table[i]) & at_two & ~home[j] & (t[j] < t[i])
        a, b = i[~met], j[~met]
        nodes, place = np.unique(t, return_inverse=True)
        links = np.bincount(place[a], weights=m[b], minlength=len(nodes)) + np.bincount(place[b], weights=m[a], minlength=len(nodes))
        root = forest(place[a], place[b], len(nodes))
        touched = np.flatnonzero(links > 0)
        return pd.DataFrame({"t": nodes[touched], "links": links[touched].astype(np.int64), "root": nodes[root[touched]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            for _, part in frame.groupby("size", sort=False):
                yield links_of(part)

    return run


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    rows_per_code: int = ROWS_PER_CODE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per id."""
    bounded_batches(rows.sparkSession)
    # The narrow type that the table has is moved; all arithmetic is in double precision.
    narrow = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(vector_col) if narrow else F.col(vector_col).cast("array<double>")
    valid = (
        F.col("vector").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    given = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), F.col(label_col).cast("string").alias("label")
    ).where("vec_id IS NOT NULL")
    # A node is a vector of a label; t numbers the nodes in the order of their smallest id.
    nodes = given.where(valid).groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))

    unique = cut(nodes.withColumn("t", F.monotonically_increasing_id()))
    largest = unique.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    bits = doublings(largest, rows_per_code)
    tables = tables_for(bits, tables)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(size=[len(v) for v in frame["vector"]])
            for size, part in frame.groupby("size"):
                vectors = unit(np.array(part["vector"].tolist(), np.float64).reshape(len(part), size))
                codes, signs = corners(vectors, tables, probes, bits), sketch(vectors)
                part = part[["label", "size", "t"]].assign(signs=signs)
                for k in range(tables):
                    for p in range(probes):
                        new = np.ones(len(part), bool) if not p else (codes[:, k, p : p + 1] != codes[:, k, :p]).all(1)
                        yield part[new].assign(table=k, code=codes[new, k, p], home=p == 0)

    key = ["label", "size", "table", "code"]
    placed = unique.select("label", "vector", "t").mapInPandas(
        place, "label string, size int, t long, signs long, table int, code long, home boolean"
    )
    placed = cut(placed)
    counted = placed.groupBy(*key).agg(F.count("*").alias("n"), F.max("home").alias("lived_in"))
    crowded = counted.where("n > 1 AND lived_in").select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = placed.join(crowded, key)
    small = members.where("blocks = 1").repartition(*key).sortWithinPartitions(*key)
    near = small.select(*key, "t", "signs", "home").mapInPandas(
        _may_link(key, threshold), "label string, size int, table int, code long, t long, home boolean"
    )
    # Blocks of a large bucket compare all their rows; its size is the size of a group of close vectors.
    active = near.withColumn("blocks", F.lit(1)).union(members.where("blocks > 1").select(*key, "t", "home", "blocks"))
    vectors = unique.select("t", "copies", "vector")
    blocked = active.join(vectors, "t").withColumn("block", F.pmod(F.xxhash64("t"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = blocked.select(*key, "t", "home", "copies", "vector", "block", other).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    )
    pair = [*key, "one", "two"]
    sorted_tasks = tasks.repartition(*pair).sortWithinPartitions(*pair)
    found = cut(sorted_tasks.mapInPandas(_compare(pair, threshold, tables, probes, bits), "t long, links long, root long"))
    links = found.groupBy("t").agg(F.sum("links").alias("others"))
    # A node's ids: with a spanning forest over nodes, and each id tied to the smallest id of its node.
    ids = given.where(valid).join(unique.select("label", "vector", "t", "copies", "first"), ["label", "vector"])
    ids = cut(ids.select("vec_id", "t", "copies", "first"))
    firsts = unique.select("t", "first")
    forest_links = found.where("t <> root").select("t", "root").distinct()
    between = forest_links.join(firsts.withColumnRenamed("first", "a"), "t").join(
        firsts.select(F.col("t").alias("root"), F.col("first").alias("b")), "root"
    )
    edges = between.select("a", "b").union(ids.select(F.col("vec_id").alias("a"), F.col("first").alias("b")))
    joined = components(edges).withColumnRenamed("id", "vec_id")
    per_id = ids.join(links, "t", "left").groupBy("vec_id").agg(
        F.sum(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    component = F.coalesce("component", "vec_id")
    return (
        given.select("vec_id").distinct()
        .join(per_id, "vec_id", "left")
        .join(joined, "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
        )
    )
