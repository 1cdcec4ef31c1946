"""Removal of byte strings that also start anywhere else in the corpus, by suffix arrays.

A start is one position of one document; the string of `length` bytes from there is repeated
if it starts at another position of any document, the same one included. Every byte that a
repeated string covers goes.

1. Each string belongs to the smallest hash of the 64-byte grams in it (winnowing): equal strings have
   equal smallest grams, so they meet under the same key. One pass cuts each text into such
   ranges of starts and gives a row of six numbers for each; no text is moved.
2. Keys with one range drop out. Equal ranges of one key (copies of a passage) are repeated
   as they are. Keys with different ranges go on with one occurrence of each, as bytes.
3. These are dealt over shards by key. A shard builds a suffix array of its bytes by
   Larsson-Sadakane refinement in numpy (groups of equal prefix are refined by the rank of what follows,
   prefixes double, settled suffixes are left alone), takes common prefixes with the neighbours by
   Kasai's recurrence, and marks the starts that share `length` bytes with another.
4. A key with very many different ranges is cut over several shards. Their sorted lists of strings
   are merged: in ranges of the order, each list is looked up in the others' by binary search.

Hashes of 64 bits decide what meets and whether two ranges are equal (two different ones agree
for one pair in 2^64); suffix arrays compare bytes.

Null text has no bytes. Texts shorter than `length` lose nothing. Repeated rows are copies
of each other and lose all their strings. An empty table gives none; other columns are
ignored. Texts of any length are cut whole, in overlapping parts. Text is UTF-8; what is kept is bytes, since a cut
may fall inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches
from pulse.llm.hashing import POWERS, mixed, prefix_sums, stretches
from pulse.session import cut

LENGTH = 400
GRAM = 64
SHARD_BYTES = 2_000_000
RANGES_PER_SHARD = 2_048
_CHUNK = 4_000_000
_LIST_ENTRIES = 500_000


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value in each window of so many; of equal ones the last."""
    n = len(values)
    # The value's high bits and the distance from the end of its block make a key whose minimum tells the place.
    blocks = -(-n // width)
    place = np.arange(blocks * width, dtype=np.uint64)
    bits = np.uint64(int(2 * width).bit_length())
    within = np.uint64(1) << bits
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    high = padded & ~(within - np.uint64(1))
    del padded
    # Later places get smaller keys; modulo twice the width is enough, since a window is shorter.
    rows = high.reshape(blocks, width)
    back = (np.uint64(width - 1) - place % np.uint64(width)).reshape(blocks, width)
    left = np.minimum.accumulate(rows | back, axis=1)  # from the block's start to here
    right = np.minimum.accumulate((rows | back)[:, ::-1], axis=1)[:, ::-1]  # from here to the block's end
    starts = np.arange(n - width + 1)
    a = right.ravel()[starts]
    b = left.ravel()[starts + width - 1]
    value_mask = ~(within - np.uint64(1))
    second = (b & value_mask) <= (a & value_mask)
    place_a = starts // width * width + (width - 1 - (a & ~value_mask).astype(np.int64))
    ends = starts + width - 1
    place_b = ends // width * width + (width - 1 - (b & ~value_mask).astype(np.int64))
    return np.where(second, place_b, place_a)


def ranges(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Key, hash of the bytes, first start and end of starts of each range of a text's starts."""
    sums = prefix_sums(data)
    _, down = POWERS.upto(len(sums))
    grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(sums) - gram])
    place = smallest_in_windows(grams, length - gram + 1)
    start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    end = np.concatenate([start[1:], [len(place)]])
    anchor = place[start]
    # Equal ranges have their gram at the same place of the same bytes.
    content = mixed(stretches(sums, start, end - 1 + length) + mixed((anchor - start).astype(np.uint64)))
    return grams[anchor], content, start, end


def _cut_texts(length: int, gram: int):
    columns = ["doc", "x", "key", "content", "start", "end"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, x, text in zip(*[frame[c] for c in ("doc", "x", "text")], strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                # Long texts in overlapping parts: each start is in one part, with all the bytes its string has.
                for low in range(0, max(0, len(data) - length + 1), _CHUNK):
                    key, content, start, end = ranges(data[low : low + _CHUNK + length - 1], length, gram)
                    same = [np.full(len(key), v) for v in (doc, x)]
                    out.append((*same, key.astype(np.int64), content.astype(np.int64), start + low, end + low))
            if out:
                yield pd.DataFrame({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(columns)})

    return run


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first `depth` bytes or more.

    Suffixes that agree so far share a rank, the place of the last of them. The first order is by
    eight bytes; each refinement sorts the unsettled suffixes by (rank, rank of what follows).
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for k in range(8):
        first = first << np.uint64(8) | padded[k : k + n]
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    value = first[order]
    last = np.flatnonzero(np.concatenate([value[1:] != value[:-1], [True]]))
    size = np.diff(np.concatenate([[-1], last]))
    rank[order] = np.repeat(last, size)
    open_places = np.flatnonzero(np.repeat(size > 1, size))
    step = 8
    while len(open_places) and step < depth:
        rows = order[open_places]
        follow = np.where(rows + step < n, rank[np.minimum(rows + step, n - 1)], -1)
        group = rank[rows]
        by = np.lexsort((follow, group))
        rows, group, follow = rows[by], group[by], follow[by]
        order[open_places] = rows
        edge = np.concatenate([(group[1:] != group[:-1]) | (follow[1:] != follow[:-1]), [True]])
        last = np.flatnonzero(edge)
        size = np.diff(np.concatenate([[-1], last]))
        rank[rows] = np.repeat(open_places[last], size)
        open_places = open_places[np.repeat(size > 1, size)]
        step *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix, in the order of positions, the bytes it shares with the suffix before it in the order.

    Kasai: from one position to the next the number falls by one as long as the suffix before also moves by
    one and they shared a byte; only where not are bytes compared, eight at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    chained = np.zeros(n, bool)
    # Behind a first byte that differs any number of equal bytes can follow.
    chained[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (data[before[:-1]] == data[:-1])
    shared = np.zeros(n, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    heads = np.flatnonzero(~chained & (before >= 0))
    live = heads
    while len(live):
        a, b = live + shared[live], before[live] + shared[live]
        inside = np.maximum(a, b) + 8 <= n
        live, a, b = live[inside], a[inside], b[inside]
        live = live[(eight[a] == eight[b]).all(1)]
        shared[live] += 8
    live = heads
    for _ in range(8):
        a, b = live + shared[live], before[live] + shared[live]
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        live = live[data[a] == data[b]]
        shared[live] += 1
    head = np.maximum.accumulate(np.where(chained, -1, here))
    return np.maximum(shared[head] - (here - head), 0)


# An entry of a shard's list: two hashes of the string, where it starts, and whether it is known to be repeated.
_ENTRY = np.dtype([("low", "<i8"), ("high", "<i8"), ("doc", "<i8"), ("x", "<i8"), ("start", "<i4"), ("known", "?")])


def _shard(length: int, buckets: int):
    """Runs of repeated starts of one shard; of keys that lie in several shards, the sorted list of
    different strings as one row for each of so many ranges of its order."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        pieces = [np.frombuffer(b, np.uint8) for b in frame["bytes"]]
        sizes = np.array([len(p) for p in pieces])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        starts = (frame["end"] - frame["start"]).to_numpy()
        data = np.concatenate(pieces)
        order = suffix_array(data, length)
        shared = common_prefixes(data, order)
        # Suffixes of one string are neighbours; a piece's bytes after its last start are there for the strings.
        string = np.cumsum(shared[order] < length)
        owner = np.repeat(np.arange(len(pieces)), starts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
        of = np.empty(len(data), np.int64)
        of[order] = string
        own = of[first[owner] + within]
        repeated = np.bincount(own, minlength=len(data) + 1)[own] > 1
        single = (frame["n"].to_numpy() == 1)[owner]
        doc, x = frame["doc"].to_numpy()[owner], frame["x"].to_numpy()[owner]
        start = frame["start"].to_numpy()[owner] + within
        # Runs of marked starts of one piece.
        marked = np.flatnonzero(repeated & single)
        new = np.ones(len(marked), bool)
        new[1:] = (owner[marked][1:] != owner[marked][:-1]) | (start[marked][1:] != start[marked][:-1] + 1)
        head = marked[new]
        tail = marked[np.append(new[1:], True)] if len(marked) else marked
        runs = pd.DataFrame({"doc": doc[head], "x": x[head], "start": start[head], "end": start[tail] + 1})
        _, one = np.unique(own, return_index=True)
        one = one[frame["split"].to_numpy()[owner[one]]]
        if not len(one):
            return runs.assign(bucket=-1, strings=None)
        at = first[owner[one]] + within[one]
        entries = np.empty(len(one), _ENTRY)
        entries["low"] = stretches(prefix_sums(data), at, at + length).astype(np.int64)
        entries["high"] = stretches(prefix_sums(data ^ np.uint8(0x5A)), at, at + length).astype(np.int64)
        entries["doc"], entries["x"], entries["start"] = doc[one], x[one], start[one]
        entries["known"] = repeated[one] | ~single[one]
        entries = entries[np.lexsort((entries["high"], entries["low"]))]
        bucket = ((entries["low"] >> 32) + (1 << 31)) * buckets >> 32
        lists = [(b, entries[bucket == b].tobytes()) for b in np.unique(bucket)]
        rows = pd.DataFrame({"doc": 0, "x": 0, "start": 0, "end": 0, "bucket": [b for b, _ in lists], "strings": [e for _, e in lists]})
        return pd.concat([runs.assign(bucket=-1, strings=None), rows]) if len(runs) else rows

    return run


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """Strings that are in the lists of several shards, looked up by binary search; their starts, if not known."""
    entries = np.concatenate([np.frombuffer(b, _ENTRY) for b in frame["strings"]])
    entries = entries[np.lexsort((entries["high"], entries["low"]))]
    # One number for each different string, in order, so that the lists can be searched.
    new = (entries["low"][1:] != entries["low"][:-1]) | (entries["high"][1:] != entries["high"][:-1])
    number = np.cumsum(np.append(True, new))
    count = np.searchsorted(number, number, "right") - np.searchsorted(number, number, "left")
    found = entries[(count > 1) & ~entries["known"]]
    starts = found["start"].astype(np.int64)
    return pd.DataFrame({"doc": found["doc"].astype(np.int64), "x": found["x"].astype(np.int64), "start": starts, "end": starts + 1})


def _covered(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the strings that start in the spans."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end - 1 + length)
        else:
            out.append([start, end - 1 + length])
    return [(a, b) for a, b in out]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A text goes by its document's id and a hash: rows that share both are copies."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("x"), F.coalesce("doc_id", F.lit(-(2**63))).alias("doc")
    )


def repeated_starts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES, ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """(doc, x, start, end): by id and hash of a text, ranges of starts of repeated strings."""
    bounded_batches(docs.sparkSession)
    texts = _keyed(docs, id_col, text_col)
    long_enough = texts.where(F.octet_length("text") >= length).select("doc", "x", "text")
    shape = "doc long, x long, key long, content long, start int, end int"
    cuts = cut(long_enough.mapInPandas(_cut_texts(length, gram), shape))
    contents = cut(
        cuts.groupBy("key", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "x", "start", "end")).alias("one")
        )
    )
    many = contents.where("n > 1").select("key", "content")
    equal = cuts.join(many, ["key", "content"], "left_semi").select("doc", "x", "start", "end")
    kinds = contents.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ranges = cut(contents.join(kinds, "key").select("key", "content", "n", "kinds", "one.*"))
    split = F.col("kinds") > ranges_per_shard
    starts = F.col("end") - F.col("start")
    total, listed = open_ranges.agg(F.sum(starts + length - 1), F.sum(F.when(split, starts))).first()
    shards, buckets = -(-(total or 1) // shard_bytes), -(-(listed or 1) // _LIST_ENTRIES)
    part = F.pmod(F.xxhash64("content"), F.ceil(F.col("kinds") / ranges_per_shard))
    dealt = open_ranges.withColumns({"split": split, "shard": F.pmod(F.xxhash64("key", part), F.lit(shards))})
    wanted = dealt.groupBy("doc", "x").agg(
        F.collect_list(F.struct("shard", "split", "n", "start", "end")).alias("ranges")
    )

    def bytes_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["shard", "split", "n", "doc", "x", "start", "end", "bytes"]
        for frame in frames:
            out = []
            for doc, x, text, found in zip(*[frame[c] for c in ("doc", "x", "text", "ranges")], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for r in found:
                    piece = data[r["start"] : r["end"] - 1 + length]
                    out.append((r["shard"], r["split"], r["n"], doc, x, r["start"], r["end"], piece))
            yield pd.DataFrame(out, columns=columns)

    shape = "shard long, split boolean, n long, doc long, x long, start int, end int, bytes binary"
    pieces = long_enough.join(wanted, ["doc", "x"]).select("doc", "x", "text", "ranges").mapInPandas(bytes_of, shape)
    # A repeated row gives its pieces again; equal rows are one.
    pieces = pieces.groupBy("shard", "split", "doc", "x", "start", "end").agg(
        F.max("n").alias("n"), F.first("bytes").alias("bytes")
    )
    marks = cut(
        pieces.groupBy("shard").applyInPandas(
            _shard(length, buckets), "doc long, x long, start int, end int, bucket int, strings binary"
        )
    )
    place = ["doc", "x", "start", "end"]
    merged = marks.where("bucket >= 0").groupBy("bucket").applyInPandas(_merge, "doc long, x long, start int, end int")
    return equal.union(marks.where("bucket < 0").select(*place)).union(merged)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **parameters
) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) of every row: the removed runs (start, end) and the bytes that are left."""
    starts = repeated_starts(docs, id_col, text_col, length, **parameters)
    per_text = starts.groupBy("doc", "x").agg(F.collect_set(F.struct("start", "end")).alias("starts"))
    joined = _keyed(docs, id_col, text_col).join(per_text, ["doc", "x"], "left").select("doc_id", "text", "starts")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes, removed, kept = [], [], []
            for text, found in zip(frame["text"], frame["starts"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                runs = [] if found is None else _covered([(r["start"], r["end"]) for r in found], length)
                edges = [0, *[e for r in runs for e in r], len(data)]
                sizes.append(len(data))
                removed.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": sizes, "removed": removed, "kept": kept})

    shape = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    return joined.mapInPandas(run, shape)
