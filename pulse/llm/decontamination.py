"""Benchmark passages in training documents, by suffix arrays of the training words.

Training texts are dealt over shards of consecutive rows. A shard numbers its words, sorts the
suffixes of its documents (prefix doubling over packed words; a number of its own stands between
documents, so that no match crosses them) and looks every test suffix up by binary search, all
of a block at a time: the interval of the suffix array is narrowed by a few words a step, and at
the end the neighbours of the place say how long the longest verbatim match is. Test suffixes
that match a whole window give the interval of all their places, which are marked.

A window is `window` consecutive words of an item; an item of fewer words is one window.

Shards need nothing from each other, so texts aren't shuffled: a lost executor costs its
shards. Test items are dealt by a hash of their words over blocks of about `block_bytes`, and a
block is what a task holds of them. Each block is one pass over the texts, and what a pass
found is written before the next. Equal items are one with several ids.

Null and empty texts have no words: such documents are clean, such items occur nowhere. Very long
texts are cut into stretches that overlap by the longest item of the block. Repeated rows are judged each on
its own. Items without id mark documents but are not listed; items that share an id are
listed once. An empty table of documents gives an empty result, one of items leaves all clean. Other
columns pass through; where one has the name of the result's column, that gets underscores.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, plain
from pulse.llm.words import LETTERS_AND_DIGITS, joined_words, word_lists
from pulse.session import cut

WINDOW = 10
BLOCK_BYTES = 4_000_000
SHARD_WORDS = 1_000_000
_EXPANDED = 2_000_000
_LEAK = "n_words long, starts array<long>, ends array<long>, items array<string>"


class Block(NamedTuple):
    """Some test items as numbers of their distinct words; `first` is where each item begins, with the end."""

    words: list[bytes]
    numbers: np.ndarray
    first: np.ndarray
    ids: list[list[str]]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Block]:
    words = joined_words(plain(text_col).cast("string"), LETTERS_AND_DIGITS)
    classes = cut(
        items.select(plain(id_col).cast("string").alias("id"), words.alias("words")).where("words <> ''")
        .groupBy("words").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )
    size = F.octet_length("words") + F.octet_length(F.array_join("ids", ","))
    total = classes.agg(F.sum(size)).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        rows = classes.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).orderBy("words").collect()
        number: dict[bytes, int] = defaultdict(count().__next__)
        lists = [r["words"].encode("utf-8", "surrogatepass").split() for r in rows]
        if lists:
            numbers = np.array([number[w] for words in lists for w in words], np.int64)
            first = np.cumsum([0, *map(len, lists)])
            yield Block(list(number), numbers, first, [list(r["ids"]) for r in rows])


def packed(numbers: np.ndarray, bits: int, per: int) -> np.ndarray:
    """The next `per` numbers from each place as one; zeros stand behind the end, and one place more."""
    padded = np.concatenate([numbers, np.zeros(per + 1, np.int64)])
    keys = np.zeros(len(numbers) + 1, np.int64)
    for k in range(per):
        keys = keys << bits | padded[k : k + len(keys)]
    return keys


def suffix_array(keys: np.ndarray, per: int, depth: int) -> np.ndarray:
    """Order of the suffixes by their first `depth` words or more; `keys` hold `per` words each.

    Suffixes that agree so far share a rank; each round sorts the unsettled ones by the rank of what follows
    and doubles the words compared.
    """
    n = len(keys) - 1
    order = np.argsort(keys[:n], kind="stable")
    value = keys[order]
    last = np.flatnonzero(np.append(value[1:] != value[:-1], True)) if n else np.zeros(0, np.int64)
    size = np.diff(last, prepend=-1)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(last, size)
    unsettled = np.flatnonzero(np.repeat(size > 1, size))
    step = per
    while len(unsettled) and step < depth:
        rows = order[unsettled]
        follow = np.where(rows + step < n, rank[np.minimum(rows + step, n - 1)], -1)
        group = rank[rows]
        by = np.lexsort((follow, group))
        rows, group, follow = rows[by], group[by], follow[by]
        order[unsettled] = rows
        last = np.flatnonzero(np.append((group[1:] != group[:-1]) | (follow[1:] != follow[:-1]), True))
        size = np.diff(last, prepend=-1)
        rank[rows] = np.repeat(unsettled[last], size)
        unsettled = unsettled[np.repeat(size > 1, size)]
        step *= 2
    return order


class Shard:
    """Stretches of training texts, their suffix array, and binary searches in it."""

    def __init__(self, stretches: list[tuple[int, int, list[bytes]]], depth: int) -> None:
        """`stretches`: (row, word it begins with, words)."""
        number: dict[bytes, int] = defaultdict(count(1).__next__)
        lists = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for _, _, words in stretches]
        sizes = np.array([len(x) + 1 for x in lists], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.row = np.array([r for r, _, _ in stretches], np.int64)
        self.at = np.array([a for _, a, _ in stretches], np.int64)
        numbers = np.zeros(int(sizes.sum()), np.int64)
        for first, found in zip(self.first, lists, strict=True):
            numbers[first : first + len(found)] = found
        self.number = dict(number)
        self.bits = (len(number) + 1).bit_length()
        self.per = max(1, 62 // self.bits)
        self.keys = packed(numbers, self.bits, self.per)
        self.order = suffix_array(self.keys, self.per, depth)

    def test_keys(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Packed words of the items, each with zeros behind it, and where each begins."""
        unknown = len(self.number) + 1
        numbers = np.array([self.number.get(w, unknown) for w in block.words], np.int64)[block.numbers]
        sizes = np.diff(block.first)
        first = block.first[:-1] + np.arange(len(sizes)) * self.per
        spread = np.zeros(int(sizes.sum()) + len(sizes) * self.per, np.int64)
        spread[np.arange(len(numbers)) + np.repeat(first - block.first[:-1], sizes)] = numbers
        return packed(spread, self.bits, self.per), first

    def _behind(self, places: np.ndarray, offset: np.ndarray) -> np.ndarray:
        return self.keys[np.minimum(self.order[places] + offset, len(self.keys) - 1)]

    def lower(self, low: np.ndarray, high: np.ndarray, offset: int, value: np.ndarray) -> np.ndarray:
        """First place in each interval whose words from the `offset` on are not below the value."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) >> 1
            below = self._behind(middle, offset) < value[live]
            low[live[below]] = middle[below] + 1
            high[live[~below]] = middle[~below]
            live = live[low[live] < high[live]]
        return low

    def longest(self, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of each test suffix that stand somewhere here, and one such place of the text."""
        n = len(self.order)
        matched, place = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        low, high = np.zeros(len(start), np.int64), np.full(len(start), n)
        live = np.arange(len(start))
        offset = 0
        while n and len(live):
            value = keys[start[live] + offset]
            at = self.lower(low[live], high[live], offset, value)
            for near in (at - 1, at):
                inside = (near >= low[live]) & (near < high[live])
                found = self._behind(np.where(inside, near, 0), offset)
                same = sum(((found >> self.bits * k) == (value >> self.bits * k)).astype(np.int64) for k in range(self.per))
                words = np.where(inside, np.minimum(offset + same, length[live]), 0)
                better = words > matched[live]
                matched[live[better]] = words[better]
                place[live[better]] = self.order[near[better]]
            end = self.lower(at, high[live], offset, value + 1)
            offset += self.per
            low[live], high[live] = at, end
            live = live[(at < end) & (length[live] > offset)]
        return matched, place

    def places(self, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the suffix array whose suffixes begin with so many words of each test suffix."""
        low, high = np.zeros(len(start), np.int64), np.full(len(start), len(self.order))
        offset = 0
        while len(live := np.flatnonzero(length > offset)):
            left = np.maximum(self.per - (length[live] - offset), 0) * self.bits
            value = keys[start[live] + offset] >> left << left
            at = self.lower(low[live], high[live], offset, value)
            low[live], high[live] = at, self.lower(at, high[live], offset, value + (np.int64(1) << left))
            offset += self.per
        return low, high

    def source(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and word of a place of the text."""
        stretch = np.searchsorted(self.first, place, "right") - 1
        return self.row[stretch], self.at[stretch] + place - self.first[stretch]


def test_suffixes(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, first word and words of every suffix of every item."""
    sizes = np.diff(block.first)
    item = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(item)) - block.first[item]
    return item, at, sizes[item] - at


def shards(texts: list[str | None], block: Block, words_per_shard: int) -> Iterator[tuple[Shard | None, list[int]]]:
    """Shards of the texts, the last with None; beside it the words of each text so far."""
    depth = int(np.diff(block.first).max())
    sizes = [0] * len(texts)
    stretches, held = [], 0
    for row, text in enumerate(texts):
        before: list[bytes] = []
        for words in word_lists(text, LETTERS_AND_DIGITS, 4 * words_per_shard):
            stretches.append((row, sizes[row] - len(before), before + words))
            held += len(before) + len(words)
            sizes[row] += len(words)
            before = (before + words)[-(depth - 1) :] if depth > 1 else []
            if held >= words_per_shard:
                yield Shard(stretches, depth), sizes
                stretches, held = [], 0
    if stretches:
        yield Shard(stretches, depth), sizes
    yield None, sizes


def expanded(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive runs with a bounded sum of sizes (one alone may be larger)."""
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _EXPANDED, "right")))
        yield slice(at, end)
        at = end


def found_in(shard: Shard, block: Block, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first word, end) of the runs of hit words, and (row, item) of the items with a window there."""
    item, at, left = test_suffixes(block)
    size = np.diff(block.first)[item]
    need = np.minimum(window, size)
    whole = left >= need
    item, at, left, need = item[whole], at[whole], left[whole], need[whole]
    keys, first = shard.test_keys(block)
    matched, _ = shard.longest(keys, first[item] + at, left)
    hit = matched >= need
    item, at, need = item[hit], at[hit], need[hit]
    low, high = shard.places(keys, first[item] + at, need)
    # Equal windows of several items are one, with a list of items.
    _, one, which = np.unique(low * (window + 1) + need, return_index=True, return_inverse=True)
    low, high, need = low[one], high[one], need[one]
    edges = np.zeros(len(shard.order) + 1, np.int64)
    met = [np.zeros(0, np.int64)]
    rows = int(shard.row.max()) + 1
    for part in _pieces(high - low):
        sizes = (high - low)[part]
        place = shard.order[np.repeat(low[part], sizes) + expanded(sizes)]
        np.add.at(edges, place, 1)
        np.add.at(edges, place + np.repeat(need[part], sizes), -1)
        which_window = np.repeat(np.arange(part.start, part.start + len(sizes)), sizes)
        met.append(np.unique(which_window * rows + shard.source(place)[0]))
    runs = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1)
    row, word = shard.source(begin)
    spans = np.stack([row, word, word + end - begin], 1)
    met = np.concatenate(met)
    items_of = np.argsort(which, kind="stable")
    counts = np.bincount(which, minlength=len(low))
    starts = np.cumsum(counts) - counts
    pairs = [np.zeros(0, np.int64)]
    sizes = counts[met // rows] if len(met) else np.zeros(0, np.int64)
    for part in _pieces(sizes):
        here = met[part]
        listed = item[items_of[np.repeat(starts[here // rows], sizes[part]) + expanded(sizes[part])]]
        pairs.append(np.unique(np.repeat(here % rows, sizes[part]) * len(block.ids) + listed))
    pairs = np.unique(np.concatenate(pairs))
    return spans, np.stack([pairs // len(block.ids), pairs % len(block.ids)], 1)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def judged(texts: list[str | None], block: Block, window: int, words_per_shard: int = SHARD_WORDS) -> list[tuple]:
    """(n_words, merged spans, set of item ids) of each text."""
    spans: dict[int, list] = defaultdict(list)
    items: dict[int, set] = defaultdict(set)
    for shard, sizes in shards(texts, block, words_per_shard):
        if shard is None:
            return [(n, merged(spans[i]) if i in spans else [], items.get(i, set())) for i, n in enumerate(sizes)]
        runs, pairs = found_in(shard, block, window)
        for row, start, end in runs.tolist():
            spans[row].append((start, end))
        for row, item in pairs.tolist():
            items[row].update(block.ids[item])
    raise AssertionError("the last shard is followed by the sizes")


def _mark_block(block: Block, window: int, words_per_shard: int):
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for texts, earlier in batches:
            found = judged(list(texts), block, window, words_per_shard)
            out = []
            for (n, spans, ids), was in zip(found, earlier.itertuples(index=False), strict=True):
                if was.items is not None and len(was.items) + len(was.starts):
                    spans = merged([*spans, *zip(was.starts, was.ends, strict=True)])
                    ids = ids | set(was.items)
                out.append((n, [a for a, _ in spans], [b for _, b in spans], sorted(ids)))
            yield pd.DataFrame(out, columns=["n_words", "starts", "ends", "items"])

    return run


def mark(
    docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_text_col: str = "text",
    window: int = WINDOW, name: str = "leak", block_bytes: int = BLOCK_BYTES, words_per_shard: int = SHARD_WORDS,
) -> DataFrame:
    """The documents with a column `leak`: n_words, the runs of hit words (starts, ends), and the ids of the items
    that have a window there, in the order of strings."""
    bounded_batches(docs.sparkSession)
    while name in docs.columns:
        name += "_"
    nothing = Block([], np.zeros(0, np.int64), np.array([0, 0]), [])
    marked = docs.withColumn(name, F.lit(None).cast(f"struct<{_LEAK.replace(' ', ':').replace(',:', ',')}>"))
    passes = 0
    for block in item_blocks(items, id_col, item_text_col, block_bytes):
        judge = F.pandas_udf(_mark_block(block, window, words_per_shard), _LEAK)
        marked = (cut(marked) if passes else marked).withColumn(name, judge(plain(text_col).cast("string"), plain(name)))
        passes += 1
    if not passes:
        count_words = F.pandas_udf(_mark_block(nothing, window, words_per_shard), _LEAK)
        marked = marked.withColumn(name, count_words(plain(text_col).cast("string"), plain(name)))
    return marked


def remove_contaminated(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """The documents in which no window of any item occurs."""
    marked = mark(docs, items, **parameters)
    name = next(c for c in marked.columns if c not in docs.columns)
    return marked.where(F.size(plain(name)["starts"]) == 0).select(*[plain(c) for c in docs.columns])


def longest_matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", id_col: str = "item_id", text_col: str = "text",
    item_text_col: str = "text", at_least: int = 1, block_bytes: int = BLOCK_BYTES, words_per_shard: int = SHARD_WORDS,
) -> DataFrame:
    """(item_ids, item_start, length, id, start): the longest verbatim match of every test suffix over all shards, if
    it has so many words, and a document and word where it stands (of equal ones the smallest id). Items without id
    are left out."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(plain(doc_id).cast("string").alias("id"), plain(text_col).cast("string").alias("text"))
    shape = "item_ids array<string>, item_start long, length long, id string, start long"
    items = items.where(plain(id_col).isNotNull())
    out = None
    for block in item_blocks(items, id_col, item_text_col, block_bytes):

        def run(frames: Iterator[pd.DataFrame], block: Block = block) -> Iterator[pd.DataFrame]:
            item, at, left = test_suffixes(block)
            for frame in frames:
                for shard, _ in shards(list(frame["text"]), block, words_per_shard):
                    if shard is None:
                        continue
                    keys, first = shard.test_keys(block)
                    length, place = shard.longest(keys, first[item] + at, left)
                    some = np.flatnonzero(length >= at_least)
                    row, word = shard.source(place[some])
                    yield pd.DataFrame({
                        "item_ids": [block.ids[i] for i in item[some]], "item_start": at[some], "length": length[some],
                        "id": frame["id"].to_numpy()[row], "start": word,
                    })

        best = F.min(F.struct((-F.col("length")).alias("less"), "id", "start"))
        found = texts.mapInPandas(run, shape).groupBy("item_ids", "item_start").agg(best.alias("b")).select(
            "item_ids", "item_start", (-F.col("b.less")).alias("length"), "b.id", "b.start"
        )
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], shape)
