"""Best-fit packing of documents into token sequences of a fixed length.

Bulk-synchronous best-fit: documents and the gaps of open sequences are sorted by size over
range partitions, a sweep from small to large matches each gap with the largest document that
fits and is still free (so a document meets its successor among the gaps), documents that want
the same gap are served by rank, gaps shrink by what they took, and the round repeats.

Pieces of one length are interchangeable, so the sweeps move runs: `n` documents of one
length, ranks `first` to `first + n - 1`, or `n` sequences of one gap. A round costs as many rows
as there are distinct sizes, at most `capacity` of each kind and a few more where runs were
cut, however many documents there are: also the second round, whose one range is one task. Documents
themselves are shuffled once, to number them within their length.

Null text is the empty text: one piece that holds the end token. Repeated rows are packed as
often as they occur. An empty table gives no pieces. Texts of any length are
encoded whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches, numbered
from pulse.session import cut

END_TOKEN = 2
MAX_CAPACITY = 65_536
_RUN = "kind string, size long, first long, n long, sequence_id long, offset long"
RANGES = 8


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The tokenizer, and a faster encoder of the same vocabulary where its file lies beside it."""
    import base64
    import os

    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    ranks_file = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_file):
        return tokenizer, None, special
    import public_tokenizers

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return tokenizer, fast, special


def encode(path: str, text: str | None) -> list[int]:
    """The tokenizer's ids. Texts without special tokens take the faster encoder, which gives the same."""
    tokenizer, fast, special = _encoders(path)
    if not text:
        return []
    if fast is not None and not any(s in text for s in special):
        try:
            return fast.encode_ordinary(text)
        except (ValueError, RuntimeError):  # its pattern engine gave up on an odd text
            pass
    return tokenizer.encode(text, add_special_tokens=False).ids


def tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text, then the end token."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = [[*encode(tokenizer, t), END_TOKEN] for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": ids})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>")


def cuts(length: int, capacity: int) -> list[int]:
    """Starts of a document's pieces and its end: the first piece takes what is over."""
    first = length % capacity or min(capacity, length)
    return [0, *range(first, length + 1, capacity)]


def lengths(
    docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, length, crcs): a document's ids, and the checksum of each of its pieces."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes, crcs = [], []
            for text in frame["text"]:
                ids = np.array([*encode(tokenizer, text), END_TOKEN], "<u4")
                at = cuts(len(ids), capacity)
                sizes.append(len(ids))
                crcs.append([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "length": sizes, "crcs": crcs})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, length long, crcs array<long>")


def sweep(docs: list[tuple], gaps: list[tuple], capacity: int) -> tuple[list, list, list]:
    """One sweep over runs of documents (size, first, n) and gaps (size, first, n).

    Gives matches (document size, first rank, n, first sequence, offset) and the runs that
    are left of both kinds. Very short documents, a sixteenth of a sequence at most, may fill
    a gap several times in one sweep.
    """
    matches, left = [], []
    stack: list[list[int]] = []
    events = sorted([(s, 0, f, n) for s, f, n in docs] + [(s, 1, f, n) for s, f, n in gaps])
    for size, is_gap, first, n in events:
        if not is_gap:
            stack.append([size, first, n])
            continue
        work = [(size, first, n, True)]
        while work:
            size, first, n, may_take = work.pop()
            if not may_take or not stack or stack[-1][0] > size:
                left.append((size, first, n))
                continue
            top = stack[-1]
            m = min(n, top[2])
            top[2] -= m
            matches.append((top[0], top[1] + top[2], m, first, capacity - size))
            if n > m:
                work.append((size, first + m, n - m, True))
            if size > top[0]:
                work.append((size - top[0], first, m, top[0] * 16 <= capacity))
            if not top[2]:
                stack.pop()
    return matches, [tuple(x) for x in stack], left


def _rounds(capacity: int):
    """Sweeps within a range of sizes until none of its gaps can take any of its documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame(columns=["kind", "size", "first", "n"]), *frames])
        both = {k: list(g[["size", "first", "n"]].itertuples(index=False, name=None)) for k, g in rows.groupby("kind")}
        docs, gaps, out = both.get("doc", []), both.get("gap", []), []
        while docs and gaps:
            matches, docs, gaps = sweep(docs, gaps, capacity)
            out += [("match", *m) for m in matches]
            if not matches:
                break
        out += [("doc", *d, None, None) for d in docs] + [("gap", *g, None, None) for g in gaps]
        yield pd.DataFrame(out, columns=["kind", "size", "first", "n", "sequence_id", "offset"])

    return run


def place(runs: DataFrame, capacity: int) -> DataFrame:
    """Rounds over (size, n) of the documents: rows (size, first, n, sequence_id, offset) that say where
    the documents `first` to `first + n - 1` of a size go: into consecutive sequences, at one offset.

    A round sweeps RANGES ranges of sizes at once. What is left of them, documents without a gap of their range and gaps
    without a document, is looked over in a second round of one range; only then are sequences opened for what
    found no place, and the next two rounds begin.
    """
    docs = runs.select(
        F.lit("doc").alias("kind"), "size", F.lit(0).cast("long").alias("first"), "n",
        F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"),
    )
    spark, opened, placed = runs.sparkSession, 0, []
    state, open_new, parts = cut(docs), True, RANGES
    while True:
        is_doc = F.col("kind") == "doc"
        total, least = state.agg(F.sum(F.when(is_doc, F.col("size") * F.col("n"))), F.min(F.when(is_doc, F.col("size")))).first()
        if not total:
            break
        if open_new:
            count = -(-total // capacity)
            new = spark.range(1).selectExpr(
                "'gap' AS kind", f"CAST({capacity} AS BIGINT) AS size", f"CAST({opened} AS BIGINT) AS first",
                f"CAST({count} AS BIGINT) AS n", "CAST(NULL AS BIGINT) AS sequence_id", "CAST(NULL AS BIGINT) AS offset",
            )
            state, opened, parts = state.unionByName(new), opened + count, RANGES
        useful = state.where((F.col("kind") == "doc") | (F.col("size") >= least))
        ranged = useful.repartitionByRange(parts, "size") if parts > 1 else useful.coalesce(1)
        done = cut(ranged.mapInPandas(_rounds(capacity), _RUN))
        placed.append(done.where("kind = 'match'"))
        open_new, parts = parts == 1, 1
        state = done.where("kind <> 'match'")
    result = placed[0] if placed else state
    for more in placed[1:]:
        result = result.unionByName(more)
    return result.drop("kind")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    `capacity` up to 65,536 tokens. The table of placements is broadcast: its rows are runs, bounded by the
    capacity and the handful of rounds, not by the documents. `sequences` builds the token arrays.
    """
    if not 0 < capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be 1 to {MAX_CAPACITY}")
    bounded_batches(docs.sparkSession)
    rows = cut(lengths(docs, tokenizer, capacity, id_col, text_col))
    first = F.when(F.col("length") % capacity == 0, F.lit(capacity)).otherwise(F.col("length") % capacity)
    ranked = cut(numbered(rows.withColumn("size", first.cast("long")), "size", ["doc_id", "length", "crcs"]))
    places = place(ranked.groupBy("size").agg(F.count("*").alias("n")), capacity)
    by_size = places.groupBy("size").agg(
        F.sort_array(F.collect_list(F.struct("first", "sequence_id", "offset"))).alias("places")
    )
    most = ranked.agg(F.max(F.size("crcs"))).first()[0] or 1
    found = F.element_at(F.filter("places", lambda p: p["first"] <= F.col("rank")), -1)
    placed = ranked.join(F.broadcast(by_size), "size").withColumn("place", found)
    pieces = placed.select(
        "doc_id", "size", "rank", "place", F.posexplode("crcs").alias("piece", "ids_crc32")
    )
    # Full pieces fill a sequence of their own; its number is made of the document's (size, rank) and the piece.
    alone = -((F.col("rank") * capacity + F.col("size") - 1) * most + F.col("piece")) - 1
    is_first = F.col("piece") == 0
    return pieces.select(
        "doc_id",
        "piece",
        F.when(is_first, 0).otherwise(F.col("size") + (F.col("piece") - 1) * capacity).cast("long").alias("start"),
        F.when(is_first, F.col("size")).otherwise(capacity).cast("long").alias("length"),
        "ids_crc32",
        F.when(is_first, F.col("place.sequence_id") + F.col("rank") - F.col("place.first"))
        .otherwise(alone).cast("long").alias("sequence_id"),
        F.when(is_first, F.col("place.offset")).otherwise(0).cast("long").alias("offset"),
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the token arrays themselves. Ids of documents must be distinct here."""
    ids = tokens(docs, tokenizer, id_col, text_col)
    parts = packed.join(ids, "doc_id").select(
        "sequence_id", "offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids")
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
