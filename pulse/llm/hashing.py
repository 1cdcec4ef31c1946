"""Hashes of many texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """From 64 mixed bits to a number above 0, at most 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


class Powers:
    """Powers of the base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                full = np.full(max(n, 1 << 16), _BASE, np.uint64)
                full[0] = 1
                self.up = np.cumprod(full)
                full[1:] = _INVERSE
                self.down = np.cumprod(full)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial of the bytes before i; two equal stretches differ by a power."""
    up, _ = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def stretches(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end, whatever stands before."""
    _, down = POWERS.upto(len(sums))
    raw = (sums[end] - sums[start]) * down[start]
    return mixed(raw ^ ((end - start).astype(np.uint64) << np.uint64(40)))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shingle_sets(texts: Sequence[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of all runs of so many words of each text, how often each occurs in it,
    and where each text's begin (with the end). A shorter text is one run, one without words has none."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    start, end = word_spans(joined)
    ids = stretches(prefix_sums(joined), start, end)
    first = np.searchsorted(start, begin)  # of each text, its first word
    value = np.zeros(max(0, len(ids) - words + 1), np.uint64)
    for k in range(words):
        value = mixed(value * _BASE + ids[k : k + len(value)])
    found, counts, sizes = [], [], [0]
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            v, n = np.unique(value[a : b - words + 1], return_counts=True)
        else:
            short = np.zeros(min(1, b - a), np.uint64)
            for k in range(a, b):
                short = mixed(short * _BASE + ids[k])
            v, n = short, np.ones(len(short), np.int64)
        found.append(v)
        counts.append(n)
        sizes.append(len(v))
    return np.concatenate(found), np.concatenate(counts), np.cumsum(sizes)


def batches(texts: Sequence[str], most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about so many characters; a longer text is alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
