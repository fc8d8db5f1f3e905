"""Words and word hashes of whole Arrow text columns, as NumPy arrays.

Every function takes a column at a time: a batch of texts is one byte array with
offsets, so the work per byte is a few array operations and no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 18  # texts handled at once; a longer text is a slice of its own
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: A byte of a word: anything but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: A byte of a word: ASCII digits and letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _table(base: np.uint64, length: int) -> np.ndarray:
    """Powers of an odd base modulo 2^64, grown on demand."""
    known = _powers.get(int(base))
    if known is None or len(known) < length:
        steps = np.full(max(length, 2 * SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        known = _powers[int(base)] = np.cumprod(steps)
    return known[:length]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of at most BATCH_ROWS rows.

    Spark's default of 10,000 rows suits numbers; as many whole texts, and what
    is made of them, would be held by the executor and by its Python worker at once.
    """
    rows = int(spark.conf.get(_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_ROWS, BATCH_ROWS)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run values[starts[i]:ends[i]], the same wherever the run stands.

    Differences of one running sum, so the cost does not depend on how runs lie.
    """
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _table(_BASE, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _table(_INVERSE, len(values) + 1)[starts])


class Words(NamedTuple):
    """The words of a slice of texts; text i has the words first[i] to first[i + 1]."""

    hashes: np.ndarray  # of the words with A-Z lower-cased
    first: np.ndarray
    starts: np.ndarray  # byte positions in `data`
    ends: np.ndarray
    data: np.ndarray  # the bytes of all texts, A-Z lower-cased


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array without nulls: a missing text is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[pa.Array]:
    """Consecutive parts of the column of about SLICE_BYTES bytes."""
    texts = plain(texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each."""
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[where[0] : where[-1]], where - where[0]


def words(texts: pa.Array, letters: np.ndarray) -> Words:
    """Words are the longest runs of bytes that `letters` admits; none spans two texts."""
    data, offsets = flat(texts)
    data = _LOWER[data]
    inside = letters[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][some], offsets[1:][some] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(run_hashes(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data)


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words in text order, and where each text's begin.

    A text with fewer words, but at least one, has one: its whole sequence.
    """
    n = np.diff(found.first)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(found.first[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    length = np.repeat(np.minimum(n, k), counts)
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        seen = length > j
        step = found.hashes[np.where(seen, at + j, 0)] if len(found.hashes) else out
        out = np.where(seen, mixed(out * np.uint64(0x9FB21C651E98DF25) + step), out)
    return out, offsets
