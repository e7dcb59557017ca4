"""Whole-text helpers that run inside Arrow tasks.

``words`` are maximal runs of bytes other than space and TAB..CR, exactly what
``bytes.split()`` yields; ``A-Z`` lower-casing is ``bytes.lower()``.  The numpy
path hashes all words of a slice of documents at once: every byte is mapped to
a random 64-bit value, multiplied by a power of an odd constant for its place
in the word, and summed per word modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240917).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _ODD, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of a slice of documents, in order."""

    data: np.ndarray       # the slice's bytes
    offsets: np.ndarray    # document i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray     # first byte of each word
    ends: np.ndarray       # byte after each word
    hashes: np.ndarray     # 64-bit hash of each word
    first: np.ndarray      # document i has words first[i]:first[i + 1]


def words_of(texts: pa.Array, lower: bool) -> Words:
    """Words of every (non-null or null = empty) text of an Arrow array."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and offsets[-1] > offsets[0] \
        else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    if not len(data):
        zero = np.zeros(0, np.int64)
        return Words(data, offsets, zero, zero, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    if len(starts):
        place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        value = _BYTES[data[starts[0]:]]
        value[~inside[starts[0]:]] = 0
        longest = int((ends - starts).max())
        np.minimum(place, longest - 1, out=place)
        value *= powers(longest)[place]
        hashes = mix(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype(np.uint64) * _ODD)
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weight = powers(size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += hashes[j:j + n] * weight[j + 1]
    return mix(out)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's words; a document with
    fewer words than ``size`` has its whole sequence as its one shingle."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    if len(hashes) < size:
        return mix(windows(hashes, len(hashes)) ^ np.uint64(len(hashes)))
    return np.unique(windows(hashes, size))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` text bytes each
    (one row where a single text is longer)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    size = size.to_numpy(zero_copy_only=False).astype(np.int64)
    total, at, n = np.cumsum(size), 0, batch.num_rows
    while at < n:
        base = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def by_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text",
             limit: int = SLICE_BYTES):
    """A ``mapInArrow`` function that applies ``fn`` to bounded slices."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                out = fn(part)
                if out is not None:
                    yield out
    return run
