"""Best-fit packing with exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens.  Only the counts of
pieces per length, at most ``capacity`` numbers, reach the driver, where a
plan is made over lengths: a *pattern* is a list of lengths and how many
sequences repeat it.  The largest length left opens a pattern; single, pair
and triple length sums, indexed by hash of their total, are searched for one
that fills the gap exactly under the counts left; if there is none, the
largest length that fits (best fit) is added and the search goes on with the
smaller gap.  A pattern is used as often as its scarcest length allows, so
each pattern exhausts a length and there are at most ``capacity`` patterns.

Pieces then take their places: a piece's rank among those of its length
selects pattern, sequence and offset by binary search in the plan, which is
broadcast (bounded by the capacity, not by the data).

Defined cases: a null or empty text is the end token alone; repeated rows are
separate documents, each packed; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.chunks import library_encoder, worker_encoder
from statlake.llm.frames import id_text, materialise
from statlake.llm.text import by_slice


BUCKET_PIECES = 100_000   # pieces of one length ranked by one task
PIECE_SLICE = 4 << 20     # text bytes encoded together: each distinct word is looked up once


@dataclass
class Plan:
    """Segments sorted by (length, first rank): pieces of ``length`` with ranks
    from ``rank`` on are dealt round ``repeat`` sequences from ``sequence`` on,
    starting at ``offset`` in each."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    repeat: np.ndarray
    offset: np.ndarray
    sequences: int


class LengthIndex:
    """Counts left by length, and how many pairs of available lengths have each sum."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.there = self.left > 0
        self.there[0] = False
        n = len(counts)
        self.pairs = np.zeros(2 * n, np.int64)   # unordered pairs a <= b of available lengths, by a + b
        for a in np.flatnonzero(self.there):
            self._pairs_of(int(a), 1, a)

    def _pairs_of(self, a: int, sign: int, least: int) -> None:
        with_b = np.flatnonzero(self.there[least:]) + least
        self.pairs[a + with_b] += sign

    def take(self, used: dict[int, int], times: int) -> None:
        for length, each in used.items():
            self.left[length] -= each * times
            if self.left[length] == 0:
                self._pairs_of(length, -1, 0)
                self.there[length] = False

    def spare(self, length: int, used: dict[int, int]) -> int:
        return int(self.left[length]) - used.get(length, 0)

    def fits(self, parts: tuple[int, ...], used: dict[int, int]) -> bool:
        return all(self.spare(p, used) >= parts.count(p) for p in parts)

    def pair(self, total: int, used: dict[int, int]) -> tuple[int, int] | None:
        if total < 2 or not self.pairs[total]:
            return None
        half = np.arange(total // 2, 0, -1)
        big = total - half
        ok = big < len(self.left)
        half, big = half[ok], big[ok]
        found = half[self.there[half] & self.there[big]]
        for a in found[::-1].tolist():   # the largest partner first
            if self.fits((total - a, a), used):
                return total - a, a
        return None

    def exact(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three available lengths whose sum is exactly ``gap``."""
        if self.there[gap] and self.fits((gap,), used):
            return (gap,)
        if two := self.pair(gap, used):
            return two
        first = np.flatnonzero(self.there[:gap])
        for a in first[self.pairs[gap - first] > 0][::-1].tolist():
            if self.spare(a, used) > 0 and (two := self.pair(gap - a, used | {a: used.get(a, 0) + 1})):
                return (a, *two)
        return None


def plan_lengths(counts: np.ndarray, capacity: int) -> Plan:
    """``counts[n]`` pieces of n tokens, 1 <= n <= capacity, into few sequences."""
    index = LengthIndex(counts)
    rows, given, sequences = [], np.zeros(capacity + 1, np.int64), 0
    for top in range(capacity, 0, -1):
        while index.left[top] > 0:
            used, order, gap = {top: 1}, [(top, 1)], capacity - top
            while gap:
                parts = index.exact(gap, used)
                if parts is None:
                    fit = np.flatnonzero(index.there[1:gap + 1]) + 1
                    fit = next((int(f) for f in fit[::-1] if index.spare(int(f), used) > 0), 0)
                    if not fit:
                        break
                    parts = (fit,)
                for p in parts:
                    used[p] = used.get(p, 0) + 1
                    order.append((p, 1))
                    gap -= p
            times = min(int(index.left[p]) // n for p, n in used.items())
            offset = 0
            for p, _ in order:
                rows.append((p, given[p], sequences, times, offset))
                given[p] += times
                offset += p
            index.take(used, times)
            sequences += times
    cols = np.array(rows, np.int64).reshape(-1, 5)
    cols = cols[np.lexsort((cols[:, 1], cols[:, 0]))]
    return Plan(*cols.T, sequences)


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids_crc32."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = worker_encoder(("library", vocabulary), lambda: library_encoder(spec.value))
        texts = [t or "" for t in batch.column("text").to_pylist()]
        end, out = np.uint32(end_id).tobytes(), [[], [], [], [], []]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(texts)):
            ids += end
            for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                part = ids[4 * at:4 * (at + capacity)]
                for col, v in zip(out, (doc_id, k, at, len(part) // 4, zlib.crc32(part))):
                    col.append(v)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                          ["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_text(docs, id_col, text_col).mapInArrow(
        by_slice(run, limit=PIECE_SLICE), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096,
         id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Pieces with their place: sequence_id and offset added.  ``buckets``: tasks
    that rank the pieces of one length; by default one per ``BUCKET_PIECES`` of
    the most frequent length, so a length that a third of all pieces have is
    ranked by as many tasks as it needs."""
    cut = materialise(pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():   # at most ``capacity`` rows
        counts[length] = n
    plan = plan_lengths(counts, capacity)
    if buckets is None:
        buckets = max(64, int(counts.max()) // BUCKET_PIECES)
    key = plan.length << 40 | plan.rank
    shared = docs.sparkSession.sparkContext.broadcast((key, plan.rank, plan.sequence, plan.repeat, plan.offset))

    # rank within the length, in two steps: within a bucket, and the buckets before
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    cut = cut.withColumn("bucket", bucket)
    before = cut.groupBy("length", "bucket").count().select(
        "length", "bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("bucket"))
                             - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket")
                              .orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = cut.withColumn("own", own).join(before, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32",
                           (F.col("before") + F.col("own")).alias("rank"))

    def place(batches):
        key, first, sequence, repeat, offset = shared.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, length << 40 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
