"""Prefix trie of conversations from sorted sequences and their common prefixes.

A turn becomes a record of 24 bytes: 16 bytes of the SHA-256 of (role, text)
and the text's length in bytes; a conversation is the string of its records.
Distinct conversations are sorted by that string (a range partition, then a
sort in each), and cut into *blocks* of bounded size.  A block knows the number
of turns that each conversation shares with the one before it (its LCPs).

A node of the trie, a prefix of d turns, is the interval of sorted
conversations around any of its members in which no LCP is below d.  Every
candidate prefix searches its left and its right end on its own, by binary
search over a sparse table of range minima; no stack, no order between
candidates.  Inside a block the table is local.  Beyond it, the search goes on
in a small table of all blocks' *edge rows*: the rows whose LCP is below all
before them (or all behind them) in their block.  These are the only rows at
which a search coming from outside can stop; a block has no more of them than
twice the turns of a conversation, usually a handful.  They carry the sums over
the rows up to the next one, so all figures of a node are differences of
running sums between its two ends:

* members, leaves: sums over the interval;
* saved tokens, the sum over the subtree of (members - 1) * bytes: members'
  total bytes less (members times) the shared prefix, minus the bytes that each
  conversation adds to the one before it;
* children: how often the LCP is exactly d inside the interval.

Equal conversations meet first per run of 4096 ids, so a conversation that a
third of all ids repeat reaches its block as one row per 4096 ids; their
SHA-256, which cannot be computed in parts, is fed run by run and never held.

Defined cases: null role or text is empty; rows of one conversation with the
same turn go by role, then by digest of the text; null turns come first; rows
without conversation id belong to none; repeated rows are turns; a conversation
without turns is a member of the root; an empty table has no node; other
columns are ignored.  One conversation's records (24 bytes a turn, whatever its
texts) are one row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import materialise, ship

RECORD = 24
#: A block ends at so many bytes of records or rows.
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16
#: Ids of equal conversations are first put together in runs of so many.
ID_RUN = 4096
NONE = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_record(role: Column, text: Column) -> Column:
    """48 hex digits: a digest of (role, text) and the text's bytes."""
    payload = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(payload, 256), 1, 32), F.lower(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """conv_id, turns: a record per turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                role.alias("role"), turn_record(role, text).alias("record")).where("conv_id IS NOT NULL")
    turns = F.sort_array(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "record")))
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: t["record"]).alias("turns"))


# ------------------------------------------------------------------ blocks

def common_prefixes(lengths: np.ndarray, records: np.ndarray) -> np.ndarray:
    """Turns that each row after the first shares with the row before it."""
    at = np.concatenate([[0], np.cumsum(lengths)])
    least = np.minimum(lengths[:-1], lengths[1:])
    k = np.arange(least.sum()) - np.repeat(np.cumsum(least) - least, least)
    row = np.repeat(np.arange(len(least)), least)
    differ = np.flatnonzero((records[at[row] + k] != records[at[row + 1] + k]).any(1))
    out = least.copy()
    rows, first = np.unique(row[differ], return_index=True)
    out[rows] = k[differ[first]]
    return out


def _records(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u8").reshape(-1, 3)


def shared_turns(a: bytes, b: bytes) -> int:
    x, y = _records(a), _records(b)
    n = min(len(x), len(y))
    differ = np.flatnonzero((x[:n] != y[:n]).any(1))
    return int(differ[0]) if len(differ) else n


@dataclass
class Rows:
    """The rows of a block, with what each adds to the running sums."""

    lengths: np.ndarray
    records: np.ndarray
    members: np.ndarray
    ids: np.ndarray
    lcp: np.ndarray        # of the first row: with the block before
    next_lcp: int          # of the row after the block, -1 at the end

    def __post_init__(self):
        self.at = np.concatenate([[0], np.cumsum(self.lengths)])
        sizes = self.records[:, 2].astype(np.int64)
        self.bytes_before = np.concatenate([[0], np.cumsum(sizes)])   # per record
        self.total = self.bytes_before[self.at[1:]] - self.bytes_before[self.at[:-1]]
        after = np.append(self.lcp[1:], self.next_lcp)
        self.leaf = (after < self.lengths).astype(np.int64)
        self.added = self.total - self.prefix(np.arange(len(self.lengths)), np.maximum(self.lcp, 0))
        self.sums = np.stack([self.members, self.leaf, self.members * self.total, self.added])

    def prefix(self, row, d):
        """Bytes of the first d turns."""
        return self.bytes_before[self.at[row] + d] - self.bytes_before[self.at[row]]


def edge_rows(lcp: np.ndarray) -> np.ndarray:
    """Rows at which a search from outside can stop: the first row, and those
    whose LCP is below all others before, or all others behind them."""
    inner = lcp[1:]
    if not len(inner):
        return np.zeros(1, np.int64)
    before = np.minimum.accumulate(inner)
    behind = np.minimum.accumulate(inner[::-1])[::-1]
    keep = np.ones(len(inner), bool)
    keep[1:] = (inner[1:] < before[:-1])
    last = np.ones(len(inner), bool)
    last[:-1] = inner[:-1] < behind[1:]
    return np.concatenate([[0], np.flatnonzero(keep | last) + 1])


def _edges(rows: Rows) -> dict:
    """The edge rows' part of a block's row; what depends on the neighbours
    (the first LCP, the last leaf) is filled in when all blocks are known."""
    at = edge_rows(rows.lcp)
    sums = np.add.reduceat(rows.sums, at, axis=1)
    inner, count = np.full(len(at), NONE), np.zeros(len(at), np.int64)
    for k, (lo, hi) in enumerate(zip(at + 1, np.append(at[1:], len(rows.lcp)))):
        if hi > lo:
            inner[k] = rows.lcp[lo:hi].min()
            count[k] = (rows.lcp[lo:hi] == inner[k]).sum()
    return {"lcp": rows.lcp[at], "sums": sums, "least_id": np.minimum.reduceat(rows.ids, at), "inner": inner, "count": count}


BLOCK_SCHEMA = ("block long, first binary, last binary, lcp array<long>, sum0 array<long>, sum1 array<long>, "
                "sum2 array<long>, sum3 array<long>, least_id array<long>, inner array<long>, count array<long>, "
                "lengths array<int>, data binary, members array<long>, ids array<long>, ends array<string>")


def _cut_blocks(block_bytes: int, block_rows: int):
    """Sorted rows (seq, run, part, n, least) -> blocks, one row each."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        done: list[tuple] = []      # sequence, members, least id, digest of its ids
        size = 0
        now, digest, members, least = None, None, 0, 0

        def block():
            nonlocal done, size, number
            lengths = np.array([len(s) // RECORD for s, *_ in done], np.int64)
            data = b"".join(s for s, *_ in done)
            records = _records(data)
            lcp = np.concatenate([[0], common_prefixes(lengths, records)])
            rows = Rows(lengths, records, np.array([m for _, m, _, _ in done], np.int64),
                        np.array([i for _, _, i, _ in done], np.int64), lcp, -1)
            e = _edges(rows)
            row = {"block": number, "first": done[0][0], "last": done[-1][0], "lcp": e["lcp"].tolist(),
                   **{f"sum{k}": e["sums"][k].tolist() for k in range(4)}, "least_id": e["least_id"].tolist(),
                   "inner": e["inner"].tolist(), "count": e["count"].tolist(), "lengths": lengths.tolist(), "data": data,
                   "members": rows.members.tolist(), "ids": rows.ids.tolist(), "ends": [h for *_, h in done]}
            done, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pylist([row], BLOCK_ARROW)

        for b in batches:
            for seq, part, n, low in zip(*[b.column(c).to_pylist() for c in ("seq", "part", "n", "least")]):
                if seq == now:
                    digest.update(b"," + part.encode())
                    members, least = members + n, min(least, low)
                    continue
                if now is not None:
                    done.append((now, members, least, digest.hexdigest()))
                    size += len(now)
                    if size >= block_bytes or len(done) >= block_rows:
                        yield block()
                now, digest, members, least = seq, hashlib.sha256(part.encode()), n, low
        if now is not None:
            done.append((now, members, least, digest.hexdigest()))
        if done:
            yield block()
    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c, kinds[k]) for c, k in (x.split(" ") for x in ddl.split(", "))])


BLOCK_ARROW = _arrow(BLOCK_SCHEMA)


# ------------------------------------------------------------- range minima

def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """table[k][i] = min(values[i:i + 2**k])."""
    out = [values]
    k = 1
    while 2 * k <= len(values):
        out.append(np.minimum(out[-1][:-k], out[-1][k:]))
        k *= 2
    return out


def first_below(table: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Per query the first place from ``start`` on whose value is below ``d``
    (the length if none), by binary search over the powers of two."""
    at, n = start.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        fits = at + (1 << k) <= n
        fits[fits] = table[k][at[fits]] >= d[fits]
        at[fits] += 1 << k
    return at


def last_below(table: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Per query the last place up to ``start`` whose value is below ``d`` (-1 if none)."""
    n = len(table[0])
    back = [t[::-1] for t in table]
    return n - 1 - first_below(back, n - 1 - start, d)


def range_min(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) per query, ``NONE`` where empty."""
    out = np.full(len(lo), NONE)
    some = np.flatnonzero(hi > lo)
    if len(some):
        k = np.frexp((hi - lo)[some].astype(float))[1] - 1
        for size in np.unique(k):
            q = some[k == size]
            out[q] = np.minimum(table[size][lo[q]], table[size][hi[q] - (1 << int(size))])
    return out


class Occurrences:
    """How often a value occurs in a range of places."""

    def __init__(self, values: np.ndarray, places: np.ndarray, counts: np.ndarray, width: int):
        order = np.lexsort((places, values))
        self.width = width
        self.key = values[order] * width + places[order]
        self.before = np.concatenate([[0], np.cumsum(counts[order])])

    def between(self, value, lo, hi):
        at = value * self.width
        return (self.before[np.searchsorted(self.key, at + hi)] - self.before[np.searchsorted(self.key, at + lo)]).clip(0)


# ----------------------------------------------------------------- all edges

class Edges:
    """The edge rows of all blocks in order, with running sums."""

    def __init__(self, blocks: list[dict]):
        blocks = sorted(blocks, key=lambda b: b["first"])
        self.order = {b["block"]: k for k, b in enumerate(blocks)}
        first_lcp = [-1] + [shared_turns(a["last"], b["first"]) for a, b in zip(blocks, blocks[1:])]
        self.first_lcp = np.array([*first_lcp, -1], np.int64)
        self.start = np.concatenate([[0], np.cumsum([len(b["lcp"]) for b in blocks])]).astype(np.int64)
        self.lcp = np.concatenate([np.array(b["lcp"], np.int64) for b in blocks])
        self.lcp[self.start[:-1]] = first_lcp
        sums = np.concatenate([np.array([b[f"sum{k}"] for k in range(4)], np.int64).reshape(4, -1) for b in blocks], 1)
        for k, b in enumerate(blocks):
            last, first = _records(b["last"]), _records(b["first"])
            # cut as if alone: the last row as a leaf, the first row with all its bytes
            sums[1, self.start[k + 1] - 1] -= int(self.first_lcp[k + 1] >= len(last))
            sums[3, self.start[k]] -= int(first[:max(first_lcp[k], 0), 2].sum(dtype=np.int64))
        self.before = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(sums, axis=1)], 1)
        least = np.concatenate([np.array(b["least_id"], np.int64) for b in blocks])
        inner = np.concatenate([np.array(b["inner"], np.int64) for b in blocks])
        count = np.concatenate([np.array(b["count"], np.int64) for b in blocks])
        n = len(self.lcp)
        some = np.flatnonzero(count)
        self.occurs = Occurrences(
            np.concatenate([self.lcp + 1, inner[some] + 1]), np.concatenate([2 * np.arange(n), 2 * some + 1]),
            np.concatenate([np.ones(n, np.int64), count[some]]), 2 * n + 2)
        self.table, self.least = sparse_table(self.lcp), sparse_table(least)


def block_nodes(row: dict, edges: Edges) -> dict[str, np.ndarray]:
    """All nodes whose first member is in this block."""
    j = edges.order[row["block"]]
    lengths = np.array(row["lengths"], np.int64)
    records = _records(row["data"])
    n = len(lengths)
    lcp = np.concatenate([edges.first_lcp[j:j + 1], common_prefixes(lengths, records)])
    rows = Rows(lengths, records, np.array(row["members"], np.int64), np.array(row["ids"], np.int64), lcp,
                int(edges.first_lcp[j + 1]))
    here, after = edges.start[j], edges.start[j + 1]
    before = edges.before[:, here:here + 1] + np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(rows.sums, axis=1)], 1)
    table, least = sparse_table(lcp), sparse_table(rows.ids)
    occurs = Occurrences(lcp + 1, np.arange(n), np.ones(n, np.int64), n + 1)

    def extent(i, d):
        """Ends of the interval of prefix d of row i: left row or -1 and its edge row, right row or n and its edge row."""
        left, right = last_below(table, i, d), first_below(table, i + 1, d)
        far_left, far_right = np.full(len(i), here), np.full(len(i), after)
        q = np.flatnonzero(left < 0)
        if len(q):
            far_left[q] = last_below(edges.table, np.full(len(q), here - 1), d[q])
        q = np.flatnonzero(right >= n)
        if len(q):
            far_right[q] = first_below(edges.table, np.full(len(q), after), d[q])
        return left, far_left, right, far_right

    def least_member(left, far_left, right, far_right):
        out = range_min(least, np.maximum(left, 0), right)
        out = np.minimum(out, range_min(edges.least, far_left, np.full(len(left), here)))
        return np.minimum(out, range_min(edges.least, np.full(len(left), after), far_right))

    # candidates: the prefixes that a row does not share with the row before
    own = lengths - lcp
    i = np.repeat(np.arange(n), own)
    d = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + lcp[i] + 1
    left, far_left, right, far_right = extent(i, d)
    beyond = right >= n
    end = np.where(beyond[None], edges.before[:, far_right], before[:, right])
    members, leaves, member_bytes, added = end - before[:, left]
    conv = least_member(left, far_left, right, far_right)
    children = (lengths[left] > d) + occurs.between(d + 1, left + 1, right)
    q = np.flatnonzero(beyond)
    children[q] += edges.occurs.between(d[q] + 1, np.full(len(q), 2 * after), 2 * far_right[q])
    # of the subtree: every member's bytes behind the shared ones, less those written once
    shared = rows.prefix(left, np.maximum(d - 1, 0))
    once = added - rows.added[left] + rows.total[left] - shared
    saved = member_bytes - members * shared - once
    # the parent is the candidate before, or, for a row's first one, the prefix shared with the row before
    parent = np.concatenate([[0], conv[:-1]])
    starts = np.flatnonzero((d == lcp[i] + 1) & (d > 0))
    if len(starts):
        parent[starts] = least_member(*extent(i[starts], d[starts] - 1))
    return {"row": i, "ends_here": d == lengths[i], "conv_id": conv, "depth": d, "parent_conv_id": parent, "n_convs": members,
            "n_children": children, "n_leaves": leaves, "saved_tokens": saved}


NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string")


def _nodes(shared):
    def run(batches):
        edges = shared.value
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                x = block_nodes(row, edges)
                ends = pa.array(row["ends"]).take(pa.array(np.where(x["ends_here"], x["row"], 0)))
                ends = pc.if_else(pa.array(x["ends_here"]), ends, NO_ENDS)
                cols = [pa.array(x[c], pa.int64(), mask=(x["depth"] == 0) if c == "parent_conv_id" else None)
                        for c in (c.split(" ")[0] for c in NODE_SCHEMA.split(", ")[:-1])]
                yield pa.RecordBatch.from_arrays([*cols, ends], [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")])
    return run


def trie(turns: DataFrame, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, turns: records): conv_id
    (the smallest member; its first ``depth`` turns are the node), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    ship(spark)
    runs = (turns.select(F.unhex(F.array_join("turns", "")).alias("seq"), "conv_id",
                         F.floor(F.col("conv_id") / ID_RUN).alias("run"))
            .groupBy("seq", "run").agg(
                F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("part"),
                F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")))
    blocks = materialise(runs.repartitionByRange("seq").sortWithinPartitions("seq", "run")
                         .select("seq", "part", "n", "least").mapInArrow(_cut_blocks(block_bytes, block_rows), BLOCK_SCHEMA),
                         "trie-blocks")
    # a few edge rows a block: no more than twice its longest conversation's turns
    edge_columns = [c for c in blocks.columns if c not in ("lengths", "data", "members", "ids", "ends")]
    found = [r.asDict() for r in blocks.select(*edge_columns).collect()]
    if not found:
        return spark.createDataFrame([], NODE_SCHEMA)
    shared = spark.sparkContext.broadcast(Edges(found))
    return (blocks.select("block", "lengths", "data", "members", "ids", "ends")
            .mapInArrow(_nodes(shared), NODE_SCHEMA))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """The trie of a table of turns."""
    return trie(sequences(conversations, conv_col, turn_col, role_col, text_col))
