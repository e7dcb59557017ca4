"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from statlake.llm import prefix_trie
from statlake.llm.frames import table
from statlake.llm.queries import op12_prefix_trie, rebuilt
from tests.conftest import SMOKE_DIR

SCHEMA = "conv_id long, turn long, role string, text string, seq string, run string, block string, n string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def sequences(rows):
    by = {}
    for c, t, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


def brute(convs):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    nodes = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            node = nodes.setdefault(tuple(convs[c][:d]), {"members": [], "ends": [], "kids": set()})
            node["members"].append(c)
            if d == len(convs[c]):
                node["ends"].append(c)
            else:
                node["kids"].add(tuple(convs[c][:d + 1]))

    def below(path):
        kids = [below(k) for k in nodes[path]["kids"]]
        own = (len(nodes[path]["members"]) - 1) * (len(path[-1][1].encode()) if path else 0)
        return sum(k[0] for k in kids) or 1, own + sum(k[1] for k in kids)

    out = []
    for path, node in nodes.items():
        leaves, saved = below(path)
        out.append((node["members"][0], len(path), nodes[path[:-1]]["members"][0] if path else None, len(node["members"]),
                    len(node["kids"]), leaves, saved, hashlib.sha256(",".join(map(str, node["ends"])).encode()).hexdigest()))
    return sorted(out, key=str)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def random_rows(seed, convs=60, words=3, most=6):
    r = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(r.randint(1, most)):
            out.append((c * 7 % 1000, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ccc é"][:words])))
    return out


@pytest.mark.parametrize("seed,rows,words", [(1, 1, 2), (2, 2, 3), (3, 3, 1), (4, 7, 2), (5, 1 << 16, 3)])
def test_against_nested_dictionaries(spark, seed, rows, words):
    data = random_rows(seed, words=words)
    found = prefix_trie.sequences(turns(spark, data))
    assert collected(prefix_trie.trie(found, block_rows=rows)) == brute(sequences(data))


def test_small_blocks_by_bytes(spark):
    data = random_rows(9, convs=90, most=3)
    found = prefix_trie.sequences(turns(spark, data))
    assert collected(prefix_trie.trie(found, block_bytes=1)) == brute(sequences(data))


def test_odd_rows(spark):
    data = [(1, None, None, None), (1, 0, "user", "a"), (2, 0, None, ""), (2, 0, "user", "a"), (None, 0, "user", "lost"),
            (3, 5, "user", "x" * 100_000), (4, 5, "user", "x" * 100_000), (4, 5, "user", "x" * 100_000), (-6, 1, "user", "日本")]
    assert collected(prefix_trie.prefix_trie(turns(spark, data))) == brute(sequences(data))
    assert prefix_trie.prefix_trie(turns(spark, []).where("false")).collect() == []


def test_role_and_text_are_told_apart(spark):
    data = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "1:", "a")]
    assert collected(prefix_trie.prefix_trie(turns(spark, data))) == brute(sequences(data))


def test_a_conversation_that_most_ids_repeat(spark):
    data = [(c, t, "user", f"t{t}") for c in range(0, 30_000, 2) for t in range(2)] + [(c, 0, "user", str(c % 7)) for c in range(1, 99, 2)]
    assert collected(prefix_trie.prefix_trie(turns(spark, data))) == brute(sequences(data))


def test_long_conversations(spark):
    data = [(c, t, "user", "ab"[t % 2] if t < 900 - 100 * c else f"{c}") for c in range(5) for t in range(1000)]
    found = prefix_trie.sequences(turns(spark, data))
    for rows in (2, 99):
        import sys
        sys.setrecursionlimit(5000)
        assert collected(prefix_trie.trie(found, block_rows=rows)) == brute(sequences(data))


def test_turnless_conversations_are_members_of_the_root(spark):
    frame = spark.createDataFrame([(1, []), (2, []), (3, ["0" * 48])], "conv_id long, turns array<string>")
    found = collected(prefix_trie.trie(frame))
    ends = hashlib.sha256(b"1,2").hexdigest()
    assert (1, 0, None, 3, 1, 1, 0, ends) in found and len(found) == 2
    alone = collected(prefix_trie.trie(frame.where("conv_id < 3")))
    assert alone == [(1, 0, None, 2, 0, 1, 0, ends)]


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def test_rebuilding(spark):
    data = [r for r in random_rows(11, convs=80, most=12) if r[0] % 35]
    found = prefix_trie.sequences(turns(spark, data))
    assert collected(prefix_trie.trie(rebuilt(found), block_rows=5)) == brute(rebuild(sequences(data)))


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in table(spark, SMOKE_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op12_prefix_trie(spark, SMOKE_DIR)) == brute(rebuild(sequences(rows)))


def test_range_minimum_searches():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 65):
        v = r.integers(0, 4, n)
        tab = prefix_trie.sparse_table(v)
        start, d = np.repeat(np.arange(n + 1), 5), np.tile(np.arange(5), n + 1)
        right = [next((p for p in range(s, n) if v[p] < x), n) for s, x in zip(start, d)]
        assert prefix_trie.first_below(tab, start, d).tolist() == right
        left = [next((p for p in range(s - 1, -1, -1) if v[p] < x), -1) for s, x in zip(start, d)]
        assert prefix_trie.last_below(tab, start - 1, d).tolist() == left
        lo, hi = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n + 1)))
        least = [v[a:b].min() if b > a else prefix_trie.NONE for a, b in zip(lo, hi)]
        assert prefix_trie.range_min(tab, lo, hi).tolist() == least
