"""Exact and near duplicates against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statlake.llm import exact_dedup, jaccard_join
from statlake.llm.components import components
from tests.llm.conftest import prose


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_groups(frame, digest):
    """Also with a digest of one hex digit, where different texts collide."""
    r = random.Random(3)
    texts = ["", None, "Ä", "ä", "A b", "a B", *[f"text {k}" for k in range(20)]]
    rows = [(k, r.choice(texts)) for k in range(150)] + [(1000 + k, "HOT copy") for k in range(75)]
    want = defaultdict(list)
    for i, t in rows:
        want[_lower(t)].append(i)
    got = exact_dedup.exact_groups(frame(rows), salts=4, digest=digest).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for x in got:
        group = want[_lower(by_id[x.doc_id])]
        assert (x.keep_id, x.group_size, x.kept) == (max(group), len(group), x.doc_id == max(group))
    kept = exact_dedup.deduplicate(frame(rows)).select("doc_id").collect()
    assert sorted(x.doc_id for x in kept) == sorted(max(g) for g in want.values())


def test_deduplicate_collapses_repeated_rows(frame):
    kept = exact_dedup.deduplicate(frame([(1, "a"), (2, "A"), (2, "A"), (None, "b"), (None, "b")])).collect()
    assert sorted(str(x.doc_id) for x in kept) == ["2", "None"]


def test_groups_meet_in_salted_tasks_first(frame):
    plan = exact_dedup.exact_groups(frame([(1, "a"), (2, "a")]), salts=4)
    assert plan.count() == 2


def _shingles(t):
    w = (t or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[k:] for k in range(5)]))


def _brute(rows):
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def _edited(base, r, edits):
    w = base.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def _corpus(seed):
    r = random.Random(seed)
    rows = []
    common = prose(99, 30)
    for k in range(12):
        base = prose(1000 * seed + k, r.choice([3, 4, 5, 6, 7, 8, 9, 10, 12, 16, 25, 40, 120]))
        rows += [_edited(base, r, r.randrange(4)) for _ in range(r.randrange(1, 5))]
        rows += [base + " tail", "head " + base, common + " " + base]
    hot = prose(7, 150)   # a large group of near copies with similarities around the threshold
    rows += [_edited(hot, r, r.randrange(9)) for _ in range(60)]
    return list(enumerate(rows)) + [(900, None), (901, ""), (902, "one"), (903, "ONE")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_links(frame, seed):
    rows = _corpus(seed)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(frame(rows)).collect()}
    assert got == _brute(rows)


def test_light_sets_blocks_salts_and_frequency_order(frame, monkeypatch):
    """The same components with the light side forced, lists split and all shingles frequent."""
    rows = _corpus(3)
    want = _brute(rows)
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda sizes, repeats: 20)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "SALT_ROWS", 5)
    monkeypatch.setattr(jaccard_join, "HEAVY_LEAST", 3)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(frame(rows)).collect()}
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1))
def test_sketches_never_lose_a_link(a, b):
    x, y = (np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in (a, b))
    if 7 * len(a & b) >= 3 * (len(a) + len(b)):
        assert jaccard_join.may_link(jaccard_join.sketch(x), jaccard_join.sketch(y), len(a), len(b))
        small = [jaccard_join.fold(jaccard_join.sketch(v), 4) for v in (x, y)]
        assert jaccard_join.may_link(*small, len(a), len(b))


def test_boundary_follows_the_costs():
    sizes = {4: 100, 10: 100, 1000: 100}
    assert jaccard_join.choose_boundary({}, 0) == 0
    assert jaccard_join.choose_boundary(sizes, 0.0) <= jaccard_join.choose_boundary(sizes, 5.0) < 1000


def test_components_of_chains_and_stars(spark):
    r = random.Random(5)
    chain = [(k, k + 1) for k in range(100, 130)]
    star = [(1, k) for k in range(50, 70)]
    edges = chain + star + [(200, 201), (201, 200), (300, 300)]
    r.shuffle(edges)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 100 for k in range(101, 131)} | {k: 1 for k in range(50, 70)} | {201: 200}
    assert got == want
