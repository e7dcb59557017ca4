"""Circulant MinHash against all pairs of exact sets."""

import random

import numpy as np
import pytest

from statlake.llm import circulant_minhash as C
from statlake.llm.frames import table
from statlake.llm.queries import op13_circulant_minhash
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import ODD_ROWS, prose


def shingle_set(text, size=5):
    words = (text or "").translate({k: k + 32 for k in range(65, 91)}).encode().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k:k + size]) for k in range(len(words) - size + 1))


def brute(rows):
    """(doc_id, n, component, kept) by all pairs of different sets."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    where = {}
    for s in distinct:
        for x in s:
            where.setdefault(x, []).append(s)
    for s in distinct:
        meets = {}
        for x in s:
            for o in where[x]:
                meets[id(o)] = (o, meets.get(id(o), (o, 0))[1] + 1)
        for o, both in meets.values():
            if o is not s and C.links(both, len(s), len(o)):
                root[find(s)] = find(o)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    out = []
    for (i, _), s in zip(rows, sets):
        c = least.get(find(s)) if s else i
        out.append((i, len(s), c, c == i))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in C.near_duplicates(frame).collect()), key=str)


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"edit{r.randrange(10 ** 6)}"
    return " ".join(words)


def corpus(seed, bases=12, copies=14):
    """Groups of copies around the threshold, chains of them, and short texts."""
    r = random.Random(seed)
    rows = []
    for b in range(bases):
        words = prose(seed * 100 + b, r.choice([6, 11, 30, 80, 300])).split()
        for k in range(copies):
            if r.random() < 0.3:
                words = edited(r, words, 1).split()      # the chain moves on
            rows.append((len(rows) * 3 + 1, edited(r, words, r.choice([0, 0, 1, 1, 2, 3, len(words) // 60]))))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_against_all_pairs(frame, seed):
    rows = corpus(seed)
    assert found(frame(rows)) == brute(rows)


def test_small_blocks_give_the_same(frame, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    rows = corpus(4)
    assert found(frame(rows)) == brute(rows)


def test_a_template_whose_copies_link_with_few(frame):
    """Many texts around one template: near the threshold with it, below it with each other."""
    r = random.Random(8)
    words = prose(77, 120).split()
    rows = [(k, edited(r, words, r.choice([1, 2, 3]))) for k in range(400)]
    assert found(frame(rows)) == brute(rows)


def test_odd_rows(frame):
    assert found(frame(ODD_ROWS)) == brute(ODD_ROWS)
    assert C.near_duplicates(frame(ODD_ROWS).where("false")).collect() == []


def test_null_ids_carry_links(frame):
    """Two documents linked only through one without an id are one component."""
    words = [f"w{k}" for k in range(104)]
    a = " ".join(words)
    b = " ".join([*words[:50], "m", *words[51:]])
    c = " ".join([*words[:50], "m", *words[51:98], "n", *words[99:]])
    rows = [(5, a), (None, b), (9, c), (None, None)]
    assert not C.links(len(shingle_set(a) & shingle_set(c)), 100, 100)
    assert found(frame(rows)) == brute(rows)


def test_large_sets_use_the_larger_circle(frame, monkeypatch):
    monkeypatch.setattr(C, "CIRCLE_MOST", 60)
    rows = corpus(6)
    assert found(frame(rows)) == brute(rows)
    sizes = [40, 50, 51, 60, 70, 71, 90]
    r = np.random.default_rng(1)
    assert [len(C.band_keys(np.unique(r.integers(0, 2 ** 63, n, dtype=np.uint64)))) // C.BANDS for n in sizes] == [1, 1, 2, 2, 2, 1, 1]


def test_signature_is_the_turned_minimum():
    circle = C.Circle(17, bits=8)
    values = np.random.default_rng(2).integers(0, 2 ** 63, 40, dtype=np.uint64)
    at = circle.first[(values % np.uint64(256)).astype(int)]
    assert sorted(circle.first) == sorted(circle.second) == list(range(256))
    assert circle.signature(values).tolist() == [min(int(circle.second[(x + k) % 256]) for x in at) for k in range(17)]


def test_agreement_estimates_similarity():
    r = np.random.default_rng(3)
    circle = C.Circle(2000)
    a = r.integers(0, 2 ** 63, 500, dtype=np.uint64)
    for share in (0.5, 0.85):
        b = a.copy()
        new = int(500 * (1 - share) / (1 + share))
        b[:new] = r.integers(0, 2 ** 63, new, dtype=np.uint64)
        true = (500 - new) / (500 + new)
        assert abs((circle.signature(a) == circle.signature(b)).mean() - true) < 0.05


def test_query_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMOKE_DIR, "documents").collect()]
    assert sorted((tuple(r) for r in op13_circulant_minhash(spark, SMOKE_DIR).collect()), key=str) == brute(rows)
