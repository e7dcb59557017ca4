"""Language model, language identification and quality rules."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.llm import lang_gru, lm_trie, quality_rules
from statlake.llm.elias_fano import EliasFano
from tests.llm.conftest import ODD_ROWS, prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300)), st.lists(st.integers(0, 2**64 - 1)))
def test_elias_fano(values, more):
    v = np.array(sorted(values), np.uint64)
    e = EliasFano.build(v)
    assert (e.get(np.arange(len(v))) == v).all()
    q = np.array([*values, *more, 0, 2**64 - 1], np.uint64)
    assert (e.successor(q) == np.searchsorted(v, q)).all()
    place, hit = e.index(q)
    assert (place == np.searchsorted(v, q)).all() and (hit == np.isin(q, v)).all()
    if len(v) > 1:
        at = np.arange(len(v) - 1)
        assert all((got == want).all() for got, want in zip(e.pair(at), (v[:-1], v[1:])))


@pytest.mark.parametrize("values", [[0] * 200, [5] * 64 + [2**40] * 63 + [2**63] * 130, list(range(0, 9000, 90)), [7] * 65 + [8]])
def test_elias_fano_with_long_runs_and_gaps(values):
    v = np.array(values, np.uint64)
    e = EliasFano.build(v)
    q = np.unique(np.concatenate([v, v + np.uint64(1), np.maximum(v, np.uint64(1)) - np.uint64(1)]))
    place, hit = e.index(q)
    assert (place == np.searchsorted(v, q)).all() and (hit == np.isin(q, v)).all()
    assert all((got == want).all() for got, want in zip(e.pair(np.arange(len(v) - 1)), (v[:-1], v[1:])))


def _plain_model(texts, order):
    """score(tokens) of the same model from dictionaries, without quantisation."""
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        for k in range(1, order + 1):
            grams[k].update(tuple(t[i:i + k]) for i in range(len(t) - k + 1))
    n, v = sum(grams[1].values()), len(grams[1])
    kept = [set(), set(grams[1])] + [set() for _ in range(order - 1)]
    discount, mass = [0, 0], [None, None]
    for k in range(2, order + 1):
        # a k-gram is counted where both of its (k-1)-grams are in the model
        own = {g: c for g, c in grams[k].items() if g[1:] in kept[k - 1] and g[:-1] in kept[k - 1]}
        n1, n2 = (sum(c == x for c in own.values()) for x in (1, 2))
        discount.append(min(0.95, n1 / (n1 + 2 * n2)) if n1 and n2 else 0.5)
        kept[k] = {g for g, c in own.items() if c >= 2}
        mass.append(defaultdict(float))
        for g in kept[k]:
            mass[k][g[:-1]] += own[g] - discount[k]

    def p(g):
        k = len(g)
        if k == 1:
            return (grams[1][g] + 0.1) / (n + 0.1 * (v + 1))
        u = g[:-1]
        if u not in kept[k - 1]:
            return p(g[1:])
        back = min(1, max(1e-9, 1 - mass[k][u] / grams[k - 1][u]))
        return (grams[k][g] - discount[k] if g in kept[k] else 0) / grams[k - 1][u] + back * p(g[1:])

    return lambda t: sum(math.log10(p(tuple(t[max(0, i - order + 1):i + 1]))) for i in range(len(t))), n, grams[1]


@pytest.mark.parametrize("order,parts", [(1, 1), (2, 1), (2, 5), (3, 1), (3, 4)])
def test_trie_scores_are_the_models(frame, monkeypatch, order, parts):
    r = random.Random(4)
    vocabulary = prose(5, 40).split()
    rows = [(k, " ".join(r.choices(vocabulary, weights=[9 ** (j < 3) for j in range(40)], k=60))) for k in range(60)]
    rows += [(1000 + k, t) for k, t in enumerate([None, "", "unseen Words here", "the"])]
    docs = frame(rows)
    if parts > 1:   # several key ranges, with hot contexts split
        monkeypatch.setattr(lm_trie, "RANGE_TOKENS", sum(len(t or "") for _, t in rows) // (6 * parts))
    model = lm_trie.train(docs, docs["doc_id"] % 4 != 0, order=order)
    tokens = {i: [*(t or "").lower().split(), "</s>"] for i, t in rows}
    want, n, c = _plain_model([t for i, t in tokens.items() if i % 4], order)
    got = {x.doc_id: x for x in lm_trie.score(docs, model).collect()}
    for i, t in tokens.items():
        assert got[i].n_tokens == len(t) and got[i].train_tokens == n
        assert got[i].n_known == sum(c[w,] > 0 for w in t)
        assert got[i].score == pytest.approx(want(t), abs=0.05 * len(t))
        base = sum(math.log10((c[w,] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in t)
        assert got[i].base_score == pytest.approx(base, abs=1e-9)


def test_higher_levels_help_on_unseen_rows(spark):
    import __spark_entry__ as E

    rows = [r for r in E.queries()["op1_lm_trie"](spark, "/root/testdata/sf0.001").collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_gradients_of_the_recurrent_network():
    rng = np.random.default_rng(1)
    gru = lang_gru.Gru(rng.normal(size=(256, 9)).astype(np.float64), rng.normal(size=(3, 9)).astype(np.float64))
    x = rng.integers(0, 4, (5, 6))
    weight = rng.normal(size=(5, 6, 3))

    def loss():
        return sum((w * s[4]).sum() for w, s in zip(weight, gru.forward(x)))

    g_embed, g_state = gru.backward(x, gru.forward(x), list(weight))
    for param, grad in ((gru.embed, g_embed), (gru.state, g_state)):
        for at in [(0, 0), (1, 4), (2, 8), (2, 2)]:
            old = param[at]
            param[at] = old + 1e-3
            up = loss()
            param[at] = old - 1e-3
            down = loss()
            param[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-3)


def test_language_held_out_accuracy(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = E.queries()["op5_lang_gru"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_every_byte_of_whole_texts_is_labelled(monkeypatch):
    """Pooled probabilities are those of one run over the whole text, byte by byte."""
    rng = np.random.default_rng(3)
    texts = {"a": "plain words of one kind ", "b": "andere Wörter, viele davon 12 "}
    samples = [(lang, w) for lang, t in texts.items() for w in lang_gru.windows(lang_gru.raw(t * 40), 30)]
    model = lang_gru.train(samples, steps=60, batch=64)
    docs = [lang_gru.raw("".join(rng.choice(list(texts.values()), n))) for n in (1, 2, 30, 200)] + [b"x", b"y" * 449, b"z" * 896]
    plain = np.array([model.positions(np.frombuffer(d, np.uint8)[:, None])[0].sum((0, 1)) for d in docs])
    for lanes in (2, 4096):
        monkeypatch.setattr(lang_gru, "LANES", lanes)
        got = model.pooled(docs)
        size = np.array([[len(d)] for d in docs])
        assert np.allclose(got.sum(1, keepdims=True), size, rtol=1e-4)         # a label for every byte
        assert np.abs(got / size - plain / size).max() < 2e-3


def test_undetermined_texts(frame):
    rows = [(1, None), (2, "12 !?"), (3, "abc def"), (4, None)]
    docs = frame(rows)
    got = {r.doc_id: r.lang_pred for r in lang_gru.identify(docs, lang_gru.fit(docs, docs["doc_id"] > 0, steps=3, batch=8)).collect()}
    assert got == {1: "und", 2: "und", 3: "en", 4: "und"}
    assert {r.lang_pred for r in lang_gru.identify(docs, None).collect()} == {"und"}


def _counts(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0D]+", text) if x]
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    times = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if times[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(covered)


def test_quality_counts(frame):
    again = prose(30, 12)
    rows = [r for r in ODD_ROWS if r[0] is not None and r[0] != 5]
    rows += [(50, f"{again} x {again}\n{again} x\n\n{again} x\n \n # é&é"), (51, "a " * 40), (52, "b\nb\nb\n\n\n")]
    got = {r.doc_id: r for r in quality_rules.features(frame(rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _counts(t), i


@pytest.mark.parametrize("k,n", [(0, 50), (3, 100), (10, 2000), (99, 100), (100, 100)])
def test_clopper_pearson(k, n):
    u = quality_rules.upper_bound(k, n, 0.01)
    if k == n:
        assert u == 1
        return
    tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
                        + j * math.log(u) + (n - j) * math.log1p(-u)) for j in range(k + 1))
    assert tail == pytest.approx(0.01, rel=1e-6)


def test_thresholds_keep_the_risk(frame, spark):
    """Certified cutoffs on a large labelled sample; none where a stratum has too few labels."""
    r = random.Random(8)
    rows, labels = [], []
    for i in range(3000):
        lang = "en" if i < 2900 else "de"
        bad = r.random() < 0.3
        w = prose(i, 25).split()
        rows.append((i, " ".join(x + "###" if bad and r.random() < 0.8 else x for x in w), lang))
        labels.append((i, int(not bad)))
    labels.append((0, None))
    docs, marks = frame(rows), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {x.doc_id: x for x in quality_rules.judge(docs, marks).collect()}
    en_bad = [i for i, q in labels if q == 0 and i < 2900]
    assert sum(not got[i].kept for i in en_bad) > 0.95 * len(en_bad)
    assert all(got[i].kept for i, q in labels if q == 1)
    assert all(got[i].kept for i in range(2900, 3000))


def test_choose_is_fixed_sequence_with_correction():
    cells = quality_rules.GRID + 1
    good, bad = np.zeros(cells, int), np.zeros(cells, int)
    good[0], good[4], bad[10], bad[4] = 10_000, 2_000, 500, 500
    hist = {(True, "s", "r", 1): good, (False, "s", "r", 1): good, (False, "s", "r", 0): bad}
    assert quality_rules.choose(hist, ["s"], ["r"], 0.05, 0.05, 0.9) == {("s", "r"): 10}
    few = {(True, "s", "r", 1): good // 1000, (False, "s", "r", 0): bad}
    assert quality_rules.choose(few, ["s"], ["r"], 0.05, 0.05, 0.9) == {}
