"""Every operator on odd rows, empty tables and clashing extra columns."""

import pytest

import corpus_pipeline as P
from statlake.llm import bpe_trie, exact_dedup, jaccard_join, lang_gru, lm_trie, packing, pii, quality_rules
from tests.llm.conftest import ODD_ROWS, VOCABULARY, prose


def _lm(docs):
    return lm_trie.score(docs, lm_trie.train(docs, docs["doc_id"].isNotNull()))


def _lang(docs):
    return lang_gru.identify(docs, lang_gru.fit(docs, docs["doc_id"].isNotNull(), steps=5, batch=32))


def _quality(docs):
    labels = docs.sparkSession.createDataFrame([(4, 1), (5, None), (None, 0), (999, 1)], "doc_id long, quality int")
    return quality_rules.judge(docs, labels)


PER_ROW = {"lm": _lm, "quality": _quality, "jaccard": jaccard_join.jaccard_components, "lang": _lang,
           "pii": lambda d: pii.replace_pii(d, "k", counts=True),
           "bpe": lambda d: bpe_trie.encode_decode(d, VOCABULARY), "dedup": exact_dedup.exact_groups}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(frame, name):
    rows = PER_ROW[name](frame(ODD_ROWS)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD_ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(frame, name):
    assert PER_ROW[name](frame(ODD_ROWS).where("false")).collect() == []


def test_packing_of_odd_rows_and_of_nothing(frame):
    rows = packing.pack(frame(ODD_ROWS), VOCABULARY, capacity=512).collect()
    tokens = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == tokens.get(r.sequence_id, 0)
        tokens[r.sequence_id] = r.offset + r.length
    assert max(tokens.values()) <= 512
    assert sum(r.piece == 0 for r in rows) == len(ODD_ROWS)
    assert packing.pack(frame(ODD_ROWS).where("false"), VOCABULARY).collect() == []


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES[:-1]])
def test_pipeline_stage_keeps_the_columns(spark, frame, stage):
    docs = frame(ODD_ROWS)
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} <= {i for i, _ in ODD_ROWS}
    assert stage(spark, docs.where("false"), "").collect() == []


def test_pipeline_decisions(spark, frame, tmp_path):
    from tests.llm.conftest import prose

    near = prose(20, 200).split()
    near[100] = "changed"
    rows = [(1, prose(20, 200)), (2, " ".join(near)), (3, prose(21)), (4, prose(21)), (5, "12345 !!"),
            (6, prose(22) + " call +1 (752) 555-1655")]
    docs = frame(rows)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
    kept = {r.doc_id: r.text for r in docs.collect()}
    # 5 has no letter, 3 equals 4 (the larger id stays), 2 nearly equals 1 (the smaller id stays)
    assert set(kept) == {1, 4, 6}
    assert "555-1655" not in kept[6] and kept[6].startswith(prose(22))
    assert {r.doc_id for r in P.STAGES[-1][1](spark, docs, "").collect()} == {1, 4, 6}


def test_pipeline_against_stages_by_hand(spark):
    """run() is the stages in order; its pieces hold every kept document once."""
    out = P.run(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id for r in out}
    assert sum(r.piece == 0 for r in out) == len(docs)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_pipeline_verdicts_are_each_rows_own(spark, frame):
    """Of two rows with one id (or none) only the one that is rejected goes."""
    a, b = prose(40, 200), prose(41, 200)
    near = a.split()
    near[100] = "changed"
    docs = frame([(1, "!!! 123"), (1, a), (None, "??"), (None, b)])
    kept = dict(P.STAGES)["language identification"](spark, docs, "")
    assert sorted((r.text for r in kept.collect())) == sorted([a, b])
    docs = frame([(0, a), (1, " ".join(near)), (1, b), (None, " ".join(near)), (None, prose(42, 90)), (None, None), (7, None)])
    kept = dict(P.STAGES)["near duplicates"](spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect() if r.text) == [(0, a), (1, b)]
    assert sorted(str(r.text) for r in kept.where("doc_id IS NULL").collect()) == sorted(["None", prose(42, 90)])
    assert kept.where("doc_id = 7").count() == 1 and kept.columns == docs.columns
