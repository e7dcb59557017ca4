"""BPE by trie and packing, against the tokenizers library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statlake.llm import bpe_trie, packing
from statlake.llm.chunks import TextEncoder, library_encoder
from tests.llm.conftest import ODD_ROWS, VOCABULARY

SPEC = open(VOCABULARY, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(VOCABULARY)
TRIE = bpe_trie.TrieBpe(SPEC)
ENCODERS = [TextEncoder(TRIE.splitter, TRIE.encode), library_encoder(SPEC), TextEncoder(TRIE.splitter, TRIE.encode, 5)]


def _ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text("aAbeéÉ'sStTlLrRe 13٣<|>dofxnt\n\t\x85\xa0́ΣςİŸß日", max_size=60)
       | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "don't", "I'LL", " ", "naïve", "the"])).map("".join))
def test_same_ids_as_the_library(text):
    for encoder in ENCODERS:
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == _ids(text)


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_decoding_is_the_librarys(text):
    ids = _ids(text)
    assert TRIE.decode(np.array(ids, "<u4")).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_tables_emptied_in_between_change_nothing():
    texts = [" ".join(random.Random(k).choices(["low", "lower", "lowest", "new", "newer"], k=9)) for k in range(30)]
    want = [np.asarray(_ids(t), "<u4").tobytes() for t in texts]
    small = TextEncoder(TRIE.splitter, TRIE.encode, 4)
    assert [small.ids([t])[0] for t in texts] == want


def test_query_columns(frame):
    rows = [r for r in ODD_ROWS if r[0] is not None and r[0] != 5]
    got = {x.doc_id: x for x in bpe_trie.encode_decode(frame(rows), VOCABULARY, with_values=True).collect()}
    for i, text in rows:
        ids = _ids(text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids, got[i].decoded) == (len(ids), ids, decoded)
        assert got[i].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_pieces(frame):
    rows = [r for r in ODD_ROWS if r[0] is not None and r[0] != 5]
    got = packing.pieces(frame(rows), VOCABULARY, capacity=100).collect()
    for i, text in rows:
        ids = [*_ids(text or ""), 1]
        want = [(k, at, len(ids[at:at + 100]), zlib.crc32(np.asarray(ids[at:at + 100], "<u4").tobytes()))
                for k, at in enumerate(range(0, len(ids), 100))]
        assert sorted((x.piece, x.start, x.length, x.ids_crc32) for x in got if x.doc_id == i) == want


@settings(max_examples=150, deadline=None)
@given(st.integers(4, 60), st.randoms(use_true_random=False), st.integers(0, 200))
def test_plan_places_every_piece_once(capacity, r, n):
    lengths = [r.randint(1, capacity) for _ in range(n)]
    counts = np.bincount(lengths, minlength=capacity + 1) if n else np.zeros(capacity + 1, np.int64)
    plan = packing.plan_lengths(counts, capacity)
    filled = {}
    dealt = np.zeros(capacity + 1, np.int64)
    for length, rank, sequence, repeat, offset in zip(plan.length, plan.rank, plan.sequence, plan.repeat, plan.offset):
        assert rank == dealt[length]
        dealt[length] += repeat
        for s in range(sequence, sequence + repeat):
            filled.setdefault(s, []).append((offset, length))
    assert (dealt == counts).all() and len(filled) == plan.sequences
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    first_fit = []
    for x in sorted(lengths, reverse=True):
        k = next((k for k, free in enumerate(first_fit) if free >= x), None)
        if k is None:
            first_fit.append(capacity - x)
        else:
            first_fit[k] -= x
    assert plan.sequences <= len(first_fit) + 1


@pytest.mark.parametrize("counts,sequences", [({10: 3}, 3), ({4: 5, 6: 5}, 5), ({2: 6, 3: 6, 5: 6}, 6), ({7: 2, 1: 6}, 2)])
def test_exact_complements(counts, sequences):
    c = np.zeros(11, np.int64)
    for k, v in counts.items():
        c[k] = v
    assert packing.plan_lengths(c, 10).sequences == sequences
