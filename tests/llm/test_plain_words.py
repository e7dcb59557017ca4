"""Words cut by bytes are those of the splitting rule, and their ids the library's."""

import random

import numpy as np
import public_tokenizers
import pytest

from statlake.llm import chunks

SPEC = public_tokenizers.path("word_bpe_49k.json")


def test_plain_words_are_those_of_the_rule():
    rng = random.Random(5)
    texts = ["", " ", "'", "'s", "''s", "it's we'll 're'sa 'l l'"]
    texts += ["".join(rng.choices("''''strevelmd lld aZ19.!\n\té\xdfŸŁ\x00\x1c", k=rng.randrange(40))) for _ in range(3000)]
    texts = [t.lower() for t in texts]
    words, edge = chunks.plain_words(texts)
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(edge, edge[1:])] == [chunks._WORDS.findall(t) for t in texts]


def test_a_distinct_word_is_looked_up_once_per_slice():
    encoder = chunks.library_encoder(open(SPEC, encoding="utf-8").read())
    split = []
    encoder.splitter.words = lambda t: split.append(t) or []
    want = [np.asarray(encoder.splitter.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in ("Plain words, it's plain. Él 12", "", "words\x0bwords")]
    assert encoder.ids(["Plain words, it's plain. Él 12", "", "words\x0bwords"]) == want
    assert not split         # plain texts do not pass through the rule one by one


@pytest.mark.parametrize("text", ["a<|endoftext|>B", "中文 x", "ΑΣ İ", "a\x85b c", "<| it's"])
def test_mixed_slices_give_the_librarys_ids(text):
    encoder = chunks.library_encoder(open(SPEC, encoding="utf-8").read())
    texts = ["Plain é's 12", text, "", text + " 's"]
    assert encoder.ids(texts) == [np.asarray(encoder.splitter.library.encode(t, add_special_tokens=False).ids, "<u4")
                                  .tobytes() for t in texts]
