"""A network that does not forget within the bytes that warm a span up, and what
a worker keeps of the operator before."""

import numpy as np
import pytest

from statlake.llm import held as h
from statlake.llm import lang_gru


def slow_model() -> lang_gru.Model:
    """``#`` sets the state, which fades slowly."""
    embed = np.zeros((256, 3), np.float32)
    embed[:, 0] = 7.0                         # update gate near one: the state stays
    embed[ord("#")] = (-7.0, 0.0, 5.0)
    gru = lang_gru.Gru(embed, np.zeros((1, 3), np.float32))
    return lang_gru.Model(["a", "b"], gru, gru, np.array([[4, -4], [4, -4], [-3, 3]], np.float32))


@pytest.mark.parametrize("lanes", [1, 2, 64])
def test_states_are_handed_over_from_span_to_span(monkeypatch, lanes):
    monkeypatch.setattr(lang_gru, "SPAN", 64)
    monkeypatch.setattr(lang_gru, "WARM", 8)
    monkeypatch.setattr(lang_gru, "LANES", lanes)
    model = slow_model()
    docs = [b"#" + b"x" * 700, b"x" * 300, b"x" * 400 + b"#" + b"x" * 90, b"x", b"y" * 64, b"#" * 65]
    plain = np.array([model.positions(np.frombuffer(d, np.uint8)[:, None])[0].sum((0, 1)) for d in docs])
    size = np.array([[len(d)] for d in docs])
    assert np.abs(model.pooled(docs) / size - plain / size).max() < 2e-3


def test_language_tasks_drop_the_tables_of_other_operators(spark):
    h.held("words of another operator", lambda: bytearray(1 << 20))
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    sent = lang_gru._sent(docs, slow_model())
    assert sent().langs == ["a", "b"] and sent() is sent()
    assert h._HELD["owner"][0] == "gru"
