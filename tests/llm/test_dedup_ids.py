"""Rows of one id with different texts are different documents."""

from collections import Counter

from statlake.llm import exact_dedup


def test_null_and_repeated_ids_with_different_texts(frame):
    rows = [(None, "a"), (None, "b"), (None, "B"), (None, "c"), (9, "C"), (5, "d"), (5, "e"), (7, "D"), (5, "E"),
            (6, None), (6, ""), (6, "f"), (8, "g"), (8, "g")]
    out = exact_dedup.deduplicate(frame(rows))
    kept = Counter((r.doc_id, (r.text or "").lower()) for r in out.collect())
    assert kept == Counter({(None, "a"): 1, (None, "b"): 1, (9, "c"): 1, (7, "d"): 1, (5, "e"): 1, (6, ""): 1, (6, "f"): 1,
                            (8, "g"): 1})
    assert out.columns == frame(rows).columns
