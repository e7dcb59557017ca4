import pytest

from statlake.llm.frames import ship

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Names that operators use inside, as extra columns of the input.
CLASHES = ["digest", "salt", "n", "class", "key", "kept", "keep_id", "group_n", "made", "row", "new", "tried", "stratum",
           "component_id", "sequence_id", "length", "rank", "bucket", "h", "__keep", "__kept", "part", "url_key"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """documents-like frame with clashing extra columns from (id, text, lang) rows."""
    def make(rows, lang="en"):
        rows = [(*r, lang)[:3] if len(r) == 2 else r for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASHES)
        return spark.createDataFrame(
            [(i, t, g, "s", len(t or ""), *["x"] * len(CLASHES)) for i, t, g in rows], schema)
    return make


def prose(seed, words=60):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(words))


#: null, empty, white space only, ties, repeated rows, one very long text, null id.
ODD_ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, prose(1)), (5, prose(1)), (5, prose(1)), (6, prose(1).upper()),
            (7, "Mail a.b@c.example.org"), (8, " ".join(prose(k, 500) for k in range(60))), (None, prose(2)),
            (None, None), (9, "z" * 5000), (10, "日本語 ΣΑΣ \x00\x85 <|endoftext|>")]
