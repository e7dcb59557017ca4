"""Lists of a very frequent shingle are split by salt; links across the salts must stay."""

import pyarrow as pa

from statlake.llm import jaccard_join
from statlake.llm.text import shingles, words_of


def _class(text):
    return jaccard_join._signature(shingles(words_of(pa.array([text]), lower=True).hashes, 5))[0]


def test_links_across_the_salts_of_a_split_list(spark):
    run = [f"common{k}" for k in range(40)]
    filler = [(k, " ".join([*run, *(f"own{k}x{j}" for j in range(24))])) for k in range(jaccard_join.SALT_ROWS + 50)]
    # near-equal texts made of the run alone: no other set has a shingle of the run in its prefix
    views = [" ".join(run[a:b]) for a in range(3) for b in range(38, 41)]
    even = next(v for v in views if _class(v) % 2 == 0)
    odd = next(v for v in views if _class(v) % 2)
    docs = spark.createDataFrame([*filler, (100_001, even), (100_002, odd)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got[100_001] == got[100_002] == 100_001
    assert len(got) == len(filler) + 2
    assert all(got[k] == k for k, _ in filler)
