"""Chat formatting, surrogates and archives."""

import base64
import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.llm import chat_format, pii, warc_index


def test_mixed_records_become_turns(spark):
    two = [("user", "q"), ("assistant", "a")]
    records = [({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", two),
               ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "speaker messages", two),
               ({"instruction": "q", "input": "", "output": "a"}, "instruction", two),
               ({"instruction": "q", "input": "r", "output": "a"}, "instruction", [("user", "q\n\nr"), two[1]]),
               ({"system": "s", "instruction": "q", "output": "a"}, "system instruction", [("system", "s"), *two]),
               ({"prompt": "q", "response": "a"}, "prompt", two),
               ({"prompt": "q", "completion": "a"}, "prompt completion", two),
               ({"data": {"prompt": {"text": "q"}, "reply": {"text": "a"}}}, "nested data", two), ({"other": 1}, None, None)]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, (r, _, _) in enumerate(records)] + [(99, None)], "id long, body string")
    got = {x.conv_id: x for x in chat_format.record_turns(df, "id", "body").collect()}
    for k, (_, layout, turns) in enumerate(records):
        assert got[k].layout == layout
        assert (got[k].turns and [tuple(t) for t in got[k].turns]) == turns
    assert got[99].layout is None


def test_records_with_missing_null_and_empty_fields(spark):
    two = [("user", "q"), ("assistant", "a")]
    records = [({"instruction": "q", "output": "a"}, "instruction", two),
               ({"instruction": "q", "input": None, "output": "a"}, "instruction", two),
               ({"instruction": None, "output": "a"}, "instruction", [("user", ""), two[1]]),
               ({"messages": []}, "messages", []), ({"conversations": []}, "speaker messages", []),
               ({"messages": [{"role": "system"}, {"role": "user", "content": "q"}]}, "messages", [("system", ""), two[0]]),
               ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
               ({"prompt": "q", "response": None}, "prompt", [two[0], ("assistant", "")]),
               ({"data": {"prompt": {"text": None}, "reply": {"text": "a"}}}, "nested data", [("user", ""), two[1]]),
               ({"messages": None}, None, None), ({"messages": "text"}, None, None), ({"prompt": "q"}, None, None),
               ({"instruction": "q", "output": "a", "prompt": "x"}, None, None), ([1, 2], None, None)]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, (r, _, _) in enumerate(records)] + [(99, "no json")], "id long, body string")
    got = {x.conv_id: x for x in chat_format.record_turns(df, "id", "body").collect()}
    for k, (_, layout, turns) in enumerate(records):
        found = got[k].turns
        assert (got[k].layout, found if found is None else [tuple(t) for t in found]) == (layout, turns), records[k]
    assert got[99].layout is None


def test_typed_frames_by_fingerprint(spark):
    df = spark.createDataFrame([(1, [("user", "q"), ("assistant", None)], "x")],
                               "id long, messages array<struct<role:string,content:string>>, turns string")
    assert chat_format.layout_of(df.schema).name == "messages"
    assert [tuple(t) for t in chat_format.canonical_turns(df, "id").first().turns] == [("user", "q"), ("assistant", "")]
    with pytest.raises(ValueError, match="no layout"):
        chat_format.layout_of(spark.range(1).schema)


def test_round_trip_of_hostile_texts(spark):
    texts = ["\\### Assistant: </turn> ok", "</turn>\n<turn>user\n", "\\l \\\\l <", "\\", "", None, "\x00b\x00z", "é日\n\n", "<turn>"]
    rows = [(1, k, ("assistant" if k % 2 else "us<er\n\\n"), t) for k, t in enumerate(texts)]
    rows += [(2, 0, None, "t"), (2, 0, "assistant", "t"), (2, 0, "assistant", "t"), (None, 1, "assistant", "n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    turns = chat_format.canonical_turns(df)
    back = {x.conv_id: x for x in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    want = {x.conv_id: x.turns for x in turns.collect()}
    assert len(back) == 3
    for k, x in back.items():
        assert x.turns == want[k]
        assert x.loss_text == "".join(t.text for t in want[k] if t.role == "assistant")
    assert chat_format.canonical_turns(df.where("false")).collect() == []


PII_TEXT = ("Mail Ann.Bee@Mail3.example.com, ann.bee@mail3.example.com; call +1 (752) 555-1655. At 10.20.3.104. Card "
            "4465 7583 8288 9437 or 4465758382889437. token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" "
            "Mr. John Smith, Mrs. Anna Smith and Dr Smith, г-н Иван Петров. DE89 3704 0044 0532 0130 00, 078-05-1120. 1.2.3")


def _luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_surrogates_keep_type_format_and_identity(frame):
    import re

    rows = [(1, PII_TEXT), (2, "call +1 (752) 555-1655 again"), (3, "Version 3.14159 of 2024-10-01, 12345 items")]
    got = {x.doc_id: x for x in pii.replace_pii(frame(rows), "k", counts=True).collect()}
    text = got[1].text
    for part in ("Bee", "555-1655", "10.20.3.104", "4465 7583", "4465758382889437", "24be64", "Smith", "Петров", "3704 0044", "078-05"):
        assert part not in text
    mail = re.findall(r"\S+@\S+\.com", text)
    assert len(mail) == 2 and mail[0].lower() == mail[1].lower()
    phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", text)[0]
    assert phone in got[2].text
    assert re.search(r"At [1-9]\d\.[1-9]\d\.\d\.\d{3}\. ", text)
    spaced, plain = re.search(r"Card (4\d{3} \d{4} \d{4} \d{4}) or (4\d{15})\.", text).groups()
    assert spaced.replace(" ", "") == plain and _luhn(plain)
    man, woman, doctor = re.search(r"Mr\. (\w+ \w+), Mrs\. (\w+ \w+) and Dr (\w+),", text).groups()
    assert man.split()[1] == woman.split()[1] == doctor and man.split()[0] != woman.split()[0]
    assert woman.split()[0].endswith("a") and re.search(r"г-н [А-Я][а-я]+ [А-Я][а-я]+\.", text)
    assert re.search(r"DE\d\d( \d{4}){4} \d\d, \d{3}-\d\d-\d{4}\. 1\.2\.3$", text)
    assert got[3].text == rows[2][1] and got[3].n_entities == 0
    again = {x.doc_id: x.text for x in pii.replace_pii(frame(rows), "k").collect()}
    other = {x.doc_id: x.text for x in pii.replace_pii(frame(rows), "k2").collect()}
    assert again[1] == text and other[1] != text


def test_surrogates_stay_distinct_where_the_space_is_small(frame):
    """All 81 addresses 1-9.1-9.0.0 share a space of few shapes: collisions must be drawn again."""
    ips = [f"{a}.{b}.1.1" for a in range(1, 10) for b in range(1, 10)]
    rows = [(k, f"{ip} and {ip} and {ips[0]}") for k, ip in enumerate(ips)] + [(500 + k, f"x {c}@d.co") for k, c in enumerate("abcdefghijklm")]
    got = {x.doc_id: x.text for x in pii.replace_pii(frame(rows), "k").collect()}
    new = [got[k].split(" and ") for k in range(81)]
    assert all(x[0] == x[1] for x in new) and len({x[2] for x in new}) == 1
    assert len({x[0] for x in new}) == 81 and not {x[0] for x in new} & set(ips)
    assert len({got[500 + k] for k in range(13)}) == 13


def test_pii_passes_other_columns_through(frame):
    docs = frame([(1, "a@b.org"), (None, "a@b.org"), (1, "a@b.org"), (2, None), (3, "")])
    out = pii.replace_pii(docs, "k")
    assert out.columns == docs.columns and out.drop("text").collect() == docs.drop("text").collect()
    texts = [r.text for r in out.orderBy("doc_id").collect()]
    assert texts.count(None) == 1 and texts.count("") == 1 and len(set(texts)) == 3


PAGES = [(1, "http://Blog.Example.com:80/a?x=1#f", "<p>é</p>"), (2, "https://example.com/", "<p>é</p>"), (3, None, None),
         (4, "http://[bad", ""), (5, "http://example.com/a", "x" * 100_000), (6, "http://example.com/a", "WARC/1.1\r\n\r\n"),
         (7, "http://example.com/a", "x" * 100_000), (7, "http://example.com/a", "x" * 100_000), (None, "http://n.org", "<p>é</p>")]


@pytest.mark.parametrize("block,least", [(2, 0), (512, 10)])
def test_archives_round_trip(spark, monkeypatch, tmp_path, block, least):
    monkeypatch.setattr(warc_index, "BLOCK", block)
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string")
    folder = str(tmp_path / "warc")
    captures = warc_index.write_archives(df, folder, least)
    index = warc_index.write_index(captures, folder)
    got = warc_index.read_records(warc_index.locate(captures, index, folder), folder, with_payload=True).collect()
    assert len(got) == len(PAGES)
    by_id = {p[0]: p for p in PAGES}
    for r in got:
        payload = (by_id[r.page_id][2] or "").encode()
        same = [p for p, _, h in PAGES if p is not None and (h or "").encode() == payload]
        first = min(same)
        revisit = r.page_id is not None and r.page_id != first and len(payload) >= least
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert r.payload == (b"" if revisit else payload)
    # point lookups: present, absent
    wanted = spark.createDataFrame([("com,example)/a", 5), ("com,example)/a", 99), ("zzz", 1), ("", 3)], "key string, page_id long")
    assert sorted((x.key, x.page_id) for x in warc_index.locate(wanted, index, folder).collect()) == [("", 3), ("com,example)/a", 5)]


def test_one_page_id_with_several_payloads(spark):
    """Every payload is in the archives once, and every row has one record."""
    pages = [(1, "A"), (2, "A"), (2, "BBB"), (3, "A"), (3, "BBB"), (2, "BBB"), (4, "C")]
    df = spark.createDataFrame([(i, f"http://x.org/{k}", h) for k, (i, h) in enumerate(pages)], "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc_index.archive_and_read(df).collect())
    first = {h: min(i for i, x in pages if x == h) for _, h in pages}
    want = sorted((i, len(h), *(("response", None) if i == first[h] else ("revisit", first[h]))) for i, h in pages)
    assert got == want


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_index.archive_and_read(df).collect() == []


@pytest.mark.parametrize("url,key", [("http://Blog.Example.com:80/a?x=1#f", "com,example,blog)/a?x=1"), ("https://a.b:8080", "b,a:8080)/"),
                                     (None, ""), ("http://[bad", "http://[bad")])
def test_reversed_host_keys(url, key):
    assert warc_index.surt(url) == key


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200), st.none() | st.integers(0, 9), st.text(max_size=20))
def test_records_parse(payload, refers_to, url):
    fields, block = warc_index.parse(warc_index.record(3, url, payload, "D", refers_to))
    assert block == (payload if refers_to is None else b"") and fields["X-Payload-Length"] == str(len(payload))
