"""Encoding whole texts word by word.

The vocabulary's splitting rule cuts a text into words, which are encoded one
by one.  Neither the normaliser nor the rule looks past ASCII white space, so
a text may be cut there first.  Texts of ASCII and Latin letters are cut into
words by their bytes, all texts of a slice at once: each distinct word is looked
up once, and the ids of its occurrences are gathered.  Each Python worker keeps the ids of the words it has met (``held``); the table
is emptied when it has ``TABLE_BYTES``, which bounds memory and changes no result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from statlake.llm.held import entry_bytes, held

TABLE_BYTES = 160 << 20
CACHE_CHARS = 32      # longer words are not kept

#: Letters whose normal form is themselves and whose lower case is one letter of this range.
LATIN = "\u00df-\u00f6\u00f8-\u012f\u0131-\u017f"
_PLAIN = re.compile(f"[\x00-\x7f\u00c0-\u00d6\u00d8-\u00de{LATIN}]*")
#: Classes of the bytes of such a text: every byte of a letter beyond ASCII is a letter.
_OTHER, _SPACE, _DIGIT, _LETTER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]], _CLASS[48:58], _CLASS[97:123], _CLASS[128:] = _SPACE, _DIGIT, _LETTER, _LETTER
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^ \t\n\v\f\ra-z0-9{LATIN}]+")


class Splitter:
    """Texts into the words that the vocabulary's merges work on.  Texts of
    ASCII and Latin letters are split here; in other texts, the chunks with
    other characters by the library's own normaliser and splitting rule."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        conf = json.loads(spec)
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")
        self.library = Tokenizer.from_str(spec)
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}

    def has_special(self, text: str) -> bool:
        return "<|" in text and self.special_re.search(text) is not None

    def words(self, text: str) -> list[str | int]:
        """Words of a text in order, and the ids of special tokens written in it."""
        if not self.has_special(text):
            return self._split(text)
        out: list[str | int] = []
        for k, part in enumerate(self.special_re.split(text)):
            out += [self.special[part]] if k % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _WORDS.findall(text.lower())
        chunks = text.encode("utf-8").split()
        if len(chunks) > 1:
            return [w for c in chunks for w in self._split(c.decode("utf-8"))]
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, w)).decode("utf-8") for w, _ in split]


def is_plain(text: str) -> bool:
    return text.isascii() or _PLAIN.fullmatch(text) is not None


def plain_words(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """What ``_WORDS`` finds in plain texts in small letters: all words in order,
    and how many of them stand before each text and in all."""
    raw = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b"    ", np.uint8)
    kind = _CLASS[data]
    start = np.empty(len(data), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == _DIGIT
    # 's and its like: an apostrophe that no other such character stands before
    at = np.flatnonzero((data == 39) & start)
    one, two = data[at + 1], data[at + 2]
    long = ((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))   # re, ve, ll
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    inside = kind != _SPACE
    data, start = data[inside], np.flatnonzero(start[inside])
    offsets = np.append(start, len(data)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
    ends = np.cumsum([len(r) + 1 for r in raw])
    before = np.concatenate([[0], np.cumsum(inside)[ends - 1]])
    return words, np.searchsorted(start, before)


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte: printable bytes stand for
    themselves, the others for code points from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class TextEncoder:
    """Ids of whole texts, as bytes of little-endian unsigned 32-bit integers;
    ``encode`` gives the ids of sorted distinct words."""

    def __init__(self, splitter: Splitter, encode: Callable[[list[str]], list[bytes]], capacity: int = TABLE_BYTES):
        self.splitter, self.encode, self.capacity, self.bytes = splitter, encode, capacity, 0
        self.always = {i: np.uint32(i).tobytes() for i in splitter.special.values()}
        self.known: dict = dict(self.always)

    def table(self, wanted: set) -> dict:
        """A table that has all of ``wanted``."""
        new = sorted(wanted - self.known.keys())
        if not new:
            return self.known
        if self.bytes > self.capacity:
            self.known, self.bytes = dict(self.always), 0
            new = sorted(wanted - self.known.keys())
        fresh = dict(zip(new, self.encode(new)))
        short = fresh if max(map(len, new)) <= CACHE_CHARS else {k: v for k, v in fresh.items() if len(k) <= CACHE_CHARS}
        self.known.update(short)
        self.bytes += sum(entry_bytes(k, v) for k, v in short.items())
        return self.known if short is fresh else self.known | fresh

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if is_plain(t) and not self.splitter.has_special(t)]
        for i, x in zip(plain, self._plain_ids([texts[i].lower() for i in plain])):
            out[i] = x
        rest = [i for i, x in enumerate(out) if x is None]
        split = [self.splitter.words(texts[i]) for i in rest]
        known = self.table(set().union(*split))
        for i, words in zip(rest, split):
            out[i] = b"".join(map(known.__getitem__, words))
        return out

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        words, edge = plain_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids = [*map(self.table(set(distinct)).__getitem__, distinct)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first, at = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size, coded.indices.to_numpy()
        length = size[at]
        upto = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(first[at] - upto[:-1], length)
        place += np.arange(len(place))
        raw, ends = flat[place].tobytes(), (4 * upto[edge]).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def worker_encoder(key: tuple, make: Callable[[], TextEncoder]) -> TextEncoder:
    """The worker process's own encoder for ``key``, made at first use."""
    return held(("encoder", *key), make)


def library_encoder(spec: str) -> TextEncoder:
    """Word encoding by the tokenizers library.  Many words go through one call,
    blank-separated; the library tells the word of every id."""
    splitter = Splitter(spec)
    library = splitter.library
    library.no_truncation()
    library.no_padding()

    def one(word: str) -> bytes:
        return np.asarray(library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            got = library.encode(" ".join(part), add_special_tokens=False)
            ids, place = np.asarray(got.ids, "<u4"), np.asarray(got.word_ids, np.int64)
            if not len(place) or place[-1] != len(part) - 1:   # a word was split or lost: one by one
                out += map(one, part)
                continue
            edge, raw = (4 * np.searchsorted(place, np.arange(len(part) + 1))).tolist(), ids.tobytes()
            out += [raw[a:b] for a, b in zip(edge, edge[1:])]
        return out

    return TextEncoder(splitter, encode)
