"""BPE encoding by prefix-sharing trie traversal, and decoding.

The tokens of a word's prefix end in one *last token*; the prefix's encoding
is that token after the encoding of what stands before it.  A token that ends
the prefix is the last one exactly when it and the last token of the shorter
prefix stay apart under the merge rules.  So one state per trie node, (last
token, node before that token), encodes every word with that prefix.  Words
are inserted in sorted order: new nodes appear in depth-first order, take
their state from their ancestors, and shared prefixes are computed once.

Two symbols stand for each byte: inside a word, and at its end (the
vocabulary's word-end suffix).  Inner nodes use inner symbols only.

Defined cases: null and empty texts have no tokens (and decode to the empty
string); special tokens written in a text become their ids, as the tokenizers
library does; any byte sequence of valid UTF-8 is covered.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from statlake.llm.chunks import Splitter, TextEncoder, byte_alphabet, worker_encoder
from statlake.llm.frames import id_text
from statlake.llm.text import by_slice

MAX_NODES = 250_000   # the trie is rebuilt beyond this; bounds a worker's memory


class TrieBpe:
    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        chars = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(chars)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in reversed([*enumerate(pairs)])
                 for a, b in [(a, b)]}
        made = {t: r for t, (_, _, r) in parts.items()}
        if any(made.get(x, -1) >= r for a, b, r in parts.values() for x in (a, b)):
            raise ValueError("a merge uses a token that a later merge makes")
        # a token's edge, symbol by symbol: (token at the edge, rank of the merge that absorbs it)
        self.right_edge = {t: self._edge(t, parts, 1) for t in vocab.values()}
        self.left_edge = {t: self._edge(t, parts, 0) for t in vocab.values()}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        symbols = {*(vocab[c] for c in chars), *(vocab[c + suffix] for c in chars)}
        for token, i in vocab.items():
            ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
            body = token[:-len(suffix)] if ends else token
            # special tokens are not made by merges
            if (i in parts or i in symbols) and all(c in to_byte for c in body):
                (self.final if ends else self.inner)[bytes(to_byte[c] for c in body)] = i
        self.inner_sizes, self.final_sizes = self._sizes(self.inner), self._sizes(self.final)
        self.splitter = Splitter(spec)
        self.apart: dict[int, bool] = {}
        tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in conf["added_tokens"]}
        self.strings = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.reset()

    @staticmethod
    def _edge(token: int, parts: dict, side: int) -> list[tuple[int, float]]:
        out = [(token, float("inf"))]
        while token in parts:
            rank = parts[token][2]
            token = parts[token][side]
            out.append((token, rank))
        return out[::-1]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges of ``left + right`` end in these two tokens.  Merges
        run in order of rank (no merge enables a lower one), so the two edges
        grow step by step; they stay apart if no pair that meets in between
        merges before either side absorbs it."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > 300_000:
                self.apart.clear()
            known = self.apart[key] = self._stay_apart(self.right_edge[left], self.left_edge[right])
        return known

    def _stay_apart(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (a, ra), (b, rb) = left[i], right[j]
            r = self.rank.get((a, b))
            # of equal ranks the leftmost merges first
            if r is not None and r < ra and r <= rb:
                return False
            if ra <= rb:
                if ra == float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def reset(self) -> None:
        self.child: dict[int, int] = {}
        self.last, self.back = [-1], [-1]   # by node; node 0 is the empty prefix

    @staticmethod
    def _sizes(table: dict[bytes, int]) -> dict[bytes, list[int]]:
        """Lengths of the tokens that end with the given (up to three) bytes, longest first."""
        ends: dict[bytes, set[int]] = {}
        for body in table:
            ends.setdefault(body[-3:], set()).add(len(body))
        short = {e: {len(e[k:]) for k in range(1, len(e)) if e[k:] in table} for e in ends}
        return {e: sorted(sizes | short[e], reverse=True) for e, sizes in ends.items()}

    def state(self, word: bytes, end: int, path: list[int], final: bool) -> tuple[int, int]:
        """Last token of ``word[:end]`` and the node before it."""
        last, table, sizes = (self.last, self.final, self.final_sizes) if final else \
            (self.last, self.inner, self.inner_sizes)
        for size in sizes.get(word[end - 3 if end > 3 else 0:end], (2, 1)):
            token = table.get(word[end - size:end]) if size <= end else None
            if token is not None:
                before = path[end - size]
                if before == 0 or self.stay_apart(last[before], token):
                    return token, before
        raise ValueError("no token ends here")  # single bytes are tokens, so never

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of sorted distinct words."""
        out, path, before = [], [0], b""
        child, last, back = self.child, self.last, self.back
        for word in words:
            shared, n = 0, min(len(before), len(word))
            while shared < n and before[shared] == word[shared]:
                shared += 1
            del path[shared + 1:]
            for at in range(len(path) - 1, len(word) - 1):
                key = path[at] << 8 | word[at]
                node = child.get(key)
                if node is None:
                    token, prev = self.state(word, at + 1, path, False)
                    node = child[key] = len(last)
                    last.append(token)
                    back.append(prev)
                path.append(node)
            token, node = self.state(word, len(word), path, True)
            ids = [token]
            while node:
                ids.append(last[node])
                node = back[node]
            out.append(ids[::-1])
            before = word[:len(path) - 1]
        return out

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of sorted distinct words (code point order is UTF-8 order)."""
        if len(self.last) > MAX_NODES:
            self.reset()
        found = self.words([w.encode("utf-8") for w in words])
        edge = (4 * np.cumsum([0, *map(len, found)])).tolist()
        raw = np.fromiter((i for ids in found for i in ids), "<u4").tobytes()
        return [raw[a:b] for a, b in zip(edge, edge[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by a blank: the vocabulary declares no decoder."""
        return b" ".join(map(self.strings.__getitem__, ids.tolist()))


class TrieEncoder(TextEncoder):
    def __init__(self, model: TrieBpe):
        super().__init__(model.splitter, model.encode)
        self.model = model


def trie_encoder(spec: str) -> TrieEncoder:
    return TrieEncoder(TrieBpe(spec))


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  with_values: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with
    ``with_values`` also ids (array<long>) and decoded (string).

    ``vocabulary`` is the path of a tokenizers JSON file, read on the driver
    and broadcast (its size is that of one vocabulary, a few megabytes)."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = worker_encoder(("trie", vocabulary), lambda: trie_encoder(shared.value))
        model = encoder.model
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = encoder.ids(texts)
        decoded = [model.decode(np.frombuffer(x, "<u4")) for x in ids]
        cols = {"doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())}
        if with_values:
            cols["ids"] = pa.array([np.frombuffer(x, "<u4").tolist() for x in ids], pa.list_(pa.int64()))
            cols["decoded"] = pa.array([x.decode("utf-8") for x in decoded], pa.string())
        return pa.RecordBatch.from_pydict(cols)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_text(docs, id_col, text_col).mapInArrow(
        by_slice(run), schema + (", ids array<long>, decoded string" if with_values else ""))
