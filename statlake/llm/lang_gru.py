"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads all bytes of a text (UTF-8, A-Z in lower case), letters,
blanks, digits and everything else, forwards and backwards, and labels every
byte position with probabilities of the languages.  A document's probabilities
are the mean over all its positions.

A text is read in spans of ``SPAN`` bytes that run side by side.  Each direction
carries its state through ``WARM`` more bytes before its span, whose labels
belong to the neighbour; mostly it has forgotten by then where it began.  The
state it enters its span with is compared with the one its neighbour left with,
and a span that began with another state (``SAME``) is read again from the
neighbour's, until all agree.  So labels are those of a run over the whole text.

Trained in numpy by backpropagation through time (Adam), on the driver, on a
bounded sample of labelled rows: windows of ``WINDOW`` bytes, up to
``train_windows`` evenly spread over each of the ``train_docs`` documents with
the smallest id hashes.  Weights are a few tens of kilobytes and are broadcast.

Defined cases: null text and texts without a letter are ``und`` with score 0;
rows with null labels are not learned from; repeated rows are labelled alike;
very long texts are read whole, in spans; without any labelled row every text
with a letter is ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import id_text, ship
from statlake.llm.held import held
from statlake.llm.text import by_slice

UND = "und"
SPAN, WARM = 1024, 256
LANES = 1024          # spans read side by side
SAME = 5e-3           # states that differ by less are one state
WINDOW = 64           # bytes of a training window
LETTER = re.compile(r"[^\W\d_]")


def raw(text: str) -> bytes:
    return text.encode("utf-8").lower()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Gru:
    """One direction.  z, r, n = gates over [update, reset, candidate]."""

    embed: np.ndarray     # 256 x 3H: what each byte adds to the gates, bias included
    state: np.ndarray     # H x 3H

    def forward(self, x: np.ndarray) -> list[tuple]:
        """x: T x B bytes.  Per step: state before, update, reset, candidate, state after."""
        h, size, out = np.zeros((x.shape[1], len(self.state)), np.float32), len(self.state), []
        for t in range(len(x)):
            inp, rec = self.embed[x[t]], h @ self.state
            gates = _sigmoid(inp[:, :2 * size] + rec[:, :2 * size])
            z, r = gates[:, :size], gates[:, size:]
            n = np.tanh(inp[:, 2 * size:] + r * rec[:, 2 * size:])
            after = n + z * (h - n)
            out.append((h, z, r, n, after, rec[:, 2 * size:]))
            h = after
        return out

    def backward(self, x: np.ndarray, steps: list[tuple], grads: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of embed and state, from those of every step's state."""
        g_embed, g_state, carry = np.zeros_like(self.embed), np.zeros_like(self.state), 0.0
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, _, rec_n = steps[t]
            g = grads[t] + carry
            gn = g * (1 - z) * (1 - n * n)
            gz = g * (h - n) * z * (1 - z)
            gr = gn * rec_n * r * (1 - r)
            gate = np.concatenate([gz, gr, gn], 1)
            np.add.at(g_embed, x[t], gate)
            rec = np.concatenate([gz, gr, gn * r], 1)
            g_state += h.T @ rec
            carry = g * z + rec @ self.state.T
        return g_embed, g_state


@dataclass
class Model:
    langs: list[str]
    ahead: Gru
    back: Gru
    out: np.ndarray       # 2H + 1 x langs

    def positions(self, x: np.ndarray):
        """x: T x B bytes, one length.  Probabilities T x B x langs, and what backward needs."""
        a, b = self.ahead.forward(x), self.back.forward(x[::-1])
        h = np.concatenate([np.stack([s[4] for s in a]), np.stack([s[4] for s in b[::-1]]),
                            np.ones((*x.shape, 1), np.float32)], 2)
        score = h @ self.out
        p = np.exp(score - score.max(2, keepdims=True))
        return p / p.sum(2, keepdims=True), h, a, b

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Per text: sum over all its positions of the probabilities."""
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // SPAN) for t in texts])
        at = (np.arange(len(owner)) - np.searchsorted(owner, owner)) * SPAN
        left = np.array([len(texts[k]) for k in owner.tolist()], np.int64) - at
        sums = np.zeros((len(owner), len(self.langs)))
        states = np.zeros((2, 2, len(owner), len(self.ahead.state)), np.float32)   # ahead and back; entered, left
        todo, warm = np.argsort(-left, kind="stable"), True                        # like lengths side by side
        inner = np.flatnonzero(owner[1:] == owner[:-1])      # spans with a next one
        while len(todo):
            for lo in range(0, len(todo), LANES):
                some = todo[lo:lo + LANES]
                sums[some], states[:, :, some] = self._spans([texts[k] for k in owner[some].tolist()], at[some],
                                                             None if warm else states[:, 0, some])
            # ahead, a span goes on from the one before it; back, from the one after it
            (ahead, ahead_left), (back, back_left) = states
            off = np.zeros(len(owner), bool)
            off[inner + 1] |= np.abs(ahead[inner + 1] - ahead_left[inner]).max(1, initial=0) > SAME
            off[inner] |= np.abs(back[inner] - back_left[inner + 1]).max(1, initial=0) > SAME
            one, other = inner[off[inner + 1]], inner[off[inner]]
            ahead[one + 1], back[other] = ahead_left[one], back_left[other + 1]
            todo, warm = np.flatnonzero(off), False
            todo = todo[np.argsort(-left[todo], kind="stable")]
        out = np.zeros((len(texts), len(self.langs)))
        np.add.at(out, owner, sums)
        return out

    def _spans(self, texts: list[bytes], at: np.ndarray, entered: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Per span, ``texts[i][at[i]:at[i] + SPAN]``: sums of its positions'
        probabilities, and per direction the states that it was entered with (the
        given ones, or those after the bytes that warm up) and left with."""
        upto = np.minimum(at + SPAN, [len(t) for t in texts])
        size, first = upto - at, np.maximum(at - WARM, 0)
        last = np.minimum(upto + WARM, [len(t) for t in texts])
        order = np.argsort(-size, kind="stable")
        texts, at, size, first, last, upto = [texts[i] for i in order], at[order], size[order], first[order], last[order], upto[order]
        steps = int(size[0])
        core = _lanes([t[a:b] for t, a, b in zip(texts, at.tolist(), upto.tolist())], steps)
        alive = np.searchsorted(-size, -np.arange(steps), side="left")    # lanes longer than t: size > t
        n, langs, width = len(texts), len(self.langs), len(self.ahead.state)
        ahead, back = _Step(self.ahead, n), _Step(self.back, n)
        if entered is None:
            # the bytes that warm each direction up, nearest to the span last
            before = _lanes([t[a:b][::-1] for t, a, b in zip(texts, first.tolist(), at.tolist())], WARM)[::-1]
            after = _lanes([t[a:b] for t, a, b in zip(texts, upto.tolist(), last.tolist())], WARM)[::-1]
            ahead.warm(before, at - first)
            back.warm(after, last - upto)
        else:
            ahead.h[:], back.h[:] = entered[0][order].T, entered[1][order].T
        states = np.empty((2, 2, n, width), np.float32)
        states[0, 0, order], states[1, 0, order] = ahead.h.T, back.h.T
        w = np.ascontiguousarray(self.out.T)
        score = np.empty((steps, langs, n), np.float32)
        for t in range(steps):
            m = alive[t]
            score[t, :, :m] = w[:, :width] @ ahead(core[t, :m]) + w[:, -1:]
        sums = np.zeros((langs, n), np.float32)
        for t in range(steps - 1, -1, -1):
            m = alive[t]
            p = score[t, :, :m] + w[:, width:-1] @ back(core[t, :m])
            p -= p.max(0)
            np.exp(p, out=p)
            sums[:, :m] += p / p.sum(0)
        states[0, 1, order], states[1, 1, order] = ahead.h.T, back.h.T
        out = np.empty((n, langs))
        out[order] = sums.T
        return out, states


def _lanes(parts: list[bytes], steps: int) -> np.ndarray:
    """Steps x lanes; shorter parts are followed by zeros."""
    if not steps:
        return np.zeros((0, len(parts)), np.uint8)
    whole = np.frombuffer(b"".join(p.ljust(steps, b"\0") for p in parts), np.uint8)
    return np.ascontiguousarray(whole.reshape(len(parts), steps).T)


class _Step:
    """One direction over many lanes, a column each."""

    def __init__(self, gru: Gru, lanes: int):
        self.size = len(gru.state)
        # sigmoid(x) = (1 + tanh(x / 2)) / 2: halves of the gates' inputs
        half = np.repeat(np.float32([0.5, 0.5, 1]), self.size)
        self.embed = np.ascontiguousarray((gru.embed * half).T.astype(np.float32))
        self.state = np.ascontiguousarray((gru.state * half).T.astype(np.float32))
        self.h = np.zeros((self.size, lanes), np.float32)

    def __call__(self, x: np.ndarray, columns: slice | np.ndarray | None = None) -> np.ndarray:
        """The states of the first lanes after one more byte each."""
        k, m = self.size, len(x)
        h = self.h[:, :m]
        inp, rec = np.take(self.embed, x, axis=1), self.state @ h
        gates = inp[:2 * k]
        gates += rec[:2 * k]
        np.tanh(gates, out=gates)
        gates *= np.float32(0.5)
        gates += np.float32(0.5)
        z, r = gates[:k], gates[k:]
        n = inp[2 * k:]
        r *= rec[2 * k:]
        n += r
        np.tanh(n, out=n)
        after = h - n
        after *= z
        after += n
        self.h[:, :m] = after
        return after

    def warm(self, x: np.ndarray, length: np.ndarray) -> None:
        """Carry the states through the last ``length`` rows of ``x`` (lanes differ)."""
        for t in range(len(x)):
            some = np.flatnonzero(length >= len(x) - t)
            if len(some) == len(length):
                self(x[t])
            elif len(some):
                lane = _Step.__new__(_Step)
                lane.size, lane.embed, lane.state = self.size, self.embed, self.state
                lane.h = self.h[:, some]
                self.h[:, some] = lane(x[t, some])


def train(samples: list[tuple[str, bytes]], hidden: int = 8, steps: int = 400, batch: int = 384,
          rate: float = 0.03, seed: int = 7) -> Model:
    """``samples``: (language, window of a text)."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in samples})

    def gru() -> Gru:
        return Gru(rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
                   rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32))

    model = Model(langs, gru(), gru(), rng.normal(0, 0.1, (2 * hidden + 1, len(langs))).astype(np.float32))
    params = [model.ahead.embed, model.ahead.state, model.back.embed, model.back.state, model.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    # one length per step, lengths in proportion to their bytes; languages equally often
    groups: dict[int, tuple[list, list, list]] = {}
    count = np.bincount([langs.index(lang) for lang, _ in samples], minlength=len(langs))
    for lang, window in samples:
        g, k = groups.setdefault(len(window), ([], [], [])), langs.index(lang)
        g[0].append(window), g[1].append(k), g[2].append(1 / count[k])
    lengths = sorted(groups)
    share = np.array([n * sum(groups[n][2]) for n in lengths])
    data = {n: (np.frombuffer(b"".join(g[0]), np.uint8).reshape(-1, n), np.array(g[1]), np.array(g[2]) / sum(g[2]))
            for n, g in groups.items()}
    for step in range(1, steps + 1):
        n = lengths[rng.choice(len(lengths), p=share / share.sum())]
        rows, label, weight = data[n]
        at = rng.choice(len(rows), batch, p=weight)
        x, y = np.ascontiguousarray(rows[at].T), label[at]
        p, h, a, b = model.positions(x)
        g = p.copy()
        g[:, np.arange(batch), y] -= 1
        g /= p.shape[0] * batch
        gh = g @ model.out.T
        ga = model.ahead.backward(x, a, list(gh[:, :, :hidden]))
        gb = model.back.backward(x[::-1], b, list(gh[::-1, :, hidden:2 * hidden]))
        grads = [*ga, *gb, np.einsum("tbh,tbl->hl", h, g)]
        norm = np.sqrt(sum(float((d * d).sum()) for d in grads))
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1))) * min(1.0, 1.0 / max(norm, 1e-9))
        for q, d, m, v in zip(params, grads, first, second):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            q -= (lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def windows(text: bytes, most: int) -> list[bytes]:
    """Up to ``most`` windows, evenly spread over the whole text."""
    spare = len(text) - WINDOW
    if spare <= 0:
        return [text] if text else []
    n = min(most, 1 + spare // WINDOW)
    return [text[at:at + WINDOW] for at in (spare * k // max(n - 1, 1) for k in range(n))]


def _sample_windows(most: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [windows(raw(t), most) if t and LETTER.search(t) else [] for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.list_(pa.binary()))], ["lang", "windows"])
    return one


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = 2000, train_windows: int = 16, **options) -> Model | None:
    """A model from the rows where ``learn`` holds and the language is known."""
    ship(docs.sparkSession)
    rows = docs.where(learn).select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                                    F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # ids first, so that no text travels before the bound is applied
    ids = [r[0] for r in rows.select("doc_id", F.xxhash64("doc_id").alias("h")).where("doc_id IS NOT NULL")
           .orderBy("h", "doc_id").limit(train_docs).collect()]
    got = (rows.where(F.col("doc_id").isin(ids)).select("lang", "text")
           .mapInArrow(by_slice(_sample_windows(train_windows)), "lang string, windows array<binary>").collect()) if ids else []
    samples = sorted((r.lang, bytes(w)) for r in got for w in r.windows)
    return train(samples, **options) if samples else None


def _labelled(model: Model | None, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, probabilities) of every text of a column."""
    texts = column.to_pylist()
    langs = model.langs if model else []
    p = np.zeros((len(texts), max(1, len(langs))))
    known = [i for i, t in enumerate(texts) if langs and t and LETTER.search(t)]
    if known:
        bytes_ = [raw(texts[i]) for i in known]
        p[known] = model.pooled(bytes_) / np.array([[len(b)] for b in bytes_])
    named = np.full(len(texts), UND, dtype=object)
    named[known] = np.array(langs, dtype=object)[p[known].argmax(1)] if known else UND
    score = np.zeros(len(texts))
    score[known] = np.clip(p[known].max(1), 0, 1)
    return named.tolist(), score, p


def _sent(docs: DataFrame, model: Model | None) -> Callable[[], Model | None]:
    """The model in a task.  It is the worker's one table then: those of an
    operator that ran before, such as encoded words, are given back first."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    return lambda: held(("gru", name), lambda: shared.value)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, p (array of the languages' probabilities)."""
    ship(docs.sparkSession)
    sent = _sent(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = sent()
        named, score, p = _labelled(model, batch.column("text"))
        width = len(model.langs) if model else 0
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(score),
             pa.array([x[:width].tolist() if lang != UND else [] for x, lang in zip(p, named)], pa.list_(pa.float64()))],
            ["doc_id", "lang_pred", "score", "p"])

    return id_text(docs, id_col, text_col).mapInArrow(by_slice(run), "doc_id long, lang_pred string, score double, "
                                                                     "p array<double>")


def known_language(docs: DataFrame, model: Model | None, least: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a learned language with a
    mean probability of ``least`` or more.  Each row carries its own verdict."""
    ship(docs.sparkSession)
    sent = _sent(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        named, score, _ = _labelled(sent(), batch.column(batch.schema.get_field_index(text_col)))
        return batch.filter(pa.array([lang != UND and s >= least for lang, s in zip(named, score)], pa.bool_()))

    return docs.mapInArrow(by_slice(run, text_col), docs.schema)


def remainder(id_col: str = "doc_id", of: int = 4) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % of
