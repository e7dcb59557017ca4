"""Quality rules with risk-controlled thresholds.

Each rule is a share between 0 and 1 of something undesirable in a text.  A
document is rejected when a rule's share reaches the cutoff of its stratum.
Cutoffs come from labelled documents: one half (by a hash of the id) tunes,
the other half is the holdout.  For a stratum and rule the cutoffs of a fixed
grid are tested on the holdout from the safest one down; a cutoff passes when
the exact (Clopper-Pearson) upper bound of the share of good documents it
rejects is within the rule's part of the risk, and testing stops at the first
that fails, so the order costs no confidence.  Strata and rules share the
error probability and the risk equally (Bonferroni and union bound):

    P(for every stratum: false rejections <= ``risk``) >= 1 - ``error``.

Of the cutoffs that pass, the lowest is taken whose rejections in the tuning
half, below the next cutoff up, are mostly bad documents.  Without one, the
rule rejects nothing in that stratum.

Only counts per (half, stratum, rule, grid cell, label) reach the driver; the
number of strata must be small, as for languages.

Defined cases: null text counts as a text without words (base rule: failed);
null strata form the stratum ''; labels of unknown documents, null labels and
null ids are ignored; of repeated labels the highest counts; rows repeated in
``docs`` are each reported; empty labels mean that no rule rejects.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import materialise
from statlake.llm.text import _SPACE, by_slice, windows, words_of

GRID = 20            # cutoffs 1/20 .. 20/20
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(n_letters, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "lines": "n_dup_lines / greatest(n_lines, 1)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_marks", "n_capitals", "n_letters")
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def _repeated(hashes: np.ndarray) -> int:
    """Words covered by windows that occur at least twice in the text."""
    win = windows(hashes, WINDOW)
    if len(win) < 2:
        return 0
    order = np.argsort(win, kind="stable")
    same = win[order[1:]] == win[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(win), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    w = words_of(batch.column("text"), lower=False)
    data, off = w.data, w.offsets

    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[off[1:]] - total[off[:-1]]

    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    lines = [_lines(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("stratum"),
         *[pa.array(np.asarray(x, np.int64)) for x in (
             np.diff(w.first), per_doc(~_SPACE[data] & ((data & 0xC0) != 0x80)),
             per_doc(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))), [b for _, b in lines],
             [_repeated(w.hashes[a:b]) for a, b in zip(w.first[:-1], w.first[1:])], [a for a, _ in lines],
             per_doc(data == 33), per_doc(upper), per_doc(upper | lower))]],
        ["doc_id", "stratum", *COUNTS])


def features(docs: DataFrame, stratum: str | None = "lang", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The counts of every row: doc_id, stratum and ``COUNTS``."""
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(F.col(stratum).cast("string") if stratum else F.lit(""), F.lit("")).alias("stratum"))
    return source.mapInArrow(by_slice(_count), "doc_id long, stratum string, "
                             + ", ".join(f"{c} long" for c in COUNTS))


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + step * d, 1 + step / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1) < 1e-13:
            break
    return front * total


def upper_bound(rejected: int, total: int, error: float) -> float:
    """Clopper-Pearson: the share p at which ``rejected`` or fewer of ``total``
    has probability ``error``."""
    if rejected >= total:
        return 1.0
    low, high = rejected / total, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if 1 - beta_cdf(rejected + 1, total - rejected, mid) > error:
            low = mid
        else:
            high = mid
    return high


def choose(hist: dict[tuple, np.ndarray], strata: list[str], rules: list[str], risk: float, error: float,
           min_precision: float) -> dict[tuple[str, str], int]:
    """(stratum, rule) -> grid cell from which documents are rejected.  ``hist``
    maps (holdout?, stratum, rule, quality) to counts by cell 0..GRID."""
    none = np.zeros(GRID + 1, np.int64)
    error_each, risk_each = error / max(1, len(strata) * len(rules)), risk / max(1, len(rules))
    out = {}
    for s in strata:
        for r in rules:
            good = hist.get((True, s, r, 1), none)
            tune_good, tune_bad = hist.get((False, s, r, 1), none), hist.get((False, s, r, 0), none)
            for cell in range(GRID, 0, -1):
                if not good.sum() or upper_bound(int(good[cell:].sum()), int(good.sum()), error_each) > risk_each:
                    break
                if tune_bad[cell] and tune_bad[cell] >= min_precision * (tune_bad[cell] + tune_good[cell]):
                    out[s, r] = cell
    return out


def cutoffs(feats: DataFrame, labels: DataFrame, risk: float = 0.05, error: float = 0.05,
            min_precision: float = 0.9, id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """Certified cutoffs from documents that pass the base rule."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
             .where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")))
    rows = feats.where(f"NOT ({BASE_FAILED})").join(marks, "doc_id")
    cells = F.array(*[F.struct(F.lit(r).alias("rule"),
                               F.least(F.floor(F.expr(e) * GRID), F.lit(GRID)).cast("int").alias("cell"))
                      for r, e in RULES.items()])
    counts = (rows.withColumn("holdout", F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
              .select("holdout", "stratum", "quality", F.inline(cells))
              .groupBy("holdout", "stratum", "rule", "quality", "cell").count())
    hist: dict[tuple, np.ndarray] = {}
    for x in counts.collect():   # halves * strata * rules * 2 * (GRID + 1) rows at most
        hist.setdefault((x.holdout, x.stratum, x.rule, x.quality), np.zeros(GRID + 1, np.int64))[x.cell] += x["count"]
    return choose(hist, sorted({k[1] for k in hist}), list(RULES), risk, error, min_precision)


def judge(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = 0.05,
          error: float = 0.05, min_precision: float = 0.9, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, rejected_by (array of rules)."""
    feats = materialise(features(docs, stratum, id_col, text_col), "quality-features")
    chosen = cutoffs(feats, labels, risk, error, min_precision)
    hits = [F.when((F.col("stratum") == s) & (F.floor(F.expr(RULES[r]) * GRID) >= cell), F.lit(r))
            for (s, r), cell in sorted(chosen.items())]
    reasons = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    out = feats.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rejected_by", reasons)
    return out.select("doc_id", *COUNTS, "base_failed",
                      (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "rejected_by")
