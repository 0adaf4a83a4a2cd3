"""Quality rules (operator 6): hashed n-gram logistic regression on labelled rows.

A text's features are the shares of its hashed trigrams of characters and of its hashed
words and word pairs. A logistic regression is fitted on a bounded, hash-ordered
sample of labelled rows (``SAMPLE_PER_CLASS`` per class), its scores are
calibrated (Platt scaling on a part of the sample that the fit has not seen,
moved to the class shares of all labelled rows), and the model, a fixed number
of weights, scores every text in Arrow batches against a fixed threshold.

Defined results: null and empty texts have no words and fail the base rule; a
table without labels of both classes gives a model that keeps what passes the
base rule; repeated rows are scored each; null labels are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import NONSPACE, SMALL_SLICE_BYTES, giving_back, mix64, slices, table_of, windows, words

#: Bound of the labelled sample that the classifier is fitted on.
SAMPLE_PER_CLASS = 1000
#: Weights of character trigrams, and of words and word pairs.
BITS = 14
#: Texts with a calibrated probability of good quality below it are rejected.
KEEP_FROM = 0.5

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = table_of("#*$%&|<>")


@dataclass
class QualityModel:
    weights: np.ndarray  # 3 << BITS: character trigrams, words, word pairs
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.offset, -500, 500)))


def _characters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of every character as one number, and characters before each row."""
    starts = np.flatnonzero((buf & 0xC0) != 0x80)
    code = buf[starts].astype(np.uint64)
    size = np.diff(np.append(starts, len(buf)))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << np.uint64(8) | buf[starts[more] + k]
    return code, np.searchsorted(starts, offs)


def _grams(buf: np.ndarray, offs: np.ndarray, h: np.ndarray, upto: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each feature family: hashed feature of every gram, and grams before each row."""
    out = []
    code, chars = _characters(buf, offs)
    at, g = windows(mix64(code), chars, 3)
    out.append(((g >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(at, chars)))
    out.append(((h >> np.uint64(64 - BITS)).astype(np.int64) + (1 << BITS), upto))
    at, w = windows(h, upto, 2)
    out.append(((w >> np.uint64(64 - BITS)).astype(np.int64) + (2 << BITS), np.searchsorted(at, upto)))
    return out


def _repeats(h: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Words in windows of three that are found twice or more in their row, per row."""
    rows = len(upto) - 1
    at, w = windows(h, upto, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(rows, dtype=np.int64)
    doc = np.searchsorted(upto, at, "right") - 1
    key = mix64(w + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, dtype=bool)
    same[1:-1] = k[1:] == k[:-1]
    twice = at[order[same[:-1] | same[1:]]]
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + REPEAT_WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    return covered[upto[1:]] - covered[upto[:-1]]


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(x)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _scan(model: QualityModel | None, names: list[str], text: str, statistics: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            parts: list[list[np.ndarray]] = [[] for _ in statistics]
            for _, _, buf, offs in slices(cols[text], SMALL_SLICE_BYTES):
                starts, ends, h, upto = words(buf, offs, NONSPACE, lower=False)
                lead = _sums((buf & 0xC0) != 0x80, offs)  # code points
                space = _sums(~NONSPACE[buf], offs)
                raw = buf.tobytes()
                dup = [_dup_lines(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                margin = np.zeros(len(offs) - 1)
                if model is not None:
                    for feature, bounds in _grams(buf, offs, h, upto):
                        margin += _sums(model.weights[feature], bounds) / np.maximum(np.diff(bounds), 1)
                p = model.probability(margin) if model is not None else np.ones(len(margin))
                for part, x in zip(parts, (np.diff(upto), lead - space, _sums(SYMBOLS[buf], offs), np.array(dup, dtype=np.int64), _repeats(h, upto), p)):
                    part.append(x)
            for name, part, kind in zip(statistics, parts, (*[pa.int64()] * 5, pa.float64())):
                cols[name] = pa.array(np.concatenate(part) if part else [], type=kind)
            yield pa.RecordBatch.from_arrays([cols[k] for k in names], names=names)

    return run


def _sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[int, str]]:
    """At most ``per_class`` labelled texts of each class, in an order fixed by a hash of the id."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).filter(
        F.col("__y").isin(0, 1) & F.col("__id").isNotNull()).dropDuplicates(["__id"])
    rows: list[tuple[int, str]] = []
    for y in (0, 1):
        chosen = known.filter(F.col("__y") == y).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(per_class)
        text = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).filter(F.col("__text").isNotNull())
        found = text.join(F.broadcast(chosen), "__id").orderBy("__id", "__text").limit(2 * per_class).collect()
        rows += [(y, r["__text"]) for r in found]
    return rows


def _shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, share) pairs of one text."""
    feature, share = [], []
    for _, _, buf, offs in slices(pa.array([text])):
        _, _, h, upto = words(buf, offs, NONSPACE, lower=False)
        for f, _ in _grams(buf, offs, h, upto):
            u, n = np.unique(f, return_counts=True)
            feature.append(u)
            share.append(n / max(1, len(f)))
    return np.concatenate(feature), np.concatenate(share)


def _logistic(feature: np.ndarray, share: np.ndarray, row: np.ndarray, y: np.ndarray, size: int,
              rounds: int = 150, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Full-batch logistic regression by Adam on sparse rows; classes weigh the same."""
    w, b, scale = np.zeros(size), 0.0, 30.0
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    x = share * scale
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=x * w[feature], minlength=len(y)) + b
        r = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * weight
        g = np.append(np.bincount(feature, weights=x * r[row], minlength=size) + ridge * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w * scale, b


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of 1 given a margin; classes weigh the same, targets are smoothed."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    a, c, spread = 1.0, 0.0, max(float(np.std(z)), 1e-9)
    u = z / spread
    for _ in range(100):  # Newton steps on two parameters
        p = 1 / (1 + np.exp(-np.clip(a * u + c, -500, 500)))
        g = np.array([((p - target) * weight * u).sum(), ((p - target) * weight).sum()])
        k = weight * np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(k * u * u).sum() + 1e-6, (k * u).sum()], [(k * u).sum(), k.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        a, c = a - step[0], c - step[1]
    return a / spread, c


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> QualityModel | None:
    """Model of label 1, or None where the labelled rows lack a class."""
    rows = _sample(docs, labels, label, per_class)
    y = np.array([r[0] for r in rows])
    shares = [{r[0]: int(r[1]) for r in labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int")).count().collect()}]
    held = np.arange(len(y)) % 4 == 3
    if any(((y == k) & part).sum() == 0 for k in (0, 1) for part in (held, ~held)):
        return None
    each = [_shares(r[1]) for r in rows]
    row = np.repeat(np.arange(len(y)), [len(f) for f, _ in each])
    feature, share = np.concatenate([f for f, _ in each]), np.concatenate([s for _, s in each])
    used = ~held[row]
    place = np.cumsum(~held) - 1
    size = 3 << BITS
    w, b = _logistic(feature[used], share[used], place[row[used]], y[~held], size)
    z = np.bincount(row, weights=share * w[feature], minlength=len(y)) + b
    slope, offset = _platt(z[held], y[held])
    n = shares[0]
    return QualityModel(w, b, slope, offset + float(np.log(max(1, n.get(1, 0)) / max(1, n.get(0, 0)))))


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "p_good"]


def score_quality(docs: DataFrame, model: QualityModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and struct ``_quality``: the statistics of the base rules, ``p_good``
    (calibrated probability of good quality), ``base_failed`` and ``kept``."""
    kept = docs.columns if keep is None else keep
    own = [f"__quality_{c}" for c in STATISTICS]
    shown = docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(0).cast("long" if c != "p_good" else "double").alias(k) for c, k in zip(STATISTICS, own)]).schema
    out = docs.mapInArrow(giving_back(_scan(model, shown.names, text, own)), shown)
    n, repeat, p = (F.col(f"__quality_{c}") for c in ("n_words", "n_repeat_words", "p_good"))
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(
        *[F.col(k).alias(c) for c, k in zip(STATISTICS, own)], failed.alias("base_failed"),
        (~failed & (p >= KEEP_FROM)).alias("kept")).alias("_quality"))
