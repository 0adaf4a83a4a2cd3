"""Language identification (operator 8): interpolated Kneser-Ney character models.

Letters are lower-cased, everything else is one blank between words, and three
empty characters stand before a text. A character is its 16-bit number in an alphabet:
the letters of the learning texts by falling count (of more than 65,533 the first), with one
number for all others. A 4-gram is its four numbers in a sorted 64-bit array; contexts and
lower orders are arrays of the same kind, by their last characters. For each language the order-4 model uses counts
and the lower orders continuation counts, with the discount n1 / (n1 + 2 n2) of
each order, down to a uniform distribution.

The models are learned from a hash sample of labelled texts, of
``SAMPLE_PER_LANGUAGE`` texts for each language in expectation, which bounds what
is sent to the tasks; its n-grams are counted in Spark. A quarter of the sample is
held back: it fits the temperature that turns cross-entropies into probabilities
and the cross-entropy above which a prediction is marked ``rejected``.

The language of the lowest cross-entropy per character is chosen. Defined
results: a text that is null or has no letter is ``und`` with score 0, and so is
every text if no labelled text was there; ties go to the first language by name;
repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import text_column

ORDER = 4
SAMPLE_PER_LANGUAGE = 3000
#: Share of held-back texts of the right language above whose cross-entropy a prediction is rejected.
REJECT_SHARE = 0.005
UNKNOWN = "und"
_SLICE = 1 << 19
_SPACE = 32
#: Numbers of blanks and of letters that are not in the alphabet; its own begin behind them. 0 is padding.
_BLANK, _OTHER = 1, 2
MOST_LETTERS = (1 << 16) - 1 - _OTHER

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def code_points(texts: list[str]) -> np.ndarray:
    """The lower-cased letters of texts, other characters as blanks, with padding around every text."""
    pad = "\0" * (ORDER - 1)
    joined = pad + pad.join(t.replace("\0", " ").lower() for t in texts) + pad
    c = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(_is_letter()[c] | (c == 0), c, _SPACE)


def numbering(alphabet: np.ndarray) -> np.ndarray:
    """The number of every code point, from the letters of an alphabet in order."""
    table = np.full(0x110000, _OTHER, dtype=np.uint16)
    table[0], table[_SPACE] = 0, _BLANK
    table[alphabet] = np.arange(len(alphabet)) + _OTHER + 1
    return table


def grams(texts: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of all texts, 4-grams before each text (n + 1), and whether it has a letter."""
    c = code_points(texts)
    letter = (c != 0) & (c != _SPACE)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != _SPACE) | (c[:-1] != _SPACE)
    # the place where each text ends: where a run of padding begins, by length, as texts can be empty
    sizes = np.array([len(t.replace("\0", " ").lower()) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + ORDER - 1)
    c, letter = c[keep], letter[keep]
    at = np.concatenate(([0], np.cumsum(keep)))
    ends = at[ends]
    starts = np.concatenate(([at[0]], ends[:-1])) if len(ends) else ends
    c = numbers[c].astype(np.uint64)
    key = c.copy()
    for k in range(1, ORDER):
        key[k:] |= c[:-k] << np.uint64(16 * k)
    real = np.flatnonzero(c != 0)
    upto = np.searchsorted(real, np.concatenate((starts, ends[-1:])) + ORDER - 1) if len(texts) else np.zeros(1, np.int64)
    has = np.concatenate(([0], np.cumsum(letter)))
    any_letter = has[ends + ORDER - 1] - has[starts + ORDER - 1] > 0 if len(texts) else np.zeros(0, bool)
    return key[real], upto, any_letter


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


@dataclass
class CharacterModels:
    """Log probabilities of all languages side by side, in sorted arrays by order."""

    languages: list[str]
    alphabet: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    floor: float = 0.0
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    log_p: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    log_back: dict[int, np.ndarray] = field(default_factory=dict)
    temperature: float = 1.0
    reject_above: float = float("inf")

    def numbers(self) -> np.ndarray:
        if self.__dict__.get("_numbers") is None:
            self._numbers = numbering(self.alphabet)
        return self._numbers

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_numbers"}

    def lookup(self, order: int, keys: np.ndarray) -> np.ndarray:
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.floor, dtype=np.float32)
        keys = keys & _mask(order) if order < ORDER else keys
        table = self.keys[order]
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        out = self.log_p[order][at]
        miss = np.flatnonzero(table[at] != keys)
        if len(miss):
            lower = self.lookup(order - 1, keys[miss])
            context = keys[miss] >> np.uint64(16)
            known = self.contexts[order]
            at = np.minimum(np.searchsorted(known, context), len(known) - 1)
            back = self.log_back[order][at]
            back[known[at] != context] = 0
            out[miss] = lower + back
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of every text and language; whether the text has a letter."""
        keys, upto, letters = grams(texts, self.numbers())
        total = np.zeros((len(keys) + 1, len(self.languages)))
        if len(keys):
            np.cumsum(self.lookup(ORDER, keys), axis=0, out=total[1:], dtype=np.float64)
        return -(total[upto[1:]] - total[upto[:-1]]) / np.maximum(np.diff(upto), 1)[:, None], letters

    def fit(self, key: np.ndarray, language: np.ndarray, count: np.ndarray) -> CharacterModels:
        n_lang = len(self.languages)
        self.floor = -float(np.log(len(np.unique(key & _mask(1))) + 1))
        by_order = {ORDER: (key, language, count.astype(np.float64))}
        for order in range(ORDER - 1, 0, -1):  # continuation counts: different characters to the left
            k, l, _ = by_order[order + 1]
            pair = np.stack((k & _mask(order), l.astype(np.uint64)))
            u, n = np.unique(pair, axis=1, return_counts=True)
            by_order[order] = (u[0], u[1].astype(np.int64), n.astype(np.float64))
        for order in range(1, ORDER + 1):
            k, l, c = by_order[order]
            table, row = np.unique(k, return_inverse=True)
            known, ctx = np.unique(table >> np.uint64(16), return_inverse=True)
            counts = np.zeros((len(table), n_lang))
            counts[row, l] = c
            total, types = np.zeros((len(known), n_lang)), np.zeros((len(known), n_lang))
            np.add.at(total, ctx, counts)
            np.add.at(types, ctx, counts > 0)
            n1, n2 = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
            discount = np.where(n1 + n2 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5)
            discount = np.clip(discount, 0.05, 0.95)
            back = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            lower = np.exp(self.lookup(order - 1, table).astype(np.float64))
            p = np.maximum(counts - discount, 0) / np.maximum(total, 1)[ctx] + back[ctx] * lower
            self.keys[order], self.log_p[order] = table, np.log(p).astype(np.float32)
            self.contexts[order], self.log_back[order] = known, np.log(back).astype(np.float32)
        return self

    def probability(self, h: np.ndarray) -> np.ndarray:
        z = -self.temperature * (h - h.min(axis=1, keepdims=True))
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def _slices(column: pa.Array) -> Iterator[list[str]]:
    texts: list[str] = []
    size = 0
    for t in text_column(column):
        texts.append(t.as_py())
        size += len(texts[-1])
        if size >= _SLICE:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _letters_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters and how often they are there, summed over a slice."""
    for batch in batches:
        for texts in _slices(batch.column(0)):
            letter, n = np.unique(code_points(texts), return_counts=True)
            ok = (letter != 0) & (letter != _SPACE)
            yield pa.RecordBatch.from_arrays([pa.array(letter[ok].astype(np.int32)), pa.array(n[ok].astype(np.int64))], names=["letter", "n"])


def _count(alphabet: np.ndarray):
    """4-grams of each language and how often they are there, summed over a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = numbering(alphabet)
        for batch in batches:
            language = np.array(batch.column(0).to_pylist(), dtype=object)
            for name in sorted(set(language)):
                column = batch.column(1).filter(pa.array(language == name))
                for texts in _slices(column):
                    key, n = np.unique(grams(texts, numbers)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(key)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

    return run


def fit_languages(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> CharacterModels:
    """Models of all values of ``lang`` in rows of (doc_id, text, lang); rows without either are not used."""
    rows = labelled.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").cast("string").alias("lang"), F.col("text").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return CharacterModels([])
    spread = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[x for k, n in sorted(sizes.items()) for x in (F.lit(k), F.lit(min(1.0, per_language / n)))]), F.col("lang"))
    sample = rows.filter(spread < share)
    held = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("held")), F.lit(4)) == 0
    learned = sample.filter(~held).select("lang", "text")
    letters = learned.select("text").mapInArrow(_letters_of, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    alphabet = letters.orderBy(F.desc("n"), "letter").limit(MOST_LETTERS).toPandas()["letter"].to_numpy().astype(np.int64)
    counts = learned.mapInArrow(_count(alphabet), "lang string, key long, n long")
    found = counts.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    names = sorted(set(found["lang"]))
    if not names:
        return CharacterModels([])
    place = {k: i for i, k in enumerate(names)}
    model = CharacterModels(names, alphabet).fit(found["key"].to_numpy().view(np.uint64), found["lang"].map(place).to_numpy(), found["n"].to_numpy())
    sent = labelled.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch.column(1))
            at = 0
            for texts in _slices(column):
                h, letters = sent.value.entropies(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array(list(h), type=pa.list_(pa.float64())), pa.array(letters)], names=["lang", "h", "letters"])
                at += len(texts)

    held_back = sample.filter(held).select("lang", "text").mapInArrow(entropies, "lang string, h array<double>, letters boolean").filter("letters").toPandas()
    held_back = held_back[held_back["lang"].isin(place)]
    if len(held_back):
        h = np.array(held_back["h"].tolist())
        right = held_back["lang"].map(place).to_numpy()
        losses = []
        grid = [2.0 ** k for k in range(-2, 9)]
        for model.temperature in grid:
            losses.append(-np.log(np.maximum(model.probability(h)[np.arange(len(h)), right], 1e-9)).mean())
        model.temperature = grid[int(np.argmin(losses))]
        model.reject_above = float(np.quantile(h[np.arange(len(h)), right], 1 - REJECT_SHARE))
    return model


def predict_language(docs: DataFrame, model: CharacterModels, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and struct ``_language``: ``lang_pred``, ``score`` (calibrated
    probability), ``cross_entropy`` (per character) and ``rejected``."""
    kept = docs.columns if keep is None else keep
    fields = (("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("rejected", "boolean"))
    own = [f"__language_{k}" for k, _ in fields]
    shown = docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(k) for k, (_, t) in zip(own, fields)]).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            rows: list[list] = [[], [], [], []]
            for texts in _slices(cols[text]):
                if not m.languages:
                    found = [(UNKNOWN, 0.0, None, True)] * len(texts)
                else:
                    h, letters = m.entropies(texts)
                    best = h.argmin(axis=1)
                    p = m.probability(h)
                    found = [(m.languages[b], float(q[b]), float(x[b]), bool(x[b] > m.reject_above)) if some else (UNKNOWN, 0.0, None, True)
                             for b, q, x, some in zip(best.tolist(), p, h, letters.tolist())]
                for r, values in zip(rows, zip(*found)):
                    r.extend(values)
            for k, r, kind in zip(own, rows, (pa.string(), pa.float64(), pa.float64(), pa.bool_())):
                cols[k] = pa.array(r, type=kind)
            yield pa.RecordBatch.from_arrays([cols[k] for k in shown.names], names=shown.names)

    out = docs.mapInArrow(run, shown)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(*[F.col(k).alias(c) for k, (c, _) in zip(own, fields)]).alias("_language"))
