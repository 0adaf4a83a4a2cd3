"""Periodic run detection (operator 12) by online dyadic square catching.

Words are appended one by one. For every power of two B the text appended so far is cut into completed
blocks of B words, and each has a catcher that waits for the block's copy at a distance q of 2B-1 to 4B-2
words. Each appended word advances, for every B, the hash of the last B words of the text (the suffix that is
compared), which meets the two catchers in reach. In a run of period q two neighbouring stretches of q words
are equal, so of any 2B-1 <= q of these pairs of words a whole block is caught: no run is missed. Runs of
period 1 to 5 have 12 words at least, so blocks of 4 catch them, and blocks of 2 those of period 6.

A caught block is the core of a square: it is extended to both sides as long as words q apart are the
same, and squares that overlap in q - 1 words merge into one run. Scales come up by rising q; a block inside a
known run whose period divides q is a power of that run's root and is passed over, so every run has
its smallest period.

The appended words of a slice of about 1 MB of texts are advanced together, in numpy; hashes only choose
the blocks to extend, and words are compared exactly, by their numbers in the slice. Memory grows with one
text's length, not with the table; the time is that of log2(n) steps for each word.

Defined results: a null or empty text has no words and no runs; each row is treated by itself, so
repeated rows and null ids do not matter; columns that are kept pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import SLICE_BYTES, mix64, text_column

#: A run has so many words at least, and two periods.
LEAST_WORDS = 12
#: Appended words that are advanced at once.
STEP = 1 << 18

Run = tuple[int, int, int]  # start, length, period


def planted_loop(key: str, n: int) -> tuple[int, int] | None:
    """The rule of the query: first word and period of the loop that a document's words become."""
    h = zlib.crc32(key.encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def _reach(x: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """First and behind the last of the consecutive places around ``i`` whose word is that ``q`` further on."""
    lo, hi, top, step = i, i, len(x) - q, 32
    while hi < top:
        end = min(top, hi + step)
        other = np.flatnonzero(x[hi:end] != x[hi + q:end + q])
        if len(other):
            hi += int(other[0])
            break
        hi, step = end, step * 2
    step = 32
    while lo > 0:
        end = max(0, lo - step)
        other = np.flatnonzero(x[end:lo] != x[end + q:lo + q])
        if len(other):
            lo = end + int(other[-1]) + 1
            break
        lo, step = end, step * 2
    return lo, hi


class Catchers:
    """Catchers of the texts of a slice, whose words are appended together."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray) -> None:
        self.words, self.offsets = words, offsets
        self.runs: dict[int, list[Run]] = defaultdict(list)

    def advance(self) -> dict[int, list[Run]]:
        """Runs (start, length, period) of each text that has any, by start and period."""
        lens = np.diff(self.offsets)
        texts = np.flatnonzero(lens >= LEAST_WORDS)
        if not len(texts):
            return {}
        power, size = np.array([0x9E6C63D0876A9A35], dtype=np.uint64), 1
        suffix = mix64(self.words.astype(np.uint64) + np.uint64(1))  # hash of the ``size`` words from each place on
        while True:
            # size 2 and 4 also see the short periods; then all distances of one size
            if size == 2:
                pairs = suffix
            if size == 4:
                self._short(pairs, suffix, texts)
            if size >= 4:
                texts = texts[lens[texts] >= 2 * (2 * size - 1)]
                if not len(texts):
                    break
                self._long(suffix, size, texts)
            longer = suffix.copy()
            longer *= power
            longer[:-size] += suffix[size:]
            suffix, power, size = longer, power * power, 2 * size
        return {t: sorted(found) for t, found in self.runs.items() if found}

    def _short(self, pairs: np.ndarray, fours: np.ndarray, texts: np.ndarray) -> None:
        for q, size, hashes in [*((q, 4, fours) for q in range(1, 6)), (6, 2, pairs)]:
            for place, text, rel in self._places(texts, size):
                first = rel - q
                hit = (first >= 0) & (first & (size - 1) == 0)
                at = np.flatnonzero(hit)
                at = at[hashes[place[at]] == hashes[place[at] - q]]
                self._extend(text[at], np.full(len(at), q), first[at], size)

    def _long(self, hashes: np.ndarray, size: int, texts: np.ndarray) -> None:
        caught: list[tuple[np.ndarray, ...]] = []
        for place, text, rel in self._places(texts, size):
            nearest = (rel - (2 * size - 1)) & -size  # start of the last block in reach
            own = hashes[place]
            for first in (nearest, nearest - size):
                back = place - (rel - first)
                at = np.flatnonzero((first >= 0) & (own == hashes[back]))
                if len(at):
                    caught.append((text[at], (rel - first)[at], first[at]))
        if caught:
            self._extend(*[np.concatenate(c) for c in zip(*caught)], size)

    def _places(self, texts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in the slice, text, place in the text) of all suffixes of ``size`` words; a long text in steps."""
        begins = self.offsets[texts]
        sizes = self.offsets[texts + 1] - begins - size + 1
        small = sizes < STEP
        if small.any():
            n, upto = sizes[small], np.cumsum(sizes[small])
            rel = np.arange(int(upto[-1])) - np.repeat(upto - n, n)
            yield rel + np.repeat(begins[small], n), np.repeat(texts[small], n), rel
        for t, begin, n in zip(texts[~small], begins[~small], sizes[~small].tolist()):
            for lo in range(0, n, STEP):
                rel = np.arange(lo, min(lo + STEP, n))
                yield begin + rel, np.full(len(rel), t), rel

    def _extend(self, text: np.ndarray, q: np.ndarray, first: np.ndarray, size: int) -> None:
        """Extend caught blocks to runs; neighbouring blocks with the same distance are parts of one stretch."""
        if not len(text):
            return
        order = np.lexsort((first, q, text))
        text, q, first = text[order], q[order], first[order]
        new = np.ones(len(text), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (q[1:] != q[:-1]) | (first[1:] != first[:-1] + size)
        for t, d, s in zip(text[new].tolist(), q[new].tolist(), first[new].tolist()):
            known = self.runs[t]
            if any(d % p == 0 and a <= s and s + d + size <= a + n for a, n, p in known):
                continue
            x = self.words[self.offsets[t]:self.offsets[t + 1]]
            lo, hi = _reach(x, s, d)
            if hi > s and hi - lo >= max(d, LEAST_WORDS - d):
                known.append((lo, hi - lo + d, d))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words are in no run behind its first period."""
    keep = np.ones(n, dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return keep


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a column in slices of about 1 MB: (first row, texts)."""
    at = 0
    while at < len(column):
        end, size = at, 0
        while end < len(column) and size < SLICE_BYTES:
            size += len(column[end].as_py())
            end += 1
        yield at, column.slice(at, end - at).to_pylist()
        at = end


def _scan(text: str, key: str, names: list[str], loop: Callable[[str, int], tuple[int, int] | None] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            keys = cols[key].to_pylist()
            for at, texts in _texts(text_column(cols[text])):
                found, kept = _find(texts, keys[at:at + len(texts)], loop)
                own = {k: c.slice(at, len(texts)) for k, c in cols.items()}
                own["__runs"] = pa.array([[{"start": a, "length": n, "period": p} for a, n, p in r] for r in found], type=_RUNS)
                own["__kept"] = pa.array(kept, type=pa.string())
                yield pa.RecordBatch.from_arrays([own[k] for k in names], names=names)
    return run


def _find(texts: list[str], keys: list[str | None], loop) -> tuple[list[list[Run]], list[str]]:
    """Runs of each text, and its words outside their repetitions joined by single spaces."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    split, numbers = [], []
    for t, k in zip(texts, keys):
        words = t.encode().split()  # by the six ASCII white-space characters
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        if loop is not None and (found := loop(k or "", len(words))):
            first, period = found
            place = np.arange(len(words))
            place[first:] = first + (place[first:] - first) % period
            ids = ids[place]
            words = [words[i] for i in place.tolist()]
        split.append(words)
        numbers.append(ids)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    runs = Catchers(np.concatenate([*numbers, np.zeros(0, np.int64)]), offsets).advance()
    out = [runs.get(i, []) for i in range(len(texts))]
    kept = [b" ".join([w for w, k in zip(words, kept_words(len(words), r)) if k] if r else words).decode() for words, r in zip(split, out)]
    return out, kept


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: list[str] | None = None,
              loop: Callable[[str, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if None) and struct ``_periodic``: ``runs`` (start, length, period; by
    start and period) and ``collapsed``, the text without the repetitions.

    ``loop`` gives, for a row's ``key`` as text and its number of words, the first word and the period of a
    loop that its words are first rewritten to (or None)."""
    kept = docs.columns if keep is None else keep
    own = ["__text", "__key", "__runs", "__kept"]
    shown = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>").alias(own[2]),
                        F.lit(None).cast("string").alias(own[3])).schema
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(own[0]), F.col(f"`{key}`").cast("string").alias(own[1]))
    out = rows.mapInArrow(_scan(own[0], own[1], shown.names, loop), shown)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(F.col(own[2]).alias("runs"), F.col(own[3]).alias("collapsed")).alias("_periodic"))
