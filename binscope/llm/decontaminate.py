"""Benchmark decontamination (operator 1): suffix arrays of training shards.

Rows of an Arrow batch, about ``SHARD_BYTES`` of text, are one shard: its memory does not grow
with the batch. Its words become token ids of the
benchmark's vocabulary (0: not in it), and a suffix array is built over the
positions where a benchmark window could begin. Every test suffix is then
binary-searched in it: the range of equal suffixes gives the locations, and
each is extended word by word to the longest verbatim match.

No document is shuffled. The distinct benchmark items go to the tasks in blocks of a fixed text
size, one narrow pass over the documents per block, so what is sent at once has
a bound, however large the benchmark is and however often it repeats an item.

Defined results: null and empty texts have no words; an item without words has
no windows; repeated items count once per distinct id; an item whose id is null
marks words but is not listed; repeated document rows each get their own row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import ALNUM, SLICE_BYTES, SMALL_SLICE_BYTES, giving_back, slices, words

WINDOW = 10
#: Text bytes of the benchmark that are sent to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Text bytes of a shard; at least twice those of the block, as each of its suffixes is searched in every shard.
SHARD_BYTES = SLICE_BYTES

#: What a pass adds to; the names are the pass's own and are gone from its result.
_STATE = (("__leak_n_words", "long"), ("__leak_spans", "array<struct<start:long,end:long>>"),
          ("__leak_items", "array<string>"),
          ("__leak_longest", "struct<item_id:string,item_word:long,doc_word:long,n_words:long>"))


class TestSuffixes:
    """Token ids and suffixes of one block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        col = pa.array([t for _, t in items], type=pa.string())
        hashes, item_of = [], []
        for lo, _, buf, offs in slices(col):
            _, _, h, upto = words(buf, offs, ALNUM, lower=True)
            hashes.append(h)
            item_of.append(np.repeat(np.arange(len(offs) - 1) + lo, np.diff(upto)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        item_of = np.concatenate(item_of) if item_of else np.zeros(0, np.int64)
        self.vocabulary = np.unique(h)
        ids = np.searchsorted(self.vocabulary, h) + 1
        n = np.bincount(item_of, minlength=len(items)) if len(items) else np.zeros(0, np.int64)
        first = np.cumsum(n) - n
        # a 0 behind every item ends its suffixes
        at = np.arange(len(ids)) + item_of
        self.tokens = np.zeros(len(ids) + len(items), dtype=np.int64)
        self.tokens[at] = ids
        within = np.arange(len(ids)) - first[item_of]
        need = np.minimum(n[item_of], window)
        ok = within + need <= n[item_of]
        self.start, self.need = at[ok], need[ok]
        self.item, self.within = item_of[ok], within[ok]
        self.left = n[self.item] - self.within
        self.item_ids = [i for i, _ in items]
        self.shard_bytes = max(SHARD_BYTES, 2 * sum(len(t.encode()) for _, t in items if t))
        self.longest = int(n.max()) if len(n) else 0
        self.least = int(self.need.min()) if len(self.need) else 0


def token_ids(vocabulary: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(len(h), dtype=np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return np.where(vocabulary[at] == h, at + 1, 0)


def suffix_array(tokens: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` ordered by the suffixes that begin there, compared on ``depth`` tokens at most.

    Multikey quicksort, vectorised: one token is the key of a round, suffixes
    that it tells apart are done, and the next round sorts only inside ties.
    ``tokens`` must end with a 0; a suffix ends at its first 0.
    """
    order = starts.copy()
    rank = np.zeros(len(order), dtype=np.int64)  # first place of each one's tie
    open_ = np.arange(len(order))
    for d in range(depth):
        if not len(open_):
            break
        key = tokens[np.minimum(order[open_] + d, len(tokens) - 1)]
        by = np.lexsort((key, rank[open_]))
        order[open_] = order[open_][by]
        key, tie = key[by], rank[open_]
        new = np.ones(len(open_), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1])
        group = np.cumsum(new) - 1
        rank[open_] = open_[new][group]
        size = np.bincount(group)
        open_ = open_[(size[group] > 1) & (key > 0)]
    return order


def _search(tokens: np.ndarray, order: np.ndarray, test: np.ndarray, start: np.ndarray,
            need: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of test suffixes' first ``need`` tokens: the first place not before
    (``after``: the first place beyond) the suffixes that begin with them."""
    first = tokens[order]
    lo, hi = (np.searchsorted(first, test[start], side) for side in ("left", "right"))
    while (todo := np.flatnonzero(lo < hi)).size:
        mid = (lo[todo] + hi[todo]) // 2
        at = order[mid]
        less = np.zeros(len(todo), dtype=bool)
        same = np.ones(len(todo), dtype=bool)
        for d in range(int(need[todo].max())):
            live = np.flatnonzero(same & (need[todo] > d))
            if not live.size:
                break
            a = tokens[np.minimum(at[live] + d, len(tokens) - 1)]
            b = test[start[todo[live]] + d]
            less[live] = a < b
            same[live] = a == b
        up = less | same if after else less
        lo[todo] = np.where(up, mid + 1, lo[todo])
        hi[todo] = np.where(up, hi[todo], mid)
    return lo


def find_matches(tokens: np.ndarray, test: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places where a test window occurs: (test suffix, place, words matched from there)."""
    none = np.zeros(0, dtype=np.int64)
    if not len(test.start) or not len(tokens):
        return none, none, none
    zero = np.where(tokens == 0, np.arange(len(tokens)), len(tokens))
    until = np.minimum.accumulate(zero[::-1])[::-1] - np.arange(len(tokens))
    starts = np.flatnonzero(until >= test.least)
    if not len(starts):
        return none, none, none
    order = suffix_array(tokens, starts, test.longest)
    lo = _search(tokens, order, test.tokens, test.start, test.need, after=False)
    hi = _search(tokens, order, test.tokens, test.start, test.need, after=True)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    place = order[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)]
    length = test.need[which].copy()
    grow = np.flatnonzero(length < test.left[which])
    while grow.size:
        p = place[grow] + length[grow]
        same = (p < len(tokens)) & (tokens[np.minimum(p, len(tokens) - 1)] == test.tokens[test.start[which[grow]] + length[grow]])
        grow = grow[same]
        length[grow] += 1
        grow = grow[length[grow] < test.left[which[grow]]]
    return which, place, length


def _batch(column: pa.Array, test: TestSuffixes) -> list[list]:
    """n_words, spans, items and longest match of every text of one batch, shard by shard."""
    out: list[list] = [[], [], [], []]
    for lo, hi, _, _ in slices(column, test.shard_bytes):
        for part, x in zip(out, _shard(column.slice(lo, hi - lo), test)):
            part += x
    return out


def _shard(column: pa.Array, test: TestSuffixes) -> list[list]:
    """What ``_batch`` gives, of the texts of one shard."""
    parts, n_words = [], []
    for _, _, buf, offs in slices(column, SMALL_SLICE_BYTES):
        _, _, h, upto = words(buf, offs, ALNUM, lower=True)
        ids = np.zeros(len(h) + len(offs) - 1, dtype=np.int64)  # a 0 behind every document
        ids[np.arange(len(h)) + np.repeat(np.arange(len(offs) - 1), np.diff(upto))] = token_ids(test.vocabulary, h)
        parts.append(ids)
        n_words.append(np.diff(upto))
    n_words = np.concatenate(n_words) if n_words else np.zeros(0, dtype=np.int64)
    tokens = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    base = np.cumsum(n_words + 1) - (n_words + 1)
    which, place, length = find_matches(tokens, test)
    spans: list = [[] for _ in n_words]
    items: list = [[] for _ in n_words]
    best: list = [None for _ in n_words]
    if len(which):
        edge = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + test.need[which], -1)
        hit = np.cumsum(edge) > 0
        turn = np.flatnonzero(np.diff(np.concatenate(([False], hit))))
        doc = np.searchsorted(base, turn[::2], "right") - 1
        for d, a, b in zip(doc.tolist(), turn[::2].tolist(), turn[1::2].tolist()):
            spans[d].append({"start": a - int(base[d]), "end": b - int(base[d])})
        doc = np.searchsorted(base, place, "right") - 1
        pair = np.unique(np.stack((doc, test.item[which])), axis=1)
        for d, i in pair.T.tolist():
            if test.item_ids[i] is not None:
                items[d].append(test.item_ids[i])
        rank = np.lexsort((test.within[which], test.item[which], place, -length, doc))
        keep = rank[np.flatnonzero(np.diff(np.concatenate(([-1], doc[rank]))))]
        for d, k in zip(doc[keep].tolist(), keep.tolist()):
            best[d] = {"item_id": test.item_ids[test.item[which[k]]], "item_word": int(test.within[which[k]]),
                       "doc_word": int(place[k] - base[d]), "n_words": int(length[k])}
    return [n_words.tolist(), spans, items, best]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
                       keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if None) and struct column ``_leak``: ``n_words``, ``spans``
    (word ranges inside benchmark windows, merged), ``items`` (distinct ids) and ``longest`` (the
    longest verbatim match and its place)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).filter(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-int(total) // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    kept = docs.columns if keep is None else keep
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.lit(None).cast(t).alias(k) for k, t in _STATE])
    for b in range(n_blocks):
        rows = sorted(((r[0], r[1]) for r in items.filter(block == b).collect()), key=lambda r: (r[0] is None, *map(str, r)))  # one block: bounded
        sent = spark.sparkContext.broadcast(TestSuffixes(rows, window))
        if b == n_blocks - 1:
            shown = out.select(*[F.col(f"`{c}`") for c in kept], *[k for k, _ in _STATE]).schema
        else:
            shown = out.schema
        out = out.mapInArrow(giving_back(_scan(sent, text, window, shown.names)), shown)
    n, spans, found, longest = (F.col(k) for k, _ in _STATE)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(
        n.alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(found)).alias("items"),
        longest.alias("longest")).alias("_leak"))


def _scan(sent, text: str, window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            n_words, spans, items, longest = _batch(cols[text], sent.value)
            names_of = [k for k, _ in _STATE]
            had = [cols[k].to_pylist() for k in names_of[1:]]
            new = (n_words, [_union(a or [], v) for a, v in zip(had[0], spans)],
                   [(a or []) + v for a, v in zip(had[1], items)],
                   [v if a is None or (v and v["n_words"] > a["n_words"]) else a for a, v in zip(had[2], longest)])
            for k, v in zip(names_of, new):
                cols[k] = pa.array(v, type=cols[k].type)
            yield pa.RecordBatch.from_arrays([cols[k] for k in names], names=names)

    return run


def _union(a: list[dict], b: list[dict]) -> list[dict]:
    """Merged word ranges of both lists."""
    out: list[dict] = []
    for s in sorted(a + b, key=lambda x: (x["start"], x["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns unchanged."""
    found = find_contamination(docs, benchmark, window=window)
    return found.filter(F.size(F.col("_leak.spans")) == 0).select(*[f"`{c}`" for c in docs.columns])
