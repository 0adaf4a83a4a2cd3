"""LM scoring (operator 3): a word trigram model in sharded Elias-Fano tries.

Unigrams are complete: the probability of a token is (c + 1) / (N + V + 1). Above
them stand all bigrams and trigrams, of all words, that are ``LEAST_COUNT`` times in
the training texts, with absolute discounting: P(w|h) = max(q(c) - D, 0) / c(h) +
back(h) P(w|h'), where q is the one-byte quantisation of ``quantise`` (it rounds down)
and back(h) takes what discounts, rounding and n-grams seen less often leave, so that
the probabilities of a context sum to one. Counts are exact, over all training texts,
and the model grows with them.

Texts are tokenised once, where they are read, into blocks of about ``BLOCK_BYTES`` that
are written. Nothing of the model is sent anywhere whole: each block sends its words
to shards of words, which add up and answer with the words' ids (the more frequent, the
smaller) and counts. Then it sends its distinct n-grams with their counts to shards of
contexts; a shard adds up, builds its trie, memory-mapped, and answers every block for
what it sent with one-byte codes and the sums of contexts, by which the block is scored.
An n-gram with a word that is in the training texts less than LEAST_COUNT times cannot
be kept: its word is sent as none. The contexts before a word that is there more than
``SPLIT`` times are spread over shards by the word before it, and the successors of a
context whose words are all that frequent over shards that are all asked, and their sums
add up. There are as many shards as blocks, and a message for each pair of them.

Trie: a first level of words, under each its successors and its predecessors (the
contexts of trigrams), under each predecessor the third words as ranks among the
successors. Ranges are pointers, and the words of ranges, made monotone by adding the
last value before them, successors to be searched for; all in Elias-Fano code.

Defined results: null is an empty text (one end token); a null id counts as an empty
text in the fold; with no training texts N = V = 0; repeated rows count and are
scored each. Words are known by a 64-bit hash.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import NONSPACE, give_back, giving_back, mix64, slices, words
from binscope.session import cut_lineage

LEAST_COUNT = 2
BLOCK_BYTES = 8 << 20
#: Occurrences of a word beyond which what stands under it is spread over shards.
SPLIT = 1 << 20

END = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Codes up to EXACT are the counts themselves, then there are eight to an octave.
EXACT = 16
VALUES = np.concatenate((np.arange(EXACT + 1), np.floor(EXACT * 2.0 ** (np.arange(1, 256 - EXACT) / 8)))).astype(np.int64)


def quantise(n: np.ndarray) -> np.ndarray:
    """The code of the greatest of ``VALUES`` that is not above the count."""
    return (np.searchsorted(VALUES, n, "right") - 1).astype(np.uint8)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary with a directory of ones."""

    BLOCK = 8

    def __init__(self, values: np.ndarray) -> None:
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.l = min(56, max(0, (top // max(1, self.n)).bit_length() - 1))
        bit = np.arange(self.l, dtype=np.uint64)
        packed = [np.packbits(((part[:, None] >> bit) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
                  for part in np.split(values, range(1 << 15, self.n, 1 << 15))]
        self.low = np.concatenate((*packed, np.zeros(8, np.uint8)))
        high = (values >> np.uint64(self.l)).astype(np.int64) + np.arange(self.n)
        size = (int(high[-1]) + 1 if self.n else 0)
        size += -size % (8 * self.BLOCK) or 8 * self.BLOCK
        unary = np.zeros(size, dtype=np.uint8)
        unary[high] = 1
        self.high = np.packbits(unary, bitorder="little")
        ones = _ONES[self.high].reshape(-1, self.BLOCK).sum(axis=1)
        self.before = np.concatenate(([0], np.cumsum(ones)))[:-1].astype(np.uint32)

    def arrays(self) -> list[str]:
        return ["low", "high", "before"]

    def span(self, lo: int, hi: int) -> np.ndarray:
        """The values at ``lo`` to ``hi``, by one scan of their bits."""
        if lo >= hi:
            return np.zeros(0, dtype=np.int64)
        first, end = int(np.searchsorted(self.before, lo, "right")) - 1, int(np.searchsorted(self.before, hi))
        ones = np.flatnonzero(np.unpackbits(self.high[first * self.BLOCK:end * self.BLOCK], bitorder="little"))
        i = np.arange(lo, hi)
        high = ones[lo - int(self.before[first]):][:hi - lo] + first * self.BLOCK * 8 - i
        i *= self.l
        return (high << self.l) | self._low(i)

    def _low(self, bit: np.ndarray) -> np.ndarray:
        wide = np.ndarray(len(self.low) - 7, dtype="<u8", buffer=self.low, strides=(1,))
        return ((wide[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        if len(i) and _dense(lo := int(i.min()), hi := int(i.max()) + 1, len(i)):
            return self.span(lo, hi)[i - lo]
        block = np.searchsorted(self.before, i.astype(np.uint32), "right") - 1
        left = i - self.before[block].astype(np.int64)
        body = self.high.reshape(-1, self.BLOCK)[block]
        upto = np.cumsum(_ONES[body], axis=1)
        at = (upto > left[:, None]).argmax(axis=1)
        own = np.arange(len(i))
        byte = body[own, at]
        place = (block * self.BLOCK + at) * 8 + _SELECT[byte, left - (upto[own, at] - _ONES[byte])]
        return ((place - i) << self.l) | self._low(i * self.l)


def _dense(lo: int, hi: int, n: int) -> bool:
    """Whether ``n`` places between two bounds are found faster by a scan than each by itself."""
    return hi - lo <= 4 * n


_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)
_SELECT = np.zeros((256, 8), dtype=np.int64)
for _b in range(256):
    _places = [k for k in range(8) if _b >> k & 1]
    _SELECT[_b, :len(_places)] = _places


def _monotone(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Increasing positive values in each range, made increasing over all: plus the value before the range."""
    last = np.where(bounds[1:] > bounds[:-1], values[np.maximum(bounds[1:], 1) - 1] if len(values) else 0, 0)
    base = np.cumsum(last) - last
    return values + np.repeat(base, np.diff(bounds))


class Level:
    """Ranges of increasing numbers: pointers to the ranges, and the numbers."""

    def __init__(self, bounds: np.ndarray, numbers: np.ndarray) -> None:
        self.pointer, self.numbers = EliasFano(bounds), EliasFano(_monotone(numbers + 1, bounds))

    def find(self, node: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of ``number`` in the range of ``node``, or -1, and where that range begins.

        What is asked of one node in a row reads its pointers once; numbers that are close together are scanned."""
        if not len(node):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        new = _changes(node)
        own = node[new]
        start, end = self.pointer[own], self.pointer[own + 1]
        base = np.ones(len(own), dtype=np.int64)
        some = np.flatnonzero(start > 0)
        base[some] += self.numbers[start[some] - 1]
        least, most = int(start.min()), int(end.max())
        at = np.cumsum(new) - 1
        start, end, target = start[at], end[at], number + base[at]
        if _dense(least, most, len(node)):
            values = self.numbers.span(least, most)
            lo = np.searchsorted(values, target)
            hit = lo + least < end
            hit[hit] = values[lo[hit]] == target[hit]
            return np.where(hit, lo + least, -1), start
        lo, hi = start.copy(), end.copy()
        while (todo := np.flatnonzero(lo < hi)).size:  # the first value that is not less
            mid = (lo[todo] + hi[todo]) // 2
            less = self.numbers[mid] < target[todo]
            lo[todo] = np.where(less, mid + 1, lo[todo])
            hi[todo] = np.where(less, hi[todo], mid)
        out = np.full(len(node), -1, dtype=np.int64)
        inside = np.flatnonzero(lo < end)
        hit = inside[self.numbers[lo[inside]] == target[inside]]
        out[hit] = lo[hit]
        return out, start


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _ranks(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the place of every row's key in them; keys are below ``top``.

    Where there is room, rows are numbered in the low bits of the keys: plain numbers sort several times faster than places."""
    low = len(key).bit_length()
    if int(top).bit_length() + low > 63:
        return np.unique(key, return_inverse=True)
    x = key << low
    x |= np.arange(len(key))
    x.sort()
    row = (x & ((1 << low) - 1)).astype(np.int32 if low < 32 else np.int64)
    x >>= low
    new = _changes(x)
    x = x[new]
    at = np.cumsum(new, dtype=row.dtype)
    at -= 1
    place = np.empty_like(row)
    place[row] = at
    return x, place.astype(np.int64)


def _before(group: np.ndarray, n: int) -> np.ndarray:
    """Bounds of ``n`` groups in their sorted numbers."""
    return np.searchsorted(group, np.arange(n + 1))


class Trie:
    """The kept bigrams (b, w) or trigrams (a, b, w), in order of b, a, w; ``a`` is None for bigrams."""

    def __init__(self, b: np.ndarray, a: np.ndarray | None, w: np.ndarray, n: np.ndarray) -> None:
        new = _changes(b)
        self.firsts, node = b[new], np.cumsum(new) - 1
        if a is None:
            self.successors = Level(_before(node, len(self.firsts)), w)
        else:
            wide = _bits(w)
            own, rank = _ranks((node << wide) | w, len(self.firsts) << wide)
            bounds = _before(own >> wide, len(self.firsts))
            self.successors = Level(bounds, own & ((1 << wide) - 1))
            rank -= bounds[node]
            context = _changes(node, a)
            self.predecessors = Level(_before(node[context], len(self.firsts)), a[context])
            self.thirds = Level(_before(np.cumsum(context) - 1, int(context.sum())), rank)
        self.trigrams = a is not None
        self.code = quantise(n)

    def codes(self, b: np.ndarray, a: np.ndarray | None, w: np.ndarray) -> np.ndarray:
        """The codes of n-grams, 0 for those that are not kept."""
        out = np.zeros(len(b), dtype=np.uint8)
        if not len(self.firsts):
            return out
        for lo in range(0, len(b), 1 << 18):
            node = np.minimum(np.searchsorted(self.firsts, b[lo:lo + (1 << 18)]), len(self.firsts) - 1)
            todo = lo + np.flatnonzero(self.firsts[node] == b[lo:lo + (1 << 18)])
            node = node[todo - lo]
            at, start = self.successors.find(node, w[todo])
            if self.trigrams:
                two = np.flatnonzero(at >= 0)
                todo, rank = todo[two], (at - start)[two]
                context, _ = self.predecessors.find(node[two], a[todo])
                there = np.flatnonzero(context >= 0)
                todo = todo[there]
                at, _ = self.thirds.find(context[there], rank[there])
            out[todo[at >= 0]] = self.code[at[at >= 0]]
        return out

    def mapped(self) -> Trie:
        """The same trie with its levels in a memory-mapped temporary file that has no name."""
        levels = [self.successors, *((self.predecessors, self.thirds) if self.trigrams else ())]
        holders = [(self, "firsts"), (self, "code")] + [(e, k) for x in levels for e in (x.pointer, x.numbers) for k in e.arrays()]
        with tempfile.TemporaryFile() as f:
            places = []
            for holder, name in holders:
                x = getattr(holder, name)
                f.write(b"\0" * (-f.tell() % 8))
                places.append((f.tell(), x.dtype, len(x)))
                f.write(np.ascontiguousarray(x).tobytes())
            f.write(b"\0" * 8)
            f.flush()
            whole = np.memmap(f, dtype=np.uint8, mode="r")
        for (holder, name), (at, kind, n) in zip(holders, places):
            setattr(holder, name, whole[at:at + n * kind.itemsize].view(kind))
        return self


def _tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with the end token behind every text, and the number of tokens of each text."""
    _, _, h, upto = words(buf, offs, NONSPACE, lower=True)
    rows = np.arange(len(offs) - 1)
    out = np.full(len(h) + len(rows), END, dtype=np.uint64)
    out[np.arange(len(h)) + np.repeat(rows, np.diff(upto))] = h
    return out, np.diff(upto) + 1


def _contexts(upto: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids one and two tokens before, in the same text; -1 if there is none."""
    one, two = np.full(len(ids), -1, dtype=ids.dtype), np.full(len(ids), -1, dtype=ids.dtype)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    first = upto[:-1]
    one[first] = -1
    two[first] = -1
    second = first + 1
    two[second[second < len(ids)]] = -1
    return one, two


def _bits(x: np.ndarray) -> int:
    """Bits of the largest of some numbers, none of them negative."""
    return int(x.max()).bit_length() if len(x) else 0


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, each as all first bytes, then all second ones and so on as far as there are any, compressed."""
    head, planes = [], []
    for x in arrays:
        wide = -(-_bits(x) // 8)
        head += [len(x), wide]
        planes += [(x >> x.dtype.type(8 * k)).astype(np.uint8) for k in range(wide)]
    body = np.concatenate(planes) if planes else np.zeros(0, np.uint8)
    return np.array(head, dtype=np.int64).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(x: bytes, arrays: int) -> list[np.ndarray]:
    head = np.frombuffer(x, dtype=np.int64, count=2 * arrays).reshape(-1, 2)
    planes = np.frombuffer(pa.decompress(x[head.nbytes:], int(head.prod(axis=1).sum()), codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for n, wide in head.tolist():
        own = np.zeros((n, 8), dtype=np.uint8)
        for k in range(wide):
            own[:, k] = planes[at:at + n]
            at += n
        out.append(own.view(np.int64).ravel())
    return out


def _clean(run: Callable[..., pa.Table], tables: int) -> Callable[..., pa.Table]:
    """``run`` over a group of one table or two, then ``give_back``: workers are reused, and what a group took
    would else stay with its worker."""
    def work(*given: pa.Table) -> pa.Table:
        try:
            return run(*given)
        finally:
            give_back()

    return (lambda table: work(table)) if tables == 1 else (lambda table, known: work(table, known))  # Spark counts arguments


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], type=k.type) for i, k in enumerate(schema)], schema=schema)


_BLOCK = "block long, doc_id array<{}>, held_out array<boolean>, words binary, tokens binary"


def _deal(block_bytes: int):
    """Tokenise the texts of a partition into blocks: distinct words, how often each is in training
    texts, and the tokens as places in the words."""

    def close(number: int, ids: list, held: list, sizes: list, hashes: list) -> pa.RecordBatch:
        tokens, size, doc, out = np.concatenate(hashes), np.concatenate(sizes), pa.concat_arrays(ids), pa.concat_arrays(held)
        coded = pa.array(tokens).dictionary_encode()
        word, place = np.unique(coded.dictionary.to_numpy(), return_inverse=True)
        at = place[coded.indices.to_numpy()]
        train = np.repeat(~out.to_numpy(zero_copy_only=False), size)
        n = np.bincount(at, weights=train, minlength=len(word)).astype(np.int64)
        one = [np.array([0, len(doc)], dtype=np.int32)] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(one[0], doc), pa.ListArray.from_arrays(one[1], out),
             *[pa.array([_pack(*x)], pa.binary()) for x in ((word, n), (size, at))]],
            names=["block", "doc_id", "held_out", "words", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts: tuple[list, ...] = ([], [], [], [])
        held = 0
        for batch in batches:
            for lo, hi, buf, offs in slices(batch.column("text")):
                tokens, size = _tokens(buf, offs)
                for part, x in zip(parts, (batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), size, tokens)):
                    part.append(x)
                held += len(buf) + hi - lo
                if held >= block_bytes:
                    yield close(number, *parts)
                    parts, held, number = ([], [], [], []), 0, number + 1
        if parts[0]:
            yield close(number, *parts)

    return run


_WORDS = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("words", pa.binary())])


def _ask_words(n_shards: int):
    """The words of a block with their counts, to shards by ranges of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                word, n = _unpack(packed, 2)
                word = word.view(np.uint64)
                cuts = np.searchsorted((word >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32), np.arange(n_shards + 1).astype(np.uint64))
                rows = [(s, block, _pack(word[cuts[s]:cuts[s + 1]], n[cuts[s]:cuts[s + 1]])) for s in np.flatnonzero(np.diff(cuts)).tolist()]
                yield from _table(rows, _WORDS).to_batches()

    return run


def _add_words(n_shards: int):
    """Counts of a shard's words, and their ids: one of every ``n_shards`` numbers, by falling count."""

    def run(table: pa.Table) -> pa.Table:
        asked, counts = zip(*[_unpack(x, 2) for x in table.column("words").to_pylist()])
        word, at = np.unique(np.concatenate(asked).view(np.uint64), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate(counts), minlength=len(word)).astype(np.int64)
        number = np.empty(len(word), dtype=np.int64)
        number[np.argsort(-c, kind="stable")] = np.arange(len(word)) * n_shards + table.column("shard")[0].as_py()
        parts = np.split(at, np.cumsum([len(x) for x in asked])[:-1])
        first = np.arange(len(parts)) == 0
        return pa.table([table.column("block"), pa.array(np.ones(len(parts), np.int32)), table.column("shard"),
                         pa.array(np.where(first, c.sum(), 0)), pa.array(np.where(first, (c > 0).sum(), 0)),
                         pa.array([_pack(number[x], c[x]) for x in parts], pa.binary())],
                        names=["block", "order", "shard", "x", "y", "answer"])

    return run


#: What shards answer. Words: ids and counts, x = N and y = V of the shard (in one row).
#: N-grams: codes, and sums of contexts; x n-grams that are there once, y that are there twice.
_ANSWER = "block long, order int, shard int, x long, y long, answer binary"


class _Grams:
    """Distinct n-grams of one order of a block, in order of shard, context and word."""

    def __init__(self, block: _Block, order: int, n_shards: int, split_at: int) -> None:
        v, gid, c = len(block.gid), block.gid, block.c
        often = c >= LEAST_COUNT
        there = block.b >= 0 if order == 2 else block.a >= 0
        ok = there & often[block.b]
        if order == 3:
            ok &= often[block.a]
        self.once = int((there & ~ok & block.train).sum())
        self.tokens = np.flatnonzero(ok)
        w, b = block.ids[self.tokens], block.b[self.tokens]
        a = block.a[self.tokens] if order == 3 else np.zeros(len(b), np.int32)
        w = np.where(often, np.arange(v, dtype=np.int32), np.int32(v))[w]
        n = block.train[self.tokens]
        mixed = mix64((np.append(gid, 0) + 1).view(np.uint64))
        shard = (mix64(mixed[:v]) % np.uint64(n_shards)).astype(np.int64)  # of what stands under a word that is not spread
        spread = -(-c // split_at)
        rows = np.flatnonzero((spread > 1)[b]) if (spread > 1).any() else np.zeros(0, np.int64)
        to = np.zeros(0, np.uint64)
        if len(rows):
            far = spread[b[rows]]
            parts = far if order == 2 else np.minimum(spread[a[rows]], far)
            salt = np.where(w[rows] < v, mixed[w[rows]] % np.maximum(parts, 1).astype(np.uint64), 0).astype(np.uint64)
            split = np.flatnonzero(parts > 1)
            if len(split):  # every part of a context is asked, for its sums
                at = rows[split]
                _, first = np.unique(a[at] * np.int64(v) + b[at], return_index=True)
                times = parts[split[first]]
                more = np.repeat(at[first], times)
                rows = np.append(rows, np.arange(len(w), len(w) + len(more)))
                a, b, w = np.append(a, a[more]), np.append(b, b[more]), np.append(w, np.full(len(more), v, np.int32))
                salt = np.append(salt, np.concatenate([np.arange(k, dtype=np.uint64) for k in times]))
                n = np.append(n, np.zeros(len(more), bool))
            to = mixed[b[rows]] + salt * _STEP
            if order == 3:
                to += mixed[a[rows]] % spread[b[rows]].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        # Shards and words before, numbered together.
        usual = shard * v + np.arange(v)
        other = (mix64(to) % np.uint64(n_shards)).astype(np.int64) * v + b[rows]
        heads, at = _ranks(np.concatenate((usual, other)), n_shards * v)
        head = at[:v][b]
        head[rows] = at[v:]
        wide, last = v.bit_length(), (1 << v.bit_length()) - 1
        if order == 3:
            key, at = _ranks((head << wide) | a, len(heads) << wide)
            gram, self.gram = _ranks((at << wide) | w, len(key) << wide)
            self.context = gram >> wide
        else:
            gram, self.gram = _ranks((head << wide) | w, len(heads) << wide)
            new = _changes(gram >> wide)
            self.context = np.cumsum(new) - 1
            key = (gram[new] >> wide) << wide
        #: Parts of one context have one number, if there are any.
        self.whole = _ranks((heads[key >> wide] % max(v, 1) << wide) | (key & last), v << wide)[1] if len(rows) else None
        self.train, self.places = self.gram[n], (gram & last, heads[key >> wide], key & last)
        self.gram = self.gram[:len(self.tokens)]

    def messages(self, order: int, block: _Block, number: int) -> list[tuple]:
        rows = []
        word, head, a = self.places
        v = max(len(block.gid), 1)
        n = np.bincount(self.train, minlength=len(word))
        word, a, b, shard = np.append(block.gid + 1, 0)[word], block.gid[a], block.gid[head % v], head // v  # word 0: none
        sizes = np.bincount(self.context, minlength=len(head))
        ends = np.append(0, np.cumsum(sizes))
        new = np.flatnonzero(_changes(shard))
        for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(shard)]):
            x, y = ends[lo], ends[hi]
            rows.append((number, order, int(shard[lo]), 0 if rows else self.once, _pack(
                np.diff(b[lo:hi], prepend=0), a[lo:hi] if order == 3 else a[:0], sizes[lo:hi], word[x:y], n[x:y])))
        if self.once and not rows:
            rows.append((number, order, 0, self.once, _pack(*[np.zeros(0, np.int64)] * 5)))
        return rows


class _Block:
    """The tokens of a block as places in its words in order of their ids."""

    def __init__(self, block: pa.Table, known: pa.Table) -> None:
        first = known.filter(pa.compute.equal(known.column("order"), 1)).sort_by("shard")
        gid, c = (np.concatenate(x) for x in zip(*[_unpack(x, 2) for x in first.column("answer").to_pylist()]))
        order = np.argsort(gid)
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        self.gid, self.c = gid[order], c[order]
        sizes, ids = _unpack(block.column("tokens")[0].as_py(), 2)
        self.ids = place[ids]
        self.upto = np.append(0, np.cumsum(sizes))
        self.b, self.a = _contexts(self.upto, self.ids)
        self.held_out = block.column("held_out").combine_chunks().flatten()
        self.train = np.repeat(~self.held_out.to_numpy(zero_copy_only=False), sizes)


_ASKED = pa.schema([("block", pa.int64()), ("order", pa.int32()), ("shard", pa.int32()), ("once", pa.int64()), ("grams", pa.binary())])


def _ask(n_shards: int, split_at: int):
    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if table.num_rows:
            block, number = _Block(table, known), table.column("block")[0].as_py()
            for order in (2, 3):
                rows += _Grams(block, order, n_shards, split_at).messages(order, block, number)
        return _table(rows, _ASKED)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """The codes of a shard's n-grams for every block that asked, and its contexts' sums."""
    order = table.column("order")[0].as_py()
    b, a, sizes, w, n = zip(*[_unpack(x, 5) for x in table.column("grams").to_pylist()])
    ends, contexts = np.cumsum([len(x) for x in w])[:-1], np.cumsum([len(x) for x in b])[:-1]
    b, sizes, w, n = np.concatenate([np.cumsum(x) for x in b]), np.concatenate(sizes), np.concatenate(w), np.concatenate(n)
    wide = 0
    if order == 3:
        a = np.concatenate(a)
        wide = _bits(a)
        firsts, b = _ranks(b, (int(b.max()) if len(b) else 0) + 1)
        key, at = _ranks((b << wide) | a, len(firsts) << wide)
        firsts, lasts = firsts[key >> wide], key & ((1 << wide) - 1)
    else:
        firsts, at = _ranks(b, (int(b.max()) if len(b) else 0) + 1)
        lasts = None
    wide = _bits(w)
    gram, place = _ranks((np.repeat(at, sizes) << wide) | w, len(firsts) << wide)
    n = np.bincount(place, weights=n, minlength=len(gram)).astype(np.int64)
    context, w = gram >> wide, gram & ((1 << wide) - 1)
    del gram
    none = w == 0
    once, twice = int(n[none].sum() + ((n == 1) & ~none).sum()), int(((n == 2) & ~none).sum())
    kept = np.flatnonzero(~none & (n >= LEAST_COUNT))
    mine = context[kept]
    w, b, a = w[kept], firsts[mine], lasts[mine] if order == 3 else None
    trie = Trie(b, a, w, n[kept]).mapped()
    code = np.zeros(len(n), dtype=np.uint8)
    code[kept] = trie.codes(b, a, w)

    sums = [np.bincount(context, weights=x, minlength=len(firsts)).astype(np.int64) for x in (code > 0, VALUES[code], n)]
    answers = [_pack(code[p], *[x[k] for x in sums]) for p, k in zip(np.split(place, ends), np.split(at, contexts))]
    first = np.arange(table.num_rows) == 0
    return pa.table([table.column("block"), table.column("order"), table.column("shard"),
                     pa.array(table.column("once").to_numpy() + np.where(first, once, 0)), pa.array(np.where(first, twice, 0)),
                     pa.array(answers, pa.binary())], names=["block", "order", "shard", "x", "y", "answer"])


def _score(n_shards: int, split_at: int, total: float, discounts: dict[int, float]):
    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        block = _Block(table, known)
        p = ((block.c + 1) / total)[block.ids]
        for order in (2, 3):
            mine = known.filter(pa.compute.equal(known.column("order"), order)).sort_by("shard")
            g = _Grams(block, order, n_shards, split_at)
            if not len(g.tokens):
                continue
            code, kept, kept_n, seen = (np.concatenate(x) for x in zip(*[_unpack(x, 4) for x in mine.column("answer").to_pylist()]))
            if g.whole is not None:
                kept, kept_n, seen = (np.bincount(g.whole, weights=x)[g.whole] for x in (kept, kept_n, seen))
            d = discounts[order]
            seen = np.maximum(seen, 1)
            back = np.maximum(1 - (kept_n - d * kept) / seen, 1e-9)
            n = VALUES[code]
            own = np.where(n > 0, n - d, 0) / seen[g.context]
            del code, kept, kept_n, seen, n
            new = back[g.context][g.gram]
            new *= p[g.tokens]
            new += own[g.gram]
            p[g.tokens] = new
            del g, own, back, new
        rows = [pa.array(np.diff(block.upto))]
        for x in ((block.c > 0).astype(np.int64)[block.ids], np.log10(block.c + 1.0)[block.ids], np.log10(p, out=p)):
            rows.append(pa.array(np.add.reduceat(x, block.upto[:-1])))
        return pa.table([table.column("doc_id").combine_chunks().flatten(), block.held_out, *rows],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score"])

    return run


def score_texts(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``;
    the model learns from rows where the column ``held_out`` is false."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = -(-int(size) // BLOCK_BYTES) or 1
    blocks = cut_lineage(rows.mapInArrow(giving_back(_deal(BLOCK_BYTES)), _BLOCK.format(kind)), "blocks")
    asked = blocks.select("block", "words").mapInArrow(giving_back(_ask_words(n_shards)), "shard int, block long, words binary")
    known = cut_lineage(asked.groupBy("shard").applyInArrow(_clean(_add_words(n_shards), 1), _ANSWER), "words")
    n, v = known.agg(F.sum("x"), F.sum("y")).first()
    n, v = int(n or 0), int(v or 0)

    texts = blocks.select("block", "held_out", "tokens")
    asked = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _clean(_ask(n_shards, SPLIT), 2), "block long, order int, shard int, once long, grams binary")
    answers = cut_lineage(asked.groupBy("order", "shard").applyInArrow(_clean(_answer, 1), _ANSWER), "grams")
    few = {r["order"]: (r["x"], r["y"]) for r in answers.groupBy("order").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).collect()}
    discounts = {k: few[k][0] / (few[k][0] + 2 * few[k][1]) if few.get(k, (0, 0))[0] else 0.5 for k in (2, 3)}

    scored = blocks.select("block", "doc_id", "held_out", "tokens").groupBy("block").cogroup(known.unionByName(answers).groupBy("block")).applyInArrow(
        _clean(_score(n_shards, SPLIT, float(n + v + 1), discounts), 2), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, log_counts double, score double")
    base = F.col("log_counts") - F.col("n_tokens") * float(np.log10(n + v + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
