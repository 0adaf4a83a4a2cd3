"""Arrow-batch text helpers shared by the operators of this subpackage.

All helpers work on slices of a batch (a few MB of UTF-8), so the numpy
temporaries stay small whatever the batch or text size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
#: Of operators with many temporaries of eight bytes a byte of text; these fit a core's cache.
SMALL_SLICE_BYTES = 1 << 17

_MASK = (1 << 64) - 1


def table_of(keep: str) -> np.ndarray:
    """256-entry truth table of the byte values whose character is in ``keep``."""
    t = np.zeros(256, dtype=bool)
    t[[ord(c) for c in keep]] = True
    return t


#: Words of letters, digits and everything beyond ASCII.
ALNUM = table_of("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
ALNUM[128:] = True
#: Words of anything but the six ASCII white-space characters.
NONSPACE = ~table_of(" \t\n\x0b\x0c\r")

#: A-Z to a-z on bytes; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0x9E6C63D0876A9A35)


def text_column(col: pa.Array) -> pa.Array:
    """The column as 64-bit-offset strings with nulls as empty texts."""
    return col.cast(pa.large_string()).fill_null("")


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of row ranges of about ``limit`` bytes.

    A single text longer than that is a slice of its own; it is never cut.
    """
    col = text_column(col)
    n = len(col)
    if n == 0:
        return
    _, off_buf, data_buf = col.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64, count=n + 1, offset=col.offset * 8)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray,
          lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice: starts, ends, 64-bit hashes, and words before each row (n_rows + 1).

    The hash is a polynomial over a random byte table, mixed with the length.
    """
    if lower:
        buf = np.frombuffer(buf.tobytes().translate(LOWER), dtype=np.uint8)
    inside = is_word[buf]
    first = np.zeros(len(buf) + 1, dtype=bool)
    first[offs] = True
    if len(buf):
        before = np.empty(len(buf), dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        start = inside & (~before | first[:-1])
        after = np.zeros(len(buf), dtype=bool)
        after[:-1] = inside[1:]
        end = inside & (~after | first[1:])
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    else:
        starts = ends = np.zeros(0, dtype=np.int64)
    upto = np.searchsorted(starts, offs)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), upto
    lens = ends - starts
    at = np.zeros(len(starts), dtype=np.int64)
    np.cumsum(lens[:-1], out=at[1:])
    place = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    power = np.full(int(lens.max()), _ODD, dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    h = np.add.reduceat(_BYTE[buf[inside]] * power[place], at)
    return starts, ends, mix64(h + lens.astype(np.uint64)), upto


def windows(h: np.ndarray, upto: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` consecutive words inside one row: (first word, hash)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = (out + h[k:k + n]) * _ODD
        out ^= out >> np.uint64(29)
    last = np.repeat(upto[1:], np.diff(upto))[:n]
    at = np.flatnonzero(np.arange(n, dtype=np.int64) + size <= last)
    return at, mix64(out[at])


def crc_bucket(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def give_back() -> None:
    """Return what this process has freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: What operators keep in this process from task to task, by name.
_KEPT: dict[str, dict] = {}


def cache_of(name: str) -> dict:
    """A cache of this process that stays until a task of an operator that does not keep it."""
    return _KEPT.setdefault(name, {})


def let_go(but: str | None = None) -> None:
    """Empty the caches of other operators than ``but``."""
    for name, cache in _KEPT.items():
        if name != but:
            cache.clear()


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                keeps: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over the Arrow batches of a task, then ``give_back``; of the caches, only ``keeps`` is left to it.

    Workers are reused: what the temporaries of a task took would else stay with its worker, beside
    those of later stages and the executor's own memory, and so would the caches of earlier stages."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        try:
            yield from run(batches)
        finally:
            give_back()

    return work
