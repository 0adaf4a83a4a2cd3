"""Suffix-array dedup (operator 7): bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Sorting the suffixes at all bytes would shuffle the corpus hundreds of times over, so
the suffixes of a sample of places are sorted, chosen so that nothing is missed: the
anchor of a string of ``LENGTH`` bytes is its least ``GRAM``-byte substring by a hash
(the leftmost of equals). Equal strings have their anchor at the same distance from
their start, so all equal strings meet at one anchor key.

1. Anchor keys (hashes) are counted with map-side combining; those found once go.
2. Texts with an anchor left give a record for each: the bytes of all strings that
   have this anchor. Exact copies are known by digest, and one of them stands for all.
3. Splitters from a sample of the records' leading bytes range-partition them. Records
   with equal leading bytes are never parted, so no comparison crosses a boundary.
4. A bucket sorts the suffixes to the right of its anchors, and the reversed prefixes
   to the left, by multikey quicksort over eight-byte digits. Two strings with anchors
   at distance d are equal if the longest common prefixes between them reach
   ``LENGTH`` - d on the right and d on the left.
5. An anchor key with more than ``HOT`` records is not sorted in one task: its strings
   are compared by 128-bit fingerprints, counted with map-side combining.

Defined results: null is an empty text; texts shorter than ``LENGTH`` lose nothing;
repeated rows are copies of each other, so both lose all their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import mix64, slices
from binscope.session import cut_lineage

LENGTH = 200
GRAM = 64
#: Records of one anchor key that one task sorts.
HOT = 20_000
#: Records of a bucket, in the mean.
BUCKET_RECORDS = 20_000
#: Leading bytes that a splitter has, and records in the sample of splitters.
LEAD = 32
SAMPLE = 20_000

_WIDTH = LENGTH - GRAM + 1  # grams in a string
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


_BYTES = [mix64(np.arange(1, 257, dtype=np.uint64) * odd) for odd in _ODD]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(buf: np.ndarray, size: int, kind: int = 0) -> np.ndarray:
    """64-bit hashes of all substrings of ``size`` bytes, from prefix sums of a polynomial."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[kind][buf] * _powers(_ODD[kind], len(buf)), out=total[1:])
    return mix64((total[size:] - total[:n]) * _powers(_inverse(_ODD[kind]), n))


def anchors(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings inside one row: first place, place of the anchor; and the grams' hashes."""
    n = len(buf) - LENGTH + 1
    gram = window_hashes(buf, GRAM)
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), gram
    least = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while span * 2 <= _WIDTH:  # least over spans of powers of two, then two that overlap
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = _WIDTH - span
    least = np.minimum(least[:n], least[rest:rest + n]) if rest else least[:n]
    end = np.repeat(offs[1:], np.diff(offs))[:n]
    start = np.flatnonzero(np.arange(n, dtype=np.int64) + LENGTH <= end)
    return start, (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64), gram


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in slices(batch.column(1)):
            _, place, gram = anchors(buf, offs)
            place = np.unique(place)
            row = np.searchsorted(offs, place, "right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(gram[place].view(np.int64)), batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                pa.array((place - offs[row]).astype(np.int32))], names=["key", "doc_id", "place"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of whole texts."""
    for batch in batches:
        for lo, hi, buf, offs in slices(batch.column(2)):
            raw = buf.tobytes()
            texts = [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(offs)),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts])], names=["doc_id", "mark", "n_bytes", "sha256"])


def _records(batch: pa.RecordBatch, hot: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text of (doc_id, mark, text, places, hots): row, bytes, and first and last start and
    anchor of the strings of each of its anchors that are (not) hot."""
    places, flags = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    for lo, hi, buf, offs in slices(batch.column(2)):
        start, anchor, _ = anchors(buf, offs)
        edge = np.searchsorted(start, offs)
        for i in range(hi - lo):
            s, a = start[edge[i]:edge[i + 1]] - offs[i], anchor[edge[i]:edge[i + 1]] - offs[i]
            if not len(s):
                continue
            wanted = np.array([p for p, f in zip(places[lo + i], flags[lo + i]) if f == hot], dtype=np.int64)
            own, first = np.unique(a, return_index=True)
            last = np.append(first[1:], len(a)) - 1
            use = np.isin(own, wanted)
            if use.any():
                yield lo + i, buf[offs[i]:offs[i + 1]], s[first[use]], s[last[use]], own[use]


def _contexts(batches: Iterator[pa.RecordBatch], splitters: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Records: bucket, doc_id, mark, first start, distance of the anchor from it, bytes."""
    for batch in batches:
        rows, firsts, ats, texts = [], [], [], []
        for row, body, lo, hi, at in _records(batch, hot=False):
            raw = body.tobytes()
            rows += [row] * len(lo)
            firsts += lo.tolist()
            ats += (at - lo).tolist()
            texts += [raw[a:b + LENGTH] for a, b in zip(lo.tolist(), hi.tolist())]
        leads = np.array([t[a:a + LEAD] for t, a in zip(texts, ats)], dtype=f"S{LEAD}")
        if splitters is None:
            yield pa.RecordBatch.from_arrays([pa.array(leads.tolist(), type=pa.binary())], names=["lead"])
        else:
            take = pa.array(rows, type=pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.searchsorted(splitters, leads, "right").astype(np.int32)), batch.column(0).take(take), batch.column(1).take(take),
                pa.array(firsts, type=pa.int64()), pa.array(ats, type=pa.int32()), pa.array(texts, type=pa.binary())],
                names=["bucket", "doc_id", "mark", "first", "at", "body"])


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix and the longest common prefix of each with the one before.

    Multikey quicksort on eight-byte digits, vectorised: a round sorts by one digit inside the ties
    of the digits before, and rows that a digit tells apart are done.
    """
    n, width = rows.shape
    digits = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8").astype(np.uint64)
    order, tie = np.arange(n), np.zeros(n, dtype=np.int64)
    open_ = np.arange(n)
    for d in range(digits.shape[1]):
        if not len(open_):
            break
        digit = digits[order[open_], d]
        by = np.lexsort((digit, tie[open_]))
        order[open_] = order[open_[by]]
        digit, was = digit[by], tie[open_]
        new = np.ones(len(open_), dtype=bool)
        new[1:] = (digit[1:] != digit[:-1]) | (was[1:] != was[:-1])
        group = np.cumsum(new) - 1
        tie[open_] = open_[new][group]
        open_ = open_[np.bincount(group)[group] > 1]
    common = np.zeros(n, dtype=np.int64)
    for at in range(1, n, 1 << 14):
        part = slice(at, min(n, at + (1 << 14)))
        differs = rows[order[part]] != rows[order[part.start - 1:part.stop - 1]]
        common[part] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    return order, common


def _matrix(buf: np.ndarray, first: np.ndarray, step: int, size: np.ndarray, width: int) -> np.ndarray:
    """Bytes from ``first`` on (backwards if step is -1), ``size`` of each, padded with zeros."""
    k = np.arange(width)
    inside = k[None, :] < size[:, None]
    at = np.where(inside, first[:, None] + step * k[None, :], 0)
    return np.where(inside, buf[at], 0).astype(np.uint8) if len(buf) else np.zeros((len(first), width), np.uint8)


def repeated_strings(bodies: list[bytes], at: np.ndarray) -> np.ndarray:
    """For each record: which of its strings, by start, are found again in another record or place.

    Returns a matrix (records, _WIDTH): column d is the string whose anchor is d bytes behind its start.
    """
    size = np.array([len(b) for b in bodies], dtype=np.int64)
    buf = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    anchor = np.cumsum(size) - size + at
    right, left = np.minimum(size - at, LENGTH), np.minimum(at, _WIDTH - 1)
    order_r, common_r = multikey_sort(_matrix(buf, anchor, 1, right, LENGTH))
    order_l, common_l = multikey_sort(_matrix(buf, anchor - 1, -1, left, _WIDTH - 1))
    n_strings = size - LENGTH + 1
    out = np.zeros((len(bodies), _WIDTH), dtype=bool)
    for d in range(_WIDTH):
        have = (d <= at) & (d > at - n_strings)  # the string that starts at anchor - d
        if have.sum() < 2:
            continue
        block_r, block_l = np.empty(len(bodies), np.int64), np.empty(len(bodies), np.int64)
        block_r[order_r] = np.cumsum(common_r < LENGTH - d)
        block_l[order_l] = np.cumsum(common_l < d)
        own = np.flatnonzero(have)
        both = block_r[own] * (len(bodies) + 1) + block_l[own]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        twice = np.zeros(len(own), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        out[own[twice], d] = True
    return out


def _bucket_spans(table: pa.Table) -> pa.Table:
    """Merged byte ranges of the repeated strings of a bucket's records."""
    at = table.column("at").to_numpy().astype(np.int64)
    first = table.column("first").to_numpy()
    hit = repeated_strings(table.column("body").to_pylist(), at)
    row, d = np.nonzero(hit)
    start = first[row] + at[row] - d
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + LENGTH)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(row)) - 1
    take = pa.array(row[head])
    return pa.table({
        "doc_id": table.column("doc_id").combine_chunks().take(take), "mark": table.column("mark").combine_chunks().take(take),
        "start": pa.array(start[head].astype(np.int64)), "end": pa.array((start[last] + LENGTH if len(row) else start[last]).astype(np.int64))})


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the strings of hot anchors."""
    for batch in batches:
        for row, body, lo, hi, _ in _records(batch, hot=True):
            s = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])
            one, two = window_hashes(body, LENGTH, 1), window_hashes(body, LENGTH, 2)
            take = pa.array(np.full(len(s), row))
            yield pa.RecordBatch.from_arrays([
                pa.array(one[s].view(np.int64)), pa.array(two[s].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take),
                pa.array(s.astype(np.int64))], names=["h1", "h2", "doc_id", "mark", "start"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text of (doc_id, mark, text, spans): merged spans, removed bytes, digest of the rest, the rest."""
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        spans = batch.column(3).to_pylist()
        for lo, _, buf, offs in slices(batch.column(2)):
            for i in range(len(offs) - 1):
                body = buf[offs[i]:offs[i + 1]]
                edge = np.zeros(len(body) + 1, dtype=np.int64)
                for s in spans[lo + i]:
                    edge[s["start"]] += 1
                    edge[s["end"]] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = body[~gone].tobytes()
                rows[0].append(int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum()))
                rows[1].append(int(gone.sum()))
                rows[2].append(hashlib.sha256(kept).hexdigest())
                rows[3].append(kept)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(rows[0], type=pa.int64()), pa.array(rows[1], type=pa.int64()), pa.array(rows[2]),
            pa.array(rows[3], type=pa.binary())], names=["doc_id", "mark", "n_spans", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of ``docs``.

    ``kept`` has the bytes that are left of a text that lost some; it is null for one that lost none.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    whole = rows.mapInArrow(_digests, f"doc_id {kind}, mark long, n_bytes long, sha256 string")
    copies = cut_lineage(whole.filter(F.col("n_bytes") >= LENGTH).groupBy("sha256").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("rep"), F.first("mark").alias("mark")).filter("n > 1"), "copies")

    found = rows.select("doc_id", "text").mapInArrow(_anchor_rows, f"key long, doc_id {kind}, place int")
    often = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    places = found.join(often, "key").groupBy("doc_id").agg(
        F.collect_list(F.struct("place", (F.col("n") > HOT).alias("hot"))).alias("places"))
    # of copies only one gives records
    stands_for = copies.select(F.col("mark"), F.col("rep"))
    wanted = places.select("doc_id", F.col("places.place").alias("places"), F.col("places.hot").alias("hots"))
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"])).select(rows["doc_id"], "mark", "text", "places", "hots")
    texts = texts.join(stands_for, "mark", "left").filter(F.col("rep").isNull() | F.col("rep").eqNullSafe(F.col("doc_id")))
    texts = cut_lineage(texts.select("doc_id", "mark", "text", "places", "hots"), "texts")

    n_records = texts.agg(F.sum(F.size(F.filter("hots", lambda h: ~h)))).first()[0] or 0
    share = min(1.0, SAMPLE / max(1, n_records))
    some = texts.filter(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(1 << 30)) < int(share * (1 << 30)))
    leads = some.mapInArrow(lambda it: _contexts(it, None), "lead binary").toPandas()["lead"]
    n_buckets = -(-int(n_records) // BUCKET_RECORDS) or 1
    sample = np.sort(np.array([bytes(x) for x in leads], dtype=f"S{LEAD}"))
    splitters = np.unique(sample[[len(sample) * i // n_buckets for i in range(1, n_buckets)]]) if len(sample) else sample
    records = texts.mapInArrow(lambda it: _contexts(it, splitters), f"bucket int, doc_id {kind}, mark long, first long, at int, body binary")
    spans = records.groupBy("bucket").applyInArrow(_bucket_spans, f"doc_id {kind}, mark long, start long, end long")

    prints = texts.filter(F.exists("hots", lambda h: h)).mapInArrow(_fingerprints, f"h1 long, h2 long, doc_id {kind}, mark long, start long")
    twice = prints.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    hot = prints.join(twice, ["h1", "h2"]).select("doc_id", "mark", "start", (F.col("start") + LENGTH).alias("end"))
    by_text = spans.union(hot).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    same = texts["doc_id"].eqNullSafe(by_text["doc_id"]) & (texts["mark"] == by_text["mark"])
    cut = texts.join(by_text, same).select(texts["doc_id"], texts["mark"], "text", "spans").mapInArrow(
        _cut_out, f"doc_id {kind}, mark long, n_spans long, n_removed long, kept_sha256 string, kept binary")

    cut = cut.dropDuplicates(["doc_id", "mark"]).select(F.col("doc_id").alias("cut_id"), F.col("mark").alias("cut_mark"), "n_spans", "n_removed", "kept_sha256", "kept")
    whole = whole.join(copies.select("sha256", F.lit(True).alias("copied")), "sha256", "left")
    out = whole.join(cut, whole["doc_id"].eqNullSafe(F.col("cut_id")) & (whole["mark"] == F.col("cut_mark")), "left")
    copied, lost = F.col("copied").isNotNull(), F.col("n_removed").isNotNull()
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).when(lost, F.col("n_removed")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copied, 1).when(lost, F.col("n_spans")).otherwise(0).cast("long").alias("n_spans"),
        F.when(copied, empty).when(lost, F.col("kept_sha256")).otherwise(F.col("sha256")).alias("kept_sha256"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
