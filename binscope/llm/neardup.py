"""Near-duplicate classes (operator 4): ProbMinHash, banding, verified links.

A text is its five-word shingles (lower-cased words of letters and digits; a
shorter text is one shingle), weighted by 1 + ln(count). Each weighted element is
a Poisson process of that rate whose points fall on ``REGISTERS`` registers; a
register keeps the element of its first point, and an element stops as soon as
its next point comes after the latest first point of all registers (early
termination). Two texts agree in a register with the probability Jaccard of
their weighted shingles. ``BANDS`` bands of ``ROWS`` registers give the buckets. A text
with repeated shingles is also in the buckets of its shingle set (weights of 1, for which
that probability is the Jaccard similarity of the sets), so that repetitions, however
many, cannot keep a link out of common buckets.

Texts with the same words are one node from the start, so copies are never
paired. In each bucket every node is compared with one leader, not with all
others. A link is a Jaccard similarity of the shingle sets of ``SIMILARITY`` or
more, worked out from the texts. The texts of buckets whose nodes are then in more than
one component get new buckets, one for each of their rarest shingles: a prefix filter,
which no link escapes. Two texts that share many of them meet in the first alone: a row carries the
shingles just before its own, and a pair that has one of these in common is left to an earlier
bucket. In these, nodes outside the largest component become leaders in
turn, one first, then ``LEADERS`` times as many in each round, and are compared with the other
components' nodes, until every node is in its bucket's largest component or has been a
leader. So two texts that end up in different components have been compared or cannot
have a link: none is lost, and nothing is paired that is connected already. A class is
a connected component.

Intermediate tables are written to the shared checkpoint folder. Defined results:
texts without words are classes of their own; the class id is the least id in the
class (null only if all its ids are null); repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binscope.llm.text import ALNUM, SMALL_SLICE_BYTES, giving_back, mix64, slices, windows, words
from binscope.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
REGISTERS = BANDS * ROWS

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPOT = np.uint64(0xD1B54A32D192ED03)
_SLICE = SMALL_SLICE_BYTES
#: Text bytes of the pairs that are compared at once.
_PAIR_BYTES = 2 << 20
#: So many times as many leaders of a bucket in each round, after one in the first.
LEADERS = 4
#: Points of a process that are drawn at once after the first.
_DRAW = 8
#: Shingles before a bucket's own that its rows carry.
_BEFORE = 8


def shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and bounds of the rows, and distinct shingles: (row, hash) in order with counts."""
    _, _, h, upto = words(buf, offs, ALNUM, lower=True)
    at, key = windows(h, upto, SHINGLE)
    row = np.searchsorted(upto, at, "right") - 1
    n = np.diff(upto)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n == size)
        if len(short):
            # windows() of this size; only those that are a whole text
            first, k = windows(h, upto, size)
            whole = np.searchsorted(first, upto[short])
            row, key = np.concatenate((row, short)), np.concatenate((key, k[whole] ^ np.uint64(size)))
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    return h, upto, np.stack((row[first].astype(np.uint64), key[first])), np.diff(np.append(first, len(row)))


def probminhash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (n_rows, registers): in each register the element whose process reaches it first."""
    time = np.full(n_rows * registers, np.inf)
    signature = np.zeros(n_rows * registers, dtype=np.uint64)
    row = row.astype(np.int64)
    clock = np.zeros(len(row))
    drawn, step = 0, 1
    live = np.arange(len(row))
    while len(live):
        i = np.arange(drawn, drawn + step, dtype=np.uint64)
        seed = mix64((key[live][:, None] + (i + np.uint64(1)) * _STEP))
        uniform = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        points = clock[live][:, None] + np.cumsum(-np.log(uniform) / weight[live][:, None], axis=1)
        place = row[live][:, None] * registers + (mix64(seed ^ _SPOT) % np.uint64(registers)).astype(np.int64)
        latest = time.reshape(n_rows, registers).max(axis=1)
        useful = points < latest[row[live]][:, None]
        np.minimum.at(time, place[useful], points[useful])
        won = useful & (time[place] == points)
        signature[place[won]] = np.broadcast_to(key[live][:, None], place.shape)[won]
        clock[live] = points[:, -1]
        drawn, step = drawn + step, _DRAW
        latest = time.reshape(n_rows, registers).max(axis=1)
        live = live[clock[live] < latest[row[live]]]
    return signature.reshape(n_rows, registers)


def _nodes(h: np.ndarray, upto: np.ndarray) -> list[bytes | None]:
    """128-bit digests of the rows' word sequences; None without words."""
    n = np.diff(upto)
    if not len(h):
        return [None] * len(n)
    place = np.arange(len(h)) - np.repeat(upto[:-1], n)
    digest = []
    for odd in (0xA24BAED4963EE407, 0x9FB21C651E98DF25):
        power = np.full(int(n.max()), odd, dtype=np.uint64)
        np.multiply.accumulate(power, out=power)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h + np.uint64(odd)) * power[place])))
        digest.append(mix64(total[upto[1:]] - total[upto[:-1]] + n.astype(np.uint64)))
    both = np.stack(digest, axis=1).astype(">u8")
    return [both[i].tobytes() if k else None for i, k in enumerate(n.tolist())]


def _bands(signature: np.ndarray) -> np.ndarray:
    band = np.zeros((len(signature), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        band = mix64(band * _STEP + signature[:, r::ROWS])
    return mix64(band + np.arange(BANDS, dtype=np.uint64) * _SPOT).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in slices(batch.column(1), _SLICE):
            h, upto, (row, key), count = shingles(buf, offs)
            signature = probminhash(row, key, 1 + np.log(count), hi - lo)
            bands = list(_bands(signature))
            row = row.astype(np.int64)
            repeated = np.unique(row[count > 1])
            own = np.isin(row, repeated)
            plain = _bands(probminhash(np.searchsorted(repeated, row[own]), key[own], np.ones(own.sum()), len(repeated)))
            for i, b in zip(repeated.tolist(), plain):
                bands[i] = np.unique(np.concatenate((bands[i], b)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(_nodes(h, upto), type=pa.binary()), pa.array(bands, type=pa.list_(pa.int64()))],
                names=["doc_id", "node", "bands"])


def _with_node(names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes | None] = []
            for _, _, buf, offs in slices(batch.column(batch.schema.get_field_index(text)), _SLICE):
                _, _, h, upto = words(buf, offs, ALNUM, lower=True)
                found += _nodes(h, upto)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=pa.binary())], names=[*names, "__node"])

    return run


def with_node(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with column ``__node``, the digest of the words."""
    shown = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.lit(None).cast("binary").alias("__node")).schema
    return docs.mapInArrow(giving_back(_with_node(docs.columns, text)), shown)


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose texts' shingle sets have a Jaccard similarity of ``SIMILARITY`` or more."""
    for batch in batches:
        size = np.cumsum(sum(pc.binary_length(batch.column(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3)))
        part = size // _PAIR_BYTES  # the sets of a part of the pairs are held at once
        ends = [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
        for lo, hi in zip([0, *ends], ends):
            yield _similar(batch.slice(lo, hi - lo))


def _similar(pairs: pa.RecordBatch) -> pa.RecordBatch:
    sets: list[list[np.ndarray]] = [[], []]
    for side in (0, 1):
        column = pairs.column(2 + side).dictionary_encode()  # a leader's text comes with many pairs
        texts: list[np.ndarray] = []
        for lo, hi, buf, offs in slices(column.dictionary, _SLICE):
            _, _, (row, key), _ = shingles(buf, offs)
            bounds = np.searchsorted(row, np.arange(hi - lo + 1, dtype=np.uint64))
            texts += [key[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        sets[side] = [texts[i] for i in column.indices.to_pylist()]
    keep = []
    for a, b in zip(*sets):
        if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
            keep.append(False)
            continue
        both = len(np.intersect1d(a, b, assume_unique=True))
        keep.append(both >= SIMILARITY * (len(a) + len(b) - both))
    return pa.RecordBatch.from_arrays([pairs.column(0), pairs.column(1)], names=["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of ``links`` (a, b): comp is the least node of the component.

    Each round every node takes the least label around it, and then the label of that label, until
    nothing changes. Labels are written once a round.
    """
    both = cut_lineage(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp")), "labels")
    while True:
        other = labels.toDF("other", "other_comp")
        near = both.join(other, "other").groupBy("node").agg(F.min("other_comp").alias("near"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.toDF("new", "jump")
        step = cut_lineage(step.join(jump, "new").select(
            "node", F.least("new", "jump").alias("comp"), (F.least("new", "jump") != F.col("comp")).alias("moved")), "labels")
        labels = step.select("node", "comp")
        if not step.filter("moved").limit(1).count():
            return labels


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(giving_back(_similarity), "a binary, b binary")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, __node, __comp, class_id) of every row of ``docs``: digest of the words, least digest of
    the class (both null without words), and least id of the class."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    signed = cut_lineage(rows.mapInArrow(giving_back(_sign), f"doc_id {kind.simpleString()}, node binary, bands array<long>"), "signatures")
    known = signed.filter(F.col("node").isNotNull())
    nodes = cut_lineage(known.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "nodes")
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("lead")).filter("n > 1")
    members = cut_lineage(spread.join(shared.select("bucket", "lead"), "bucket"), "members")

    # one text for each node that has company; rows of a much-copied text differ in their ids
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("rep").alias("doc_id"), F.col("node").alias("__node"))
    bodies = with_node(rows)
    same = bodies["doc_id"].eqNullSafe(wanted["doc_id"]) & (bodies["__node"] == wanted["__node"])
    texts = cut_lineage(bodies.join(wanted, same, "left_semi").select(F.col("__node").alias("node"), "text").dropDuplicates(["node"]), "texts")

    first = members.filter(F.col("node") != F.col("lead")).select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    comp = components(cut_lineage(_verify(first, texts), "links"))
    open_ = _open(members.select("bucket", "node"), comp)
    members = _rare_buckets(texts.join(open_.select("node").distinct(), "node", "left_semi"))
    led = None
    quota = 1
    while True:
        open_ = cut_lineage(_open(members, comp), "open")
        waiting = open_.filter(F.col("comp") != F.col("largest"))
        if led is not None:
            waiting = waiting.join(led, ["bucket", "node"], "left_anti")
        leaders = cut_lineage(_first(waiting, quota), "leaders")
        if not leaders.limit(1).count():
            return _classes(signed, nodes, comp)
        comp = _merge(comp, cut_lineage(_verify(_candidates(leaders, open_).distinct(), texts), "links"))
        leaders = leaders.select("bucket", "node")
        led = leaders if led is None else led.union(leaders)
        members = open_.select(*members.columns)  # a bucket in one component stays so
        quota *= LEADERS


def _candidates(leaders: DataFrame, open_: DataFrame) -> DataFrame:
    """(a, b), a < b, of leaders and nodes of other components in their buckets that may have a link.

    A pair is left out of every bucket but the first it shares, as far as the shingles carried tell: one
    that both have before the bucket's own means that they share an earlier bucket too. Of one size
    class, they are compared in its buckets and not in those of the next.
    """
    sides = [x.select("bucket", *[F.col(k).alias(f"{k}_{end}") for k in ("node", "comp", "n", "place", "own", "before")])
             for x, end in ((leaders, "a"), (open_, "b"))]
    # in the bucket of the first shingle they share, no more than this one and those behind it are shared
    most = 1 + F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b"))
    may = (F.col("comp_a") != F.col("comp_b")) & (most >= SIMILARITY / (1 + SIMILARITY) * F.expr("n_a + n_b") - 1e-9)
    first = (F.col("own_a") | F.col("own_b")) & ~F.arrays_overlap("before_a", "before_b")
    pairs = sides[0].join(sides[1], (sides[0]["bucket"] == sides[1]["bucket"]) & may & first)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def _open(members: DataFrame, comp: DataFrame) -> DataFrame:
    """``members`` with comp and largest, of the buckets whose nodes are in more than one component."""
    placed = members.join(comp, "node", "left").select(*members.columns, F.coalesce("comp", "node").alias("comp"))
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    top = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("comp", F.struct("n", "comp")).alias("largest"))
    return placed.join(top.filter("parts > 1").select("bucket", "largest"), "bucket")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in slices(batch.column(1), _SLICE):
            _, _, (row, key), _ = shingles(buf, offs)
            n = np.bincount(row.astype(np.int64), minlength=hi - lo)
            take = pa.array(row.astype(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo).take(take), pa.array(key.view(np.int64)), pa.array(np.repeat(n, n))], names=["node", "shingle", "n"])


def _rare_buckets(texts: DataFrame) -> DataFrame:
    """(bucket, node, n, place, own, before): buckets that every two of these texts with a link have in common;
    n is the size of the text's set, place that of the bucket's shingle in it, by rarity, own whether the bucket
    is of the text's own size class, and before the shared shingles next before the bucket's in that order.

    A similarity of s needs s n of a set's n shingles in both sets, so of the floor((1 - s) n) + 1 that
    are rarest here one at least is shared (prefix filter). Shingles of one text alone are the rarest;
    a text that has that many of them can have no link. Sizes of linked sets differ by a factor of s
    at most, so a text is in the bucket of its own size class and of the next.
    """
    rows = texts.select("node", "text").mapInArrow(giving_back(_shingle_rows), "node binary, shingle long, n long")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    own = Window.partitionBy("node")
    by_rarity = own.orderBy("df", "shingle")
    ranked = rows.join(shared, "shingle").select(
        "node", "shingle", "n", F.count("*").over(own).alias("n_shared"), F.row_number().over(by_rarity).alias("rank"),
        F.collect_list("shingle").over(by_rarity.rowsBetween(-_BEFORE, -1)).alias("before"))
    ranked = ranked.select("node", "shingle", "n", (F.col("n") - F.col("n_shared") + F.col("rank")).alias("place"), "before")
    rare = ranked.filter(F.col("place") <= F.floor(F.col("n") * (1 - SIMILARITY) + 1e-9) + 1)
    size = F.floor(F.log("n") / float(np.log(1 / SIMILARITY)) + 1e-9)
    spread = rare.select("node", "n", "place", "shingle", "before", F.explode(F.array(size, size + 1)).alias("size"), size.alias("own_size"))
    return cut_lineage(spread.select(F.xxhash64("shingle", "size").alias("bucket"), "node", "n", "place",
                                     (F.col("size") == F.col("own_size")).alias("own"), "before"), "rare")


def _merge(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after new links: only the graph of the components that these connect is walked."""
    if not links.limit(1).count():
        return comp
    of = comp.toDF("node", "comp")
    ends = links
    for end in ("a", "b"):
        ends = ends.join(of.toDF(end, f"comp_{end}"), end, "left").withColumn(end, F.coalesce(f"comp_{end}", end)).drop(f"comp_{end}")
    moved = components(ends.filter("a != b").select("a", "b").distinct()).toDF("comp", "new")
    known = of.join(moved, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp"))
    # nodes that had no component of their own so far
    fresh = moved.join(of.select(F.col("node").alias("comp")), "comp", "left_anti").select(F.col("comp").alias("node"), F.col("new").alias("comp"))
    return cut_lineage(known.union(fresh), "components")


def _first(waiting: DataFrame, quota: int) -> DataFrame:
    """The first ``quota`` waiting nodes of each bucket."""
    order = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
    return waiting.withColumn("rank", order).filter(F.col("rank") <= quota).drop("rank")


def _classes(signed: DataFrame, nodes: DataFrame, comp: DataFrame) -> DataFrame:
    placed = nodes.select("node", "rep").join(comp, "node", "left").select("node", "rep", F.coalesce("comp", "node").alias("comp"))
    least = placed.groupBy("comp").agg(F.min("rep").alias("class_id"))
    of_node = placed.join(least, "comp").select("node", "comp", "class_id")
    out = signed.select("doc_id", "node").join(of_node, "node", "left")
    return out.select("doc_id", F.col("node").alias("__node"), F.col("comp").alias("__comp"),
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least id, with the columns of ``docs``; all without words stay."""
    found = near_duplicate_classes(docs).filter(F.col("__node").isNotNull())
    # the least id, and of texts with the same id the first by digest
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__node").alias("node"))).alias("first")
    keep = found.groupBy("__comp").agg(first).select(F.col("first.id").alias("__id"), F.col("first.node").alias("__key"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = with_node(docs)
    kept = rows.join(keep, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__node"]).select(*names).union(rows.filter(F.col("__node").isNull()).select(*names))
