"""Exact k nearest neighbours inside groups by a pivot-partitioned block join (used by G3).

Distance is the squared Euclidean distance on standardised features,
``sum_j (x_j - y_j)^2 / var_j``; ties are broken by key.

1. Identical vectors collapse first (count and the first ``k + 1`` keys per
   vector, through a row-number limit that Spark pre-limits map-side). A value
   held by a third of all rows is one vector and no pairs. A row's duplicates
   are its nearest neighbours (distance 0, key order).
2. Up to ``MAX_PIVOTS`` vectors of each group are pivots; every vector belongs
   to the cell of its nearest pivot, and a cell is split by a hash into blocks
   of about ``BLOCK_ROWS`` vectors, so a dense region has many blocks.
3. Each block finds its vectors' ``k`` nearest within the block: an upper bound
   of the true k-th distance, in the full space.
4. A cell pair (A, B) can hold a neighbour only if ``d(pivot_A, pivot_B) -
   radius_A - radius_B`` is at most the largest bound in A (triangle
   inequality). The pairs of blocks of the pairs that are left are the tasks:
   one block against one block, of which the ``k`` best per vector are kept.

Cost: with well-separated cells each one meets a few others; where the vectors
fill many dimensions evenly the triangle inequality prunes little, and the work
grows with the square of a group's distinct vectors, split into equal tasks.
That is what an exact answer costs there; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binscope.functions.exprs import c
from binscope.session import cut_lineage

BLOCK_ROWS = 2000
MAX_PIVOTS = 256  # a group; bounds what the driver holds
SLACK = 1.0 + 1e-9  # rounding guard of the triangle inequality


def distances(x: np.ndarray, y: np.ndarray, var: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, the features added from the first to the last (as in the oracle)."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - y[None, :, j]
        out += d * d / var[j]
    return out


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), dtype=np.float64)
    return values.reshape(len(flat), len(values) // len(flat) if len(flat) else 0)


def _assign(pivots: dict, var: np.ndarray):
    """Cell and distance from its pivot of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("_g").to_pylist()
            x = _matrix(batch.column("_vec"))
            cell, far = np.zeros(len(x), dtype=np.int32), np.zeros(len(x))
            for g in set(group):
                own = np.array([v == g for v in group])
                d = distances(x[own], pivots[g], var)
                cell[own], far[own] = d.argmin(axis=1), np.sqrt(d.min(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "_cell", "_far"])
    return run


def _bounds(k: int, var: np.ndarray):
    """Per block: group, cell, largest distance from the pivot, largest k-th distance in the block."""
    def run(table: pa.Table) -> pa.Table:
        x, far = _matrix(table.column("_vec")), table.column("_far").to_numpy()
        most = float("inf")
        if len(x) > k:
            most = max(float(np.partition(distances(x[i:i + 500], x, var), k, axis=1)[:, k].max()) for i in range(0, len(x), 500))
        return pa.table({"_g": table.column("_g").slice(0, 1), "_cell": table.column("_cell").slice(0, 1),
                         "radius": pa.array([float(far.max())]), "bound": pa.array([most ** 0.5])})
    return run


def _block_pair(k: int, var: np.ndarray):
    """The k nearest vectors of the right block for each vector of the left one."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = _matrix(left.column("_vec")), _matrix(right.column("_vec"))
        ids = left.column("_vid").to_pylist(), right.column("_vid").to_pylist()
        order = np.array(sorted(range(len(y)), key=lambda i: ids[1][i]), dtype=np.int64)  # ties by key
        rows, picks, far = [], [], []
        for lo in range(0, len(x), 500):
            d = distances(x[lo:lo + 500], y[order], var) if len(y) else np.zeros((0, 0))
            for i in range(len(d)):
                best = np.argsort(d[i], kind="stable")[:k + 1]
                best = [j for j in best.tolist() if ids[1][order[j]] != ids[0][lo + i]][:k]
                rows += [lo + i] * len(best)
                picks += [int(order[j]) for j in best]
                far += d[i, best].tolist()
        take, other = pa.array(rows, type=pa.int64()), pa.array(picks, type=pa.int64())
        return pa.table({"_g": left.column("_g").take(take), "_vid": left.column("_vid").take(take), "_d": pa.array(far, type=pa.float64()),
                         "_yid": right.column("_vid").take(other), "_ykeys": right.column("_keys").take(other)})
    return run


def knn_lists(rows: DataFrame, key: str, group: str, feats: list[str], k: int = 5,
              variances: list[float] | None = None) -> tuple[DataFrame, list[float]]:
    """For every row with complete features: ``(group, key, _nn)`` where ``_nn``
    holds the keys of its ``k`` nearest other rows of the same group, in
    (distance, key) order (fewer when the group is smaller). ``variances``
    (default: sample variances of ``rows``) standardise the features; they are
    returned as well."""
    vec = F.array(*[c(f).cast("double") for f in feats])
    base = rows.select(c(group).alias("_grp"), c(key).alias("_key"), vec.alias("_vec")).where(~F.exists("_vec", lambda v: v.isNull()))
    base = cut_lineage(base, "knn-rows")
    kt = base.schema["_key"].dataType.simpleString()
    if variances is None:
        st = base.agg(*[F.var_samp(F.col("_vec")[j]) for j in range(len(feats))]).first()
        variances = list(st)
    var = [float(v) if v else 1.0 for v in variances]
    v = np.array(var)

    wk = Window.partitionBy("_grp", "_vec").orderBy("_key")
    firsts = (base.withColumn("_rn", F.row_number().over(wk)).where(F.col("_rn") <= k + 1)
              .groupBy("_grp", "_vec").agg(F.sort_array(F.collect_list("_key")).alias("_keys")))
    # groups are told apart by their text; the vector's id is its smallest key
    vecs = cut_lineage(firsts.select(F.coalesce(F.col("_grp").cast("string"), F.lit("")).alias("_g"),
                                     F.col("_keys")[0].alias("_vid"), "_keys", "_vec"), "knn-vectors")
    sizes = {r[0]: r[1] for r in vecs.groupBy("_g").count().collect()}  # one row per class
    wanted = F.create_map(*[x for g, n in sorted(sizes.items()) for x in (F.lit(g), F.lit(min(MAX_PIVOTS, -(-n // BLOCK_ROWS))))]) if sizes else None
    pivots: dict[str, list] = {}
    if sizes:
        order = F.row_number().over(Window.partitionBy("_g").orderBy(F.xxhash64("_vec"), "_vid"))
        few = vecs.select("_g", "_vec", order.alias("_rn")).where((F.col("_rn") <= MAX_PIVOTS) & (F.col("_rn") <= wanted[F.col("_g")]))
        for r in few.collect():
            pivots.setdefault(r["_g"], []).append(list(r["_vec"]))
    at = {g: np.array(p, dtype=np.float64) for g, p in pivots.items()}
    shape = f"_g string, _vid {kt}, _keys array<{kt}>, _vec array<double>, _cell int, _far double"
    placed = cut_lineage(vecs.mapInArrow(_assign(at, v), shape), "knn-cells")
    cells = {(r[0], r[1]): r[2] for r in placed.groupBy("_g", "_cell").count().collect()}  # at most MAX_PIVOTS a class
    blocks = {x: -(-n // BLOCK_ROWS) for x, n in cells.items()}

    per_cell = placed.sparkSession.createDataFrame([(g, i, n) for (g, i), n in blocks.items()], "_g string, _cell int, _blocks int")
    placed = placed.join(per_cell, ["_g", "_cell"]).withColumn("_block", F.pmod(F.xxhash64("_vid"), F.col("_blocks")).cast("int"))
    found = placed.groupBy("_g", "_cell", "_block").applyInArrow(_bounds(k, v), "_g string, _cell int, radius double, bound double")
    stats = {(r[0], r[1]): (r[2], r[3]) for r in found.groupBy("_g", "_cell").agg(F.max("radius"), F.max("bound")).collect()}
    pairs = []
    for (g, a), (radius_a, bound_a) in stats.items():
        between = np.sqrt(distances(at[g][a:a + 1], at[g], v)[0])
        pairs += [(g, a, b, blocks[g, b]) for (h, b), (radius_b, _) in stats.items() if h == g and between[b] - radius_a - radius_b <= bound_a * SLACK]
    pairs = placed.sparkSession.createDataFrame(pairs, "_g string, _cell int, _to int, _to_blocks int")

    # a block of A goes to each block of B, and the other way round
    span = F.explode(F.sequence(F.lit(0), F.col("_to_blocks") - 1)).alias("_to_block")
    left = placed.join(pairs, ["_g", "_cell"]).select("_g", F.col("_cell").alias("_a"), F.col("_block").alias("_ab"), F.col("_to").alias("_b"), "_vid", "_vec", span)
    left = left.withColumnRenamed("_to_block", "_bb")
    back = pairs.select("_g", F.col("_cell").alias("_a"), F.col("_to").alias("_cell")).join(
        per_cell.select("_g", F.col("_cell").alias("_a"), F.col("_blocks").alias("_a_blocks")), ["_g", "_a"])
    right = placed.join(back, ["_g", "_cell"]).select(
        F.col("_g").alias("_g"), "_a", F.explode(F.sequence(F.lit(0), F.col("_a_blocks") - 1)).alias("_ab"), F.col("_cell").alias("_b"),
        F.col("_block").alias("_bb"), *[F.col(x).alias(x) for x in ("_vid", "_keys", "_vec")])
    task = ["_g", "_a", "_ab", "_b", "_bb"]
    cand = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(
        _block_pair(k, v), f"_g string, _vid {kt}, _d double, _yid {kt}, _ykeys array<{kt}>")
    # the k best rows come from the k best vectors in (distance, smallest key) order
    wv = Window.partitionBy("_g", "_vid").orderBy("_d", "_yid")
    top = cand.withColumn("_r", F.row_number().over(wv)).where(F.col("_r") <= k)
    rws = top.select("_g", "_vid", "_d", F.explode(F.slice("_ykeys", 1, k)).alias("_nk"))
    wr = Window.partitionBy("_g", "_vid").orderBy("_d", "_nk")
    lists = (rws.withColumn("_r", F.row_number().over(wr)).where(F.col("_r") <= k)
             .groupBy("_g", "_vid").agg(F.sort_array(F.collect_list(F.struct("_r", "_nk"))).alias("_lst")))
    known = cut_lineage(placed.select("_g", "_vid", "_keys", "_vec").join(lists, ["_g", "_vid"], "left").select(
        "_g", "_keys", "_vec", F.coalesce(F.transform("_lst", lambda s: s["_nk"]), F.array().cast(f"array<{kt}>")).alias("_other")), "knn-lists")
    # per row: its duplicates in key order, then the nearest other vectors
    own = base.select("_grp", F.coalesce(F.col("_grp").cast("string"), F.lit("")).alias("_g"), "_key", "_vec").join(known, ["_g", "_vec"])
    nn = F.slice(F.concat(F.array_remove("_keys", F.col("_key")), F.col("_other")), 1, k)
    return own.select(F.col("_grp").alias(group), F.col("_key").alias(key), nn.alias("_nn")), var
