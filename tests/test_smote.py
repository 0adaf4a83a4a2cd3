"""Exact neighbour lists against brute force, and SMOTE invariants."""

import numpy as np
from pyspark.sql import functions as F

from binscope import fixtures as fx
from binscope.operators import neighbours as NB
from binscope.operators.sample import smote_oversample

DIMS = 4


def _points(spark, small_dir):
    """Embedding prefixes of sf0.001 in two groups, plus exact copies of some
    rows (duplicate vectors) and a group with only three rows."""
    v = fx.vectors(spark, small_dir)
    cols = [F.col("embedding")[j].cast("double").alias(f"e{j}") for j in range(DIMS)]
    base = v.select("vec_id", (F.col("label") % 2).alias("grp"), *cols)
    dups = base.where(F.col("vec_id") % 7 == 0).withColumn("vec_id", F.col("vec_id") + 100_000)
    dups3 = base.where(F.col("vec_id") % 21 == 0).withColumn("vec_id", F.col("vec_id") + 200_000)
    tiny = base.where(F.col("label") == 4).limit(3).withColumn("grp", F.lit(9).cast("long"))
    tiny = tiny.withColumn("vec_id", F.col("vec_id") + 300_000)
    return base.unionByName(dups).unionByName(dups3).unionByName(tiny)


def _brute(rows, var, k):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for grp, rs in by.items():
        ids = np.array([r[0] for r in rs])
        X = np.array([list(r[2:]) for r in rs])
        for i, q in enumerate(ids):
            d = np.zeros(len(ids))
            for j in range(X.shape[1]):
                d = d + (X[i, j] - X[:, j]) * (X[i, j] - X[:, j]) / var[j]
            order = sorted((d[t], int(ids[t])) for t in range(len(ids)) if t != i)
            out[int(q)] = [b for _, b in order[:k]]
    return out


def _check(spark, small_dir, k=5):
    pts = _points(spark, small_dir)
    names = [f"e{j}" for j in range(DIMS)]
    nn, var = NB.knn_lists(pts, "vec_id", "grp", names, k)
    got = {r["vec_id"]: list(r["_nn"]) for r in nn.collect()}
    rows = [tuple(r) for r in pts.select("vec_id", "grp", *names).collect()]
    want = _brute(rows, var, k)
    assert got == want


def test_knn_exact_with_duplicates_and_small_group(spark, small_dir):
    _check(spark, small_dir)


def test_knn_exact_with_many_cells_and_blocks(spark, small_dir, monkeypatch):
    # tiny blocks: many cells, block pairs and merges
    monkeypatch.setattr(NB, "BLOCK_ROWS", 9)
    _check(spark, small_dir, k=3)
    # few pivots for many blocks: cells are split on both sides
    monkeypatch.setattr(NB, "MAX_PIVOTS", 2)
    _check(spark, small_dir, k=3)


def test_far_cells_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(NB, "BLOCK_ROWS", 20)
    rows = [(i, 0, float(i % 10) * 1000 + (i // 10) * 0.01, 1.0) for i in range(200)]
    pairs = []
    real = NB._block_pair
    monkeypatch.setattr(NB, "_block_pair", lambda k, v: pairs.append(1) or real(k, v))
    nn, _ = NB.knn_lists(spark.createDataFrame(rows, "vec_id long, grp int, a double, b double"), "vec_id", "grp", ["a", "b"], 2)
    got = {r["vec_id"]: [i % 10 for i in r["_nn"]] for r in nn.collect()}
    assert all(v == [k % 10] * 2 for k, v in got.items()) and len(got) == 200


def test_all_64_dimensions(spark, small_dir):
    v = fx.vectors(spark, small_dir).limit(60)
    names = [f"e{j}" for j in range(64)]
    pts = v.select("vec_id", F.lit(0).alias("grp"), *[F.col("embedding")[j].cast("double").alias(n) for j, n in enumerate(names)])
    nn, var = NB.knn_lists(pts, "vec_id", "grp", names, 5)
    rows = [tuple(r) for r in pts.select("vec_id", "grp", *names).collect()]
    assert {r["vec_id"]: list(r["_nn"]) for r in nn.collect()} == _brute(rows, var, 5)


def test_smote_balances_and_interpolates(spark, small_dir):
    v = fx.vectors(spark, small_dir)
    names = [f"e{j}" for j in range(DIMS)]
    wide = v.select("vec_id", "y", *[F.col("embedding")[j].cast("double").alias(n)
                                     for j, n in enumerate(names)])
    out = smote_oversample(wide, "vec_id", "y", names, k=5, seed=222)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert len(set(counts.values())) == 1
    orig = {r["vec_id"]: [r[n] for n in names] for r in wide.collect()}
    nn, _ = NB.knn_lists(wide.where("y = 1"), "vec_id", "y", names, 5,
                         variances=list(wide.agg(*[F.var_samp(n) for n in names]).first()))
    lists = {r["vec_id"]: list(r["_nn"]) for r in nn.collect()}
    syn = out.where("synthetic = 1").collect()
    assert len(syn) == counts[0] - wide.where("y = 1").count()
    assert sorted(r["synth_no"] for r in syn) == list(range(len(syn)))
    assert all(r["vec_id"] < 0 for r in syn)
    for r in syn:
        assert r["nn_key"] in lists[r["base_key"]]
        x, n = np.array(orig[r["base_key"]]), np.array(orig[r["nn_key"]])
        s = np.array([r[c] for c in names])
        lam = (s - x) / np.where(n != x, n - x, 1)
        lam = lam[n != x]
        assert np.all((lam > -1e-9) & (lam < 1 + 1e-9)) and np.allclose(lam, lam[0], atol=1e-6)
