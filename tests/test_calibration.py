"""Calibration (T5) and threshold search on hull points (T6) against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from binscope.operators import metrics as M
from binscope.operators import models as T


def _scored(spark, seed, n=400, digits=2):
    r = random.Random(seed)
    rows = [(round(r.random(), digits),) for _ in range(n)]
    return spark.createDataFrame([(p, int(r.random() < p * p)) for p, in rows], "predicted_probas double, y int")


def test_sigmoid_has_no_gradient_left(spark):
    df = _scored(spark, 1)
    rows = T.calibrate_scores(df, "sigmoid")(df).collect()
    g0 = sum(r.calibrated - r.y for r in rows) / len(rows)
    g1 = sum((r.calibrated - r.y) * r.predicted_probas for r in rows) / len(rows)
    assert abs(g0) < 1e-4 and abs(g1) < 1e-4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_isotonic_equals_max_min_formula(spark, seed):
    df = _scored(spark, seed)
    got = {r.predicted_probas: r.calibrated for r in T.calibrate_scores(df, "isotonic")(df).collect()}
    by: dict[float, list[int]] = {}
    for r in df.collect():
        by.setdefault(r.predicted_probas, []).append(r.y)
    xs = sorted(by)
    for i, x in enumerate(xs):
        want = max(min(sum(sum(by[v]) for v in xs[a:b + 1]) / sum(len(by[v]) for v in xs[a:b + 1]) for b in range(i, len(xs))) for a in range(i + 1))
        assert math.isclose(got[x], want, abs_tol=1e-9)
    values = [got[x] for x in xs]
    assert values == sorted(values)


@pytest.mark.parametrize("seed, digits", [(1, 1), (2, 3), (3, 5)])
def test_threshold_search_asks_hull_points_only(spark, seed, digits):
    r = random.Random(seed)
    rows = [(g, r.choice(["x", None]), int(r.random() < p), p) for g in "ab" for p in [round(r.random(), digits) for _ in range(900)]]
    rows += [("c", "x", 0, 0.3), ("c", "x", 0, 0.9)]
    df = spark.createDataFrame(rows, "model string, split string, y int, p double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(x.model, x.split): (x.threshold, x.beta, x.precision) for x in M.optimal_threshold(df, ["model", "split"], target_precision=0.6).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for key in {(g, s) for g, s, _, _ in rows}:
        own = [(y, p) for g, s, y, p in rows if (g, s) == key]
        want = (0.5, None, None)
        for beta in M.beta_grid():
            best = None
            for t in sorted({p for _, p in own}):
                tp, fp = sum(y for y, p in own if p >= t), sum(1 - y for y, p in own if p >= t)
                pos = sum(y for y, _ in own)
                f = (1 + beta * beta) * tp / (tp + fp + beta * beta * pos) if tp + fp + beta * beta * pos else 0.0
                if best is None or f >= best[0] - 1e-12:
                    best = (f, t, tp / (tp + fp))
            if abs(best[2] - 0.6) <= 0.01:
                want = (best[1], beta, best[2])
                break
        assert got[key][0] == want[0] and got[key][1] == pytest.approx(want[1]) if want[1] else got[key][:2] == want[:2], key


def test_a_hull_is_a_small_part_of_the_thresholds(spark):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(10**6)) / 10**6).alias("p"), F.lit("m").alias("model"))
    df = df.withColumn("y", (F.rand(5) < F.col("p")).cast("int"))
    cum = M.cumulative_counts(df, ["model"]).select("model", F.col("fp").alias("_fp"), F.col("tp").alias("_tp"))
    assert cum.mapInArrow(M._hull_rows(["model"]), cum.schema).count() < 1000
