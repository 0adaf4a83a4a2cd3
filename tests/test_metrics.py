"""Metrics and curves (M1-M14, T6) against brute force on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from binscope.operators import metrics as M
from binscope.operators.running import running_sums

Y8 = [0, 1, 1, 0, 1, 0, 1, 1]
P8 = [.1, .8, .7, .2, .9, .4, .6, .85]


def frame(spark, ys, ps, model="m"):
    return spark.createDataFrame([(i, model, y, float(p)) for i, (y, p) in enumerate(zip(ys, ps))],
                                 "id long, model string, y int, p double")


def brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def brute_ap(ys, ps):
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(ps), reverse=True):
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_strict_threshold_predict(spark):
    out = M.threshold_predict(frame(spark, Y8, P8), 0.6).orderBy("id")
    assert [r.y_pred for r in out.collect()] == [0, 1, 1, 0, 1, 0, 0, 1]


def test_confusion_and_rates(spark):
    cc = M.confusion_counts(frame(spark, Y8, P8), ["model"], 0.6).collect()[0]
    assert (cc.tn, cc.fp, cc.fn, cc.tp) == (3, 0, 1, 4)
    r = M.classification_rates(frame(spark, Y8, P8), ["model"], 0.6).collect()[0]
    assert r.precision == 1.0 and r.sensitivity == 0.8 and r.specificity == 1.0
    one_class = M.classification_rates(frame(spark, [1, 1], [0.2, 0.3]), ["model"]).collect()[0]
    assert one_class.precision == 0.0 and one_class.specificity is None


@pytest.fixture
def small_buckets(monkeypatch):
    """Force several buckets per group on tiny inputs (the default is ~1M rows each)."""
    from binscope.operators import running
    monkeypatch.setattr(running, "ROWS_PER_BUCKET", 7)


@pytest.mark.parametrize("n_buckets", [1, 4, 64])
def test_auc_ap_match_brute_force_with_ties(spark, n_buckets, small_buckets):
    rnd = random.Random(7)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ps = [round(rnd.random(), 1) for _ in range(300)]     # many ties
    s = M.score_summary(frame(spark, ys, ps), ["model"], n_buckets=n_buckets).collect()[0]
    assert abs(s.roc_auc - brute_auc(ys, ps)) < 1e-12
    assert abs(s.average_precision - brute_ap(ys, ps)) < 1e-12
    flipped = frame(spark, ys, [1 - p for p in ps])
    s2 = M.score_summary(flipped, ["model"], n_buckets=n_buckets).collect()[0]
    assert abs(s2.roc_auc - (1 - s.roc_auc)) < 1e-12


def test_one_class_group_has_null_auc(spark):
    s = M.score_summary(frame(spark, [1, 1, 1], [.1, .8, .7]), ["model"]).collect()[0]
    assert s.roc_auc is None


def test_running_sums_bucketed_equals_plain_window(spark, small_buckets):
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(0, 5)) for g in ("a", "b") for v in rnd.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    a = {(r.g, r.v): r.cum_w for r in running_sums(df, ["g"], "v", ["w"], n_buckets=1).collect()}
    b = {(r.g, r.v): r.cum_w for r in running_sums(df, ["g"], "v", ["w"], n_buckets=32).collect()}
    assert a == b
    from binscope.operators import running
    placed = running.in_buckets(df, ["g"], [F.col("v")], 3)
    sizes = placed.groupBy("g", "_bucket").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("g", "_bucket").collect()
    assert len(sizes) >= 200 and max(r.n for r in sizes) <= 7
    assert all(x.hi < y.lo for x, y in zip(sizes, sizes[1:]) if x.g == y.g)   # stretches of the order


def test_running_sums_with_10000_buckets_a_group(spark, monkeypatch):
    from binscope.operators import running
    monkeypatch.setattr(running, "ROWS_PER_BUCKET", 3)
    df = spark.range(60_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"), (F.col("id") % 10).alias("w"))
    got = running_sums(df, ["g"], "v", ["w"], descending=False)
    assert "array" not in got._jdf.queryExecution().toString().lower()   # no bounds in any row
    assert running.in_buckets(df, ["g"], [F.col("v")]).filter("g = 0").select("_bucket").distinct().count() >= 10_000
    plain = running_sums(df, ["g"], "v", ["w"], descending=False, n_buckets=1)
    assert got.exceptAll(plain).count() == 0 and got.count() == 60_000


def test_running_sums_of_many_groups_and_buckets(spark, monkeypatch):
    from binscope.operators import running
    monkeypatch.setattr(running, "ROWS_PER_BUCKET", 3)
    df = spark.range(10_100).select((F.col("id") % 10_001).cast("string").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    big = spark.range(1_500).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    got = running_sums(df.union(big), ["g"], "v", ["w"])
    assert got.count() == 11_600
    big = got.where("g IS NULL").collect()
    assert all(r.cum_w == 1500 - r.v and r.tot_w == 1500 for r in big)   # 500 buckets
    assert got.where("g IS NOT NULL").agg(F.max("cum_w")).first()[0] == 2


def test_curves_and_calibration(spark):
    df = frame(spark, Y8, P8)
    roc = M.roc_curve(df, ["model"]).collect()
    assert len(roc) == len(set(P8)) + 1
    assert abs(roc[0].roc_auc - brute_auc(Y8, P8)) < 1e-12
    pr = M.precision_recall_curve(df, ["model"]).orderBy(F.desc("recall")).collect()
    assert any(r.recall == 0.0 and r.precision == 1.0 for r in pr)
    cal = {r.bin: r for r in M.calibration_curve(
        spark.createDataFrame([(1, "m", 1, 0.1), (2, "m", 0, 0.2), (3, "m", 1, 0.95)],
                              "id long, model string, y int, p double"), ["model"], 10).collect()}
    assert set(cal) == {0, 1, 9}      # 0.1 and 0.2 sit on inner edges -> lower bins
    tm = M.threshold_metrics(df, ["model"]).where(F.col("threshold") == 0.7).collect()[0]
    assert abs(tm.precision - 1.0) < 1e-12 and abs(tm.recall - 0.8) < 1e-12


def test_metrics_report_mean_of_rounded(spark):
    df = frame(spark, Y8, P8, "a").unionByName(frame(spark, Y8, [1 - p for p in P8], "b"))
    rep = {r.metric: r for r in M.metrics_report(df, ["model"], models=["a", "b"]).collect()}
    assert set(rep) == set(M.REPORT_METRICS)
    r = rep["AUC ROC"]
    assert r.Mean == round((r.a + r.b) / 2, 3)


def test_optimal_threshold_falls_back(spark):
    out = M.optimal_threshold(frame(spark, Y8, P8), ["model"], target_precision=0.5,
                              delta=0.0001).collect()[0]
    assert out.threshold == 0.5 and out.beta is None


def test_split_metrics_names(spark):
    df = frame(spark, Y8, P8).withColumn("split", F.lit("valid"))
    names = {r.metric for r in M.split_metrics(df, ["model"]).collect()}
    assert "valid AUC ROC" in names and len(names) == 6
