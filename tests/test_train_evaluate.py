"""Grid search with feature elimination inside (T4) and the train-and-evaluate chain."""

import random
import threading

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from binscope.operators import metrics as M
from binscope.operators import models as T
from binscope.operators.registry import Registry
from binscope.plans.evaluation import train_and_evaluate

NAMES = [f"x{i}" for i in range(6)]
GRID = {"C": [0.001, 1.0], T.RFE_KEY: [2, 1.0]}


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        y = int(r.random() < 0.4)
        x = [r.gauss(1.5 * y, 1), r.gauss(-y, 1)] + [r.gauss(0, 1) for _ in range(4)]
        rows.append((i, float(y), ["train", "train", "train", "valid", "test"][i % 5], 1.0, *x))
    df = spark.createDataFrame(rows, "row_id long, y double, split string, weight double, " + ", ".join(f"{n} double" for n in NAMES))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).drop(*NAMES)


def fit(d, **p):
    return T.fit_logistic(d, weight="weight", **p)


def test_full_grid_with_elimination_in_a_pool(frame):
    train, valid = (frame.where(F.col("split") == s).cache() for s in ("train", "valid"))
    asked, lock, meet = [], threading.Lock(), threading.Barrier(2, timeout=60)

    def select(rows, n):
        with lock:
            asked.append(n)
        meet.wait()  # both settings are under way at once
        return T.rfe_on_vectors(rows, NAMES, n)[1]

    model, params, tried = T.random_grid_search(train, valid, fit, GRID, None, select_fn=select, workers=2)
    rows = tried.orderBy("point").collect()
    assert sorted(asked, key=str) == [1.0, 2] and len(rows) == 4 and len({r.params for r in rows}) == 4
    # the same, one after the other and by hand
    best = None
    for r, p in zip(rows, T.sample_grid(GRID, None), strict=True):
        cut = T.rfe_on_vectors(train, NAMES, p[T.RFE_KEY])[1]
        scored = T.score_model(fit(cut(train), C=p["C"]), cut(valid), keep=["y"])
        data = sorted(((x.predicted_probas, x.y) for x in scored.collect()), reverse=True)
        n_pos, tp, ap = sum(y for _, y in data), 0, 0.0
        for k, (_, y) in enumerate(data, 1):
            tp += y
            ap += y / n_pos * tp / k
        assert r.params == repr(p) and abs(r.average_precision - ap) < 1e-6
        if best is None or r.average_precision > best[0]:
            best = (r.average_precision, p)
    assert params == best[1]
    assert model.numFeatures == (2 if params[T.RFE_KEY] == 2 else 6)


def test_elimination_keeps_what_tells_and_cuts_vectors(frame):
    kept, cut = T.rfe_on_vectors(frame, NAMES, 2)
    assert kept == ["x0", "x1"]
    a, b = frame.orderBy("row_id").first().features, cut(frame).orderBy("row_id").first().features
    assert b.toArray().tolist() == a.toArray().tolist()[:2]


def test_keys_of_the_elimination_are_left_out_without_it(frame):
    train, valid = (frame.where(F.col("split") == s) for s in ("train", "valid"))
    _, params, tried = T.random_grid_search(train, valid, fit, GRID, None)
    assert tried.count() == 2 and set(params) == {"C"}


def test_chain_logs_what_it_returns(spark, frame, tmp_path):
    reg = Registry(spark, str(tmp_path))
    out = train_and_evaluate(frame, NAMES, reg, "e", "lr_rfe", fit, GRID, None, rfe=True, workers=2)
    got = {r.metric: r.value for r in out.collect()}
    run_id = reg.get_or_create_run("e", "lr_rfe")
    assert {r.key: r.value for r in reg.metrics().collect()} == got and len(got) == 18
    assert max(v for k, v in got.items() if k.startswith("test ")) > 0.8
    params = {r.key: r.value for r in reg.params().collect()}
    kept = reg.load_state("e", "lr_rfe", "features")
    model = reg.load_model(run_id, LogisticRegressionModel)
    assert model.numFeatures == len(kept) and {"threshold", "beta", "C", T.RFE_KEY} <= set(params)
    # the stored model, calibrated anew, has the threshold and metrics that were logged
    at = [NAMES.index(n) for n in kept]
    from pyspark.ml.feature import VectorSlicer
    data = VectorSlicer(inputCol="features", outputCol="f", indices=at).transform(frame).drop("features").withColumnRenamed("f", "features")
    scored = T.score_model(model, data, keep=["row_id", "y", "split"])
    rows = T.calibrate_scores(scored.where("split = 'valid'"), "sigmoid")(scored).select(
        F.lit("lr_rfe").alias("run_name"), F.col("y").cast("int").alias("y"), "split", F.col("calibrated").alias("p"))
    best = M.optimal_threshold(rows.where("split = 'valid'"), ["run_name"]).first()
    assert abs(float(params["threshold"]) - best["threshold"]) < 1e-9
    again = {r.metric: r.value for r in M.split_metrics(rows, ["run_name"], "split", best["threshold"]).collect()}
    assert again == got


def test_chain_without_valid_rows(spark, frame, tmp_path):
    with pytest.raises(ValueError, match="no point"):
        train_and_evaluate(frame.where("split <> 'valid'"), NAMES, Registry(spark, str(tmp_path)), "e", "lr", fit, {"C": [1.0]}, None)


def test_targets_share_the_rounds_of_an_elimination():
    from binscope.operators.features import Elimination
    r = random.Random(8)
    total, step = 23, 0.13
    fits = []

    def fit(kept):
        fits.append(tuple(kept))
        s = random.Random(repr(kept))
        return [s.choice((-1, 0.5, 1, s.random())) for _ in kept]

    def alone(target):
        """One target by itself, as the elimination is described."""
        keep, n = list(range(total)), 0
        while len(keep) > target:
            coefs = fit(keep)
            drop = min(int(step * total), len(keep) - target)
            order = sorted(range(len(keep)), key=lambda i: (coefs[i] ** 2, i))
            keep, n = [k for i, k in enumerate(keep) if i not in order[:drop]], n + 1
        return keep, n
    targets = [10, 1, 0.5, 1.0, 0.1, 22, 4, 1]
    r.shuffle(targets)
    course = Elimination(fit, total, step)
    got = [course.kept(t) for t in targets]
    assert len(fits) == len(set(fits))  # no round twice
    n_shared = len(fits)
    want = [alone(int(t * total) if isinstance(t, float) else t) for t in targets]
    assert got == [k for k, _ in want]
    assert n_shared == max(n for _, n in want) < sum(n for _, n in want)


def test_chain_deals_its_rows_over_tasks_and_fits_no_round_twice(frame, spark, monkeypatch, tmp_path):
    """The written frame is a few splits; every logistic fit gets its rows in parts that do not grow with the table."""
    from pyspark.ml.classification import LogisticRegression
    real, seen, lock = LogisticRegression.fit, [], threading.Lock()

    def counted(self, data, params=None):
        sizes = [r[1] for r in data.groupBy(F.spark_partition_id()).count().collect()]
        with lock:
            seen.append((sum(sizes), max(sizes)))
        return real(self, data)
    monkeypatch.setattr(LogisticRegression, "fit", counted)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 50)
    # all rows in one file
    train_and_evaluate(frame.coalesce(1), NAMES, Registry(spark, str(tmp_path)), "e", "lr_rfe", fit, {"C": [0.01, 1.0], T.RFE_KEY: [2, 3, 1.0]},
                       None, rfe=True, workers=2)
    # four rounds from six features to two, six points, one calibration
    assert sorted(n for n, _ in seen) == [180] + [540] * 10
    assert all(most <= 60 for _, most in seen)


def test_columns_are_eliminated_over_dealt_rows(frame, spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    from binscope.operators.features import rfe_select
    real, seen = LogisticRegression.fit, []

    def counted(self, data, params=None):
        seen.append(max(r[1] for r in data.groupBy(F.spark_partition_id()).count().collect()))
        return real(self, data)
    monkeypatch.setattr(LogisticRegression, "fit", counted)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 100)
    wide = frame.select("y", *[vector_to_array("features")[i].alias(n) for i, n in enumerate(NAMES)]).coalesce(1)
    assert rfe_select(wide, NAMES, "y", 2) == ["x0", "x1"]
    assert len(seen) == 4 and max(seen) <= 120
