"""Model fitting, tuning, calibration and scoring (T1-T5, T7 fitted form).

Fits are ``pyspark.ml`` estimators: each one is a distributed job over the
assembled feature vectors; the tuning loop is a handful of fits
(one per sampled grid point, a pool of them at a time), each scored by the same distributed average
precision as the metric tables. Options the reference exposes that Spark has
no counterpart for are refused, not silently ignored.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binscope.operators import metrics as M
from binscope.operators.features import Elimination

# The hyper-parameter grids of the reference's model definitions.
LR_GRID = {
    "C": [10 ** (-4 + 4 * i / 9) for i in range(10)],  # logspace(-4, 0, 10)
    "penalty": ["l2"],
    "feature_selection_RFE__n_features_to_select": [10, 0.1, 0.5, 0.7, 1.0],
}
RF_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [None, 5, 10],
    "criterion": ["gini", "entropy"],
    "feature_selection_RFE__n_features_to_select": [10, 0.1, 0.5, 0.7, 1.0],
}
SPARK_MAX_DEPTH = 30  # depth "None" maps to Spark's maximum tree depth


#: Rows that a task of a fit holds at most.
ROWS_PER_TASK = 200_000


def spread_rows(rows: DataFrame) -> DataFrame:
    """``rows``, dealt evenly over tasks whose number grows with the rows (full rounds of the session's
    cores) where one task has more than ``ROWS_PER_TASK`` of them.

    Files of well-compressing columns come in few, uneven splits. The learners keep the rows of a
    task as points that are larger than in the file (a forest's many times, with a count for each tree)
    and read all of them in every pass."""
    sizes = rows.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"), F.sum("count")).first()
    if (sizes[0] or 0) <= ROWS_PER_TASK:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # a tenth fewer, as tasks dealt in turn differ by some rows and must not be dealt again
    return rows.repartition(cores * math.ceil(sizes[1] / (0.9 * ROWS_PER_TASK) / cores))


@contextmanager
def dealt(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` for several fits: where ``spread_rows`` deals them this is done once, and they are kept on the
    executors' disks meanwhile (memory is for the points of the fits)."""
    out = spread_rows(rows)
    if out is rows:
        yield rows
        return
    out.persist(StorageLevel.DISK_ONLY)
    try:
        yield out
    finally:
        out.unpersist()


def fit_logistic(train: DataFrame, features: str = "features", label: str = "y",
                 weight: str | None = None, C: float = 1.0, penalty: str = "l2",
                 max_iter: int = 100):
    """L2 logistic regression. sklearn's ``C`` maps to
    ``regParam = 1 / (C * sum of weights)`` (Spark averages the loss)."""
    if penalty != "l2":
        raise ValueError("only the l2 penalty is offered")
    rows = spread_rows(train.select(features, label, *([weight] if weight else [])))
    wsum = (train.agg(F.sum(weight)).collect()[0][0] if weight
            else train.count())
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=1.0 / (C * float(wsum)), elasticNetParam=0.0,
                            standardization=False, **({"weightCol": weight} if weight else {}))
    return lr.fit(rows)


def fit_random_forest(train: DataFrame, features: str = "features", label: str = "y",
                      weight: str | None = None, n_estimators: int = 100,
                      max_depth: int | None = None, criterion: str = "gini", seed: int = 222):
    """Random forest; depth None -> Spark's maximum (30)."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_estimators,
                                maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth,
                                impurity=criterion, seed=seed,
                                **({"weightCol": weight} if weight else {}))
    return rf.fit(spread_rows(train.select(features, label, *([weight] if weight else []))))


FIRST_ROUNDS = 32  # trees of the first ensemble that is grown for early stopping


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Number of rounds with the least validation loss (the first of them), looking no further than ``patience``
    rounds without a lesser one, and whether such a stop was reached."""
    best, at = math.inf, -1
    for i, x in enumerate(losses):
        if x < best:
            best, at = x, i
        elif i - at >= patience:
            return at + 1, True
    return at + 1, False


def first_trees(model, rounds: int):
    """The boosted model of the first ``rounds`` trees."""
    spark = SparkSession.getActiveSession()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    java = model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(java.treeWeights()[i])
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    for name in ("featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        cut.set(name, java.getOrDefault(java.getParam(name)))
    return GBTClassificationModel(cut)


def fit_gradient_boosted(train: DataFrame, features: str = "features", label: str = "y",
                         weight: str | None = None, validation: str | None = None,
                         learning_rate: float = 0.01, n_estimators: int = 10000,
                         max_depth: int = 3, subsample: float = 1.0, patience: int = 3,
                         seed: int = 222, **options):
    """Boosted trees that stop after ``patience`` rounds without a lesser loss on the rows
    flagged by the ``validation`` column, with at most ``n_estimators`` rounds; without a
    validation column all rounds are fitted.

    Spark grows an ensemble of a fixed size, and one of more rounds begins with the
    same trees (a tree depends on the trees before it and the seed). So an ensemble of
    ``FIRST_ROUNDS`` trees is grown, the validation loss of every prefix is taken in one pass
    over the rows (``evaluateEachIteration``), and where the stop lies beyond them the size is
    doubled: at most twice the trees of the last ensemble, one pass of the
    validation rows for each size. The model is cut to the best round."""
    if options:
        raise ValueError(f"options without a Spark counterpart: {sorted(options)}")

    used = [features, label, *([weight] if weight else [])]

    def grow(rows: DataFrame, rounds: int):
        return GBTClassifier(featuresCol=features, labelCol=label, stepSize=learning_rate,
                             maxIter=rounds, maxDepth=max_depth, subsamplingRate=subsample, seed=seed,
                             **({"weightCol": weight} if weight else {})).fit(rows)

    if validation is None:
        return grow(spread_rows(train.select(*used)), n_estimators)
    fitted, held = spread_rows(train.where(~F.col(validation)).select(*used)), train.where(validation)
    rounds = min(FIRST_ROUNDS, n_estimators)
    while True:
        model = grow(fitted, rounds)
        best, stopped = best_round(model.evaluateEachIteration(held), patience)
        if stopped or rounds >= n_estimators:
            return first_trees(model, max(best, 1))
        rounds = min(rounds * 2, n_estimators)


def score_model(model, df: DataFrame, threshold: float | dict | None = None,
                scoring: str = "average_precision", keep: list[str] | None = None) -> DataFrame:
    """T7 (fitted): ``predicted_probas`` = P(class 1) from the probability
    vector, ``predictions`` = probability > the stored threshold for
    ``scoring`` (0.5 when none is stored)."""
    t = threshold.get(scoring, 0.5) if isinstance(threshold, dict) else threshold
    t = 0.5 if t is None else float(t)
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select(*(keep or []), p.alias("predicted_probas"),
                      (p > F.lit(t)).cast("int").alias("predictions"))


def sample_grid(grid: dict, n_iter: int = 1, seed: int = 222, exclude_prefix: str | None = None
                ) -> list[dict]:
    """Seeded random draw of ``n_iter`` distinct points from the full grid
    (``n_iter=None`` -> the full grid)."""
    keys = [k for k in grid if not (exclude_prefix and k.startswith(exclude_prefix))]
    points = [dict(zip(keys, v)) for v in itertools.product(*[grid[k] for k in keys])]
    if n_iter is None or n_iter >= len(points):
        return points
    return random.Random(seed).sample(points, n_iter)


#: Key prefix of the parameters that belong to the feature elimination, and the one that is tuned.
RFE_PREFIX = "feature_selection"
RFE_KEY = "feature_selection_RFE__n_features_to_select"


def elimination_fit(rows: DataFrame, total: int, features: str, label: str, weight: str | None = None, max_iter: int = 100):
    """A function kept -> coefficients (one distributed logistic fit on these of the ``total`` places of
    ``features``) for ``Elimination``."""
    def fit(kept: list[int]) -> list[float]:
        slicer = VectorSlicer(inputCol=features, outputCol="_kept", indices=kept)
        part, used = (rows, features) if len(kept) == total else (slicer.transform(rows), "_kept")
        lr = LogisticRegression(featuresCol=used, labelCol=label, maxIter=max_iter, standardization=False,
                                **({"weightCol": weight} if weight else {}))
        return lr.fit(part.select(used, label, *([weight] if weight else []))).coefficients.toArray().tolist()
    return fit


def shared_elimination(train: DataFrame, names: list[str], features: str = "features", label: str = "y",
                       weight: str | None = None, step: float = 0.1):
    """X8 over assembled vectors for several settings, which share their rounds (``Elimination``): a function
    n_features -> kept names, and a function DataFrame -> DataFrame that cuts ``features`` down to them.
    Every round reads ``train`` (``dealt`` is made for that)."""
    course = Elimination(elimination_fit(train, len(names), features, label, weight), len(names), step)

    def select(n_features: int | float):
        kept = course.kept(n_features)
        slicer = VectorSlicer(inputCol=features, outputCol="_kept", indices=kept)

        def cut(df: DataFrame) -> DataFrame:
            return slicer.transform(df).drop(features).withColumnRenamed("_kept", features)
        return [names[i] for i in kept], cut
    return select


def rfe_on_vectors(train: DataFrame, names: list[str], n_features: int | float, features: str = "features",
                   label: str = "y", weight: str | None = None, step: float = 0.1):
    """``shared_elimination`` for one setting."""
    with dealt(train.select(features, label, *([weight] if weight else []))) as rows:
        return shared_elimination(rows, names, features, label, weight, step)(n_features)


def random_grid_search(train: DataFrame, valid: DataFrame, fit_fn, grid: dict, n_iter: int | None = 1,
                       seed: int = 222, label: str = "y", key: str | None = None, select_fn=None, workers: int = 1):
    """T4: fit one model per sampled grid point on ``train``, score ``valid`` by
    step-wise average precision (not Spark's trapezoid ``areaUnderPR``) and keep
    the best (of equals the first point). Returns (best_model, best_params, table of tried points).

    ``n_iter=None`` tries the full grid. With ``select_fn(train, n_features)``, which gives a
    function DataFrame -> DataFrame, the feature elimination is an inner stage: its key is
    tuned like the others, each of its settings is fitted once and shared by the points that have it.
    Without it the elimination's keys are left out. Up to ``workers`` fits run as concurrent Spark jobs; write
    ``train`` and ``valid`` before (``cut_lineage``), as every fit reads them. The train rows are dealt once
    for all fits (``dealt``)."""
    with dealt(train) as rows:
        return _search(rows, valid, fit_fn, grid, n_iter, seed, label, select_fn, workers)


def _search(train: DataFrame, valid: DataFrame, fit_fn, grid: dict, n_iter: int | None, seed: int, label: str,
            select_fn, workers: int):
    spark = train.sparkSession
    points = sample_grid(grid, n_iter, seed, None if select_fn else RFE_PREFIX)

    def run(work, items: list) -> list:
        with ThreadPoolExecutor(max(1, workers)) as pool:
            # the session's local properties go along into the threads
            return list(pool.map(inheritable_thread_target(spark)(work), items))

    settings = sorted({p[RFE_KEY] for p in points}, key=str) if select_fn and RFE_KEY in grid else []
    cuts = dict(zip(settings, run(lambda n: select_fn(train, n), settings)))

    def attempt(params: dict):
        cut = cuts.get(params.get(RFE_KEY), lambda d: d)
        model = fit_fn(cut(train), **{k: v for k, v in params.items() if not k.startswith(RFE_PREFIX)})
        s = score_model(model, cut(valid), keep=[label]).withColumn("_m", F.lit("m"))
        found = M.average_precision(s, ["_m"], label, "predicted_probas").first()
        return model, found[1] if found else None  # None: no row to score

    tried, best = [], (None, None, -math.inf)
    for i, (params, (model, ap)) in enumerate(zip(points, run(attempt, points))):
        tried.append((i, repr(params), float(ap) if ap is not None else None))
        if ap is not None and ap > best[2]:
            best = (model, params, ap)
    table = spark.createDataFrame(tried, "point int, params string, average_precision double")
    return best[0], best[1], table


def calibrate_scores(valid_scored: DataFrame, method: str = "sigmoid", label: str = "y",
                     score: str = "predicted_probas"):
    """T5: fit a calibrator on validation scores. ``sigmoid`` = one-feature
    logistic fit on the score; ``isotonic`` = ``ml.IsotonicRegression``.
    Returns a function DataFrame -> DataFrame adding ``calibrated``."""
    va = VectorAssembler(inputCols=[score], outputCol="_s")
    data = va.transform(valid_scored.select(score, label))
    if method == "sigmoid":
        m = LogisticRegression(featuresCol="_s", labelCol=label, regParam=0.0).fit(spread_rows(data.select("_s", label)))
        a, b = float(m.coefficients[0]), float(m.intercept)

        def apply(df: DataFrame) -> DataFrame:
            z = F.lit(a) * F.col(score) + F.lit(b)
            return df.withColumn("calibrated", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
        return apply
    if method == "isotonic":
        iso = IsotonicRegression(featuresCol="_s", labelCol=label,
                                 predictionCol="calibrated").fit(data)

        def apply_iso(df: DataFrame) -> DataFrame:
            return iso.transform(va.transform(df)).drop("_s")
        return apply_iso
    raise ValueError("method must be 'sigmoid' or 'isotonic'")
