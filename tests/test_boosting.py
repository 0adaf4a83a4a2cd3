"""Early stopping of boosted trees (T3) against a loop that fits every number of rounds."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from binscope.operators import models as T


@pytest.fixture(scope="module")
def rows(spark):
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000 for i in range(4)]
    df = spark.range(900).select(*[x.alias(f"x{i}") for i, x in enumerate(h)], "id")
    y = ((F.col("x0") + 0.6 * F.col("x1") + 0.7 * F.col("x2")) > 1.15).cast("int")
    df = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(df.withColumn("y", y))
    return df.select("id", "features", "y", (F.col("id") % 3 == 0).alias("held"), (1.0 + F.col("id") % 2).alias("w")).cache()


def test_best_round():
    assert T.best_round([3, 2, 1], 3) == (3, False)
    assert T.best_round([3, 2, 2, 2.5, 4, 1], 3) == (2, True)
    assert T.best_round([3, 2, 4, 4, 1, 5, 5, 5], 3) == (5, True)
    assert T.best_round([1], 3) == (1, False)


def test_patience_stops_where_a_loop_does(spark, rows, monkeypatch):
    monkeypatch.setattr(T, "FIRST_ROUNDS", 2)   # several doublings
    model = T.fit_gradient_boosted(rows, weight="w", validation="held", learning_rate=0.4, patience=3)
    held, losses, best, at = rows.where("held"), [], float("inf"), 0
    while True:
        one = GBTClassifier(labelCol="y", weightCol="w", stepSize=0.4, maxIter=len(losses) + 1, maxDepth=3, seed=222).fit(rows.where("not held"))
        losses.append(one.evaluateEachIteration(held)[-1])
        if losses[-1] < best:
            best, at = losses[-1], len(losses)
        elif len(losses) - at >= 3:
            break
    assert model.getNumTrees == at and 2 < at < 60
    want = GBTClassifier(labelCol="y", weightCol="w", stepSize=0.4, maxIter=at, maxDepth=3, seed=222).fit(rows.where("not held"))
    a = T.score_model(model, rows, keep=["id"]).orderBy("id").collect()
    b = T.score_model(want, rows, keep=["id"]).orderBy("id").collect()
    assert a == b
    assert model.treeWeights == want.treeWeights


def test_rounds_without_validation_and_saved_model(spark, rows, tmp_path):
    from pyspark.ml.classification import GBTClassificationModel
    model = T.fit_gradient_boosted(rows, n_estimators=3, learning_rate=0.4)
    assert model.getNumTrees == 3
    two = T.first_trees(model, 2)
    two.write().overwrite().save(str(tmp_path / "m"))
    again = GBTClassificationModel.load(str(tmp_path / "m"))
    assert again.getNumTrees == 2
    assert T.score_model(again, rows, keep=["id"]).orderBy("id").collect() == T.score_model(two, rows, keep=["id"]).orderBy("id").collect()


def test_tree_learners_deal_their_rows_over_tasks(spark, monkeypatch):
    """One file of rows is one task's; the learners get them in parts that do not grow with the table."""
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(4000, numPartitions=1).selectExpr("id % 7 AS a", "id % 11 AS b", "double(id % 2) AS y", "id % 5 = 0 AS held")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    seen = []
    for learner in (T.RandomForestClassifier, T.GBTClassifier):
        real = learner.fit

        def fit(self, data, params=None, real=real):
            sizes = [r[1] for r in data.groupBy(F.spark_partition_id()).count().collect()]
            seen.append((data.count(), max(sizes)))
            return real(self, data)
        monkeypatch.setattr(learner, "fit", fit)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 100)
    T.fit_random_forest(rows, n_estimators=2, max_depth=2)
    T.fit_gradient_boosted(rows, n_estimators=2)
    T.fit_gradient_boosted(rows, validation="held", n_estimators=2)
    assert [n for n, _ in seen] == [4000, 4000, 3200]
    assert all(most <= 110 for _, most in seen)
