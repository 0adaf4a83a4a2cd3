"""Faults of earlier versions: long overflow, NULL groups, NaN, ids, registry errors, fixed types."""

import math

import pytest
from pyspark.sql import functions as F

from binscope.operators import clean as C
from binscope.operators import metrics as M
from binscope.operators import profile as A
from binscope.operators import sample as G
from binscope.operators.models import fit_gradient_boosted
from binscope.operators.registry import RUNS_SCHEMA, Registry
from binscope.plans.preparation import prepare


def test_auc_of_billions_of_rows(spark):
    counts = spark.createDataFrame([("m", 0.9, 4_000_000_000, 1), ("m", 0.1, 1, 4_000_000_000)], "model string, score double, pos long, neg long")
    cum = counts.selectExpr("model", "score", "pos", "neg", "CASE WHEN score > 0.5 THEN 4000000000 ELSE 4000000001 END tp",
                            "CASE WHEN score > 0.5 THEN 1 ELSE 4000000001 END fp", "4000000001 P", "4000000001 N")
    import unittest.mock as mock
    with mock.patch.object(M, "cumulative_counts", lambda *a, **k: cum):
        auc = {r.roc_auc for r in M.roc_curve(counts, ["model"]).collect()}
    assert len(auc) == 1 and abs(auc.pop() - 1) < 1e-6


def test_null_groups_keep_their_curves(spark):
    rows = [(g, i % 2, (i * 7 % 10) / 10) for g in ("A", None) for i in range(20)]
    df = spark.createDataFrame(rows, "model string, y int, p double")
    for f in (M.roc_curve, M.precision_recall_curve, M.calibration_curve):
        seen = {}
        for r in f(df, ["model"]).collect():
            seen.setdefault(r.model, []).append(tuple(r[1:]))
        assert set(seen) == {"A", None} and sorted(map(repr, seen["A"])) == sorted(map(repr, seen[None]))
    bundle = M.evaluation_bundle(df.withColumn("split", F.lit("s")), ["model", "split"])
    assert bundle.where("curve = 'calibration' AND model IS NULL").count() > 0


def test_calibration_brier_is_the_groups(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.9), (1, 0.95)], "y int, p double")
    got = M.calibration_curve(df, []).collect()
    assert all(r.brier == pytest.approx((0.64 + 0.81 + 0.0025) / 3) for r in got)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, math.nan, "x"), (2, 3.0, "y"), (3, None, "z")], "k long, v double, t string")
    clean = C.clean_dataframe(df)
    assert [r.v for r in clean.orderBy("k").collect()] == [None, 3.0, None]
    missing = {r["column"]: r for r in A.column_missing_percent(clean, key="k").collect()}
    assert any(abs(x - 200 / 3) < 0.01 for x in missing["v"] if isinstance(x, float))


@pytest.mark.parametrize("digits", [2, 9, 12])
def test_ids_have_the_wanted_digits(spark, digits):
    ids = [r.census_id for r in C.add_ids(spark.range(60).toDF("k"), "k", num_digits=digits).collect()]
    assert len(set(ids)) == 60 and all(len(str(i)) == digits for i in ids)


def test_too_few_digits_are_an_error(spark):
    with pytest.raises(ValueError):
        C.add_ids(spark.range(91).toDF("k"), "k", num_digits=2)


def test_boosting_rounds_are_passed_through(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(i % 2, float(i % 2) + i / 100) for i in range(20)], "y int, x double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    import unittest.mock as mock
    with mock.patch("binscope.operators.models.GBTClassifier") as gbt:
        fit_gradient_boosted(df, n_estimators=10_000)
    assert gbt.call_args.kwargs["maxIter"] == 10_000


def test_registry_errors_rise_and_absence_is_empty(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "reg"))
    assert reg.table("runs", RUNS_SCHEMA).count() == 0
    (tmp_path / "reg" / "runs").mkdir(parents=True)
    (tmp_path / "reg" / "runs" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):  # noqa: B017
        reg.table("runs", RUNS_SCHEMA).collect()


def test_inference_keeps_the_types_of_training(spark):
    train = spark.createDataFrame([(i, str(i), f"{i},000", "a" if i % 2 else "b", i % 2) for i in range(30)],
                                  "id long, n string, money string, t string, income int")
    got, state = prepare(train, "id", "income", "training", ["money"])
    new = spark.createDataFrame([(1, "x", "7", "a"), (2, "5", "1,5", "b")], "id long, n string, money string, t string")
    out, _ = prepare(new, "id", "income", "inference", ["money"], state)
    for name in set(out.columns) & set(got.columns) - {"id"}:
        assert dict(out.dtypes)[name] == dict(got.dtypes)[name]
    assert [r.n for r in out.orderBy("id").collect()] == [None, 5]


def test_plans_without_nested_loops(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "k long, y int")
    for out in (A.class_balance(df, "y"), G.random_undersample(df, "k", "y"), G.balanced_class_weights(df, "y")):
        assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
