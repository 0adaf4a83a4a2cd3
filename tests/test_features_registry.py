"""Feature plans (X1-X7) and the run registry."""

import pytest
from pyspark.sql import functions as F

from binscope.operators import features as X
from binscope.operators import registry as N


def test_plan_rules_follow_reference():
    assert [s for _, _, s in X.preprocessing_plan("rf")] == [
        "scale", "impute_mean_scaled", "impute_constant", "onehot"]
    assert [s for _, _, s in X.preprocessing_plan("xgb")] == ["passthrough", "onehot", "passthrough"]
    assert [s for _, _, s in X.preprocessing_plan("xgb", smote=True)][:3] == [
        "impute_mean", "impute_constant", "onehot"]
    assert [s for _, _, s in X.preprocessing_plan("cat", rfe=True)][:3] == [
        "impute_mean", "impute_constant", "onehot"]


def test_prune_param_grid():
    grid = {"feature_selection__n_features_to_select": [10], "classifier__C": [1.0]}
    assert X.prune_param_grid(["rfe"], grid) == grid
    pruned = X.prune_param_grid([], grid)
    assert "feature_selection__n_features_to_select" not in pruned and "classifier__C" in pruned
    assert "feature_selection__n_features_to_select" in grid     # input untouched
    assert X.prune_param_grid([], {}) == {}


def test_scale_then_impute_population_sd(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    st = X.scale_fit(df, ["x"])
    assert st["x"] == (2.0, 1.0)
    assert [r.x for r in X.scale_then_impute(df, st).collect()] == [-1.0, 1.0, 0.0]


def test_onehot_unknown_is_all_zero(spark):
    train = spark.createDataFrame([("b",), ("a",)], "c string")
    cats = X.onehot_fit(train, ["c"])
    assert cats == {"c": ["a", "b"]}
    out = X.onehot_apply(spark.createDataFrame([("a",), ("zzz",), (None,)], "c string"), cats)
    assert [(r.c_a, r.c_b) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_registry_roundtrip(spark, tmp_path):
    reg = N.Registry(spark, str(tmp_path / "reg"))
    rid = reg.get_or_create_run("exp", "lr_orig_training")
    assert reg.get_or_create_run("exp", "lr_orig_training") == rid
    reg.log_metrics(rid, None)
    reg.log_metrics(rid, {})
    reg.log_metrics(rid, {"average_precision": 0.9, "loss": 0.1})
    rid2 = reg.get_or_create_run("exp", "rf_orig_training")
    reg.log_metrics(rid2, {"average_precision": 0.95})
    assert reg.find_best_model("exp", "average_precision") == ("rf_orig_training", "rf")
    assert reg.find_best_model("exp", "average_precision", "min") == ("lr_orig_training", "lr")
    reg.log_params(rid, {"a": 1, "b": 2}, keys=["a"], hyperparameters={"C": 0.5})
    assert {(r.key, r.value) for r in reg.params().collect()} == {("a", "1"), ("C", "0.5")}
    reg.save_state("exp", "prep", "cols", ["x", "y"])
    reg.save_state("exp", "prep", "cols", ["z"])
    assert reg.load_state("exp", "prep", "cols") == ["z"]
    with pytest.raises(LookupError):
        reg.load_state("exp", "prep", "nothing")
    with pytest.raises(LookupError):
        reg.find_best_model("none", "average_precision")
