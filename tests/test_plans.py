"""Preparation (3.1) and training-frame (3.2) plans end to end on sf0.001."""

import pytest
from pyspark.sql import functions as F

from binscope import fixtures as fx
from binscope.operators import clean as C
from binscope.plans.preparation import prepare
from binscope.plans.training import training_frame


def test_prepare_training_then_inference(spark, small_dir):
    raw = fx.wide_raw(spark, small_dir)
    prepared, state = prepare(raw, "row_id", "income", "training", ["money_text"])
    assert state["zero_variance"] == ["constant_col"]
    assert "mostly_missing" not in state["kept_columns"]      # 75 % missing
    assert "edge_missing" in state["kept_columns"]            # exactly 60 %: kept
    assert "row_id" not in state["kept_columns"] and "income" not in state["kept_columns"]
    assert prepared.columns[0] == "row_id" and prepared.columns[-1] == "percentage_missing"
    assert prepared.count() < raw.count()                     # sparse rows filtered
    inf, _ = prepare(raw.drop("income"), "row_id", "income", "inference", ["money_text"], state)
    assert inf.count() == raw.count()                         # no row filter at inference
    with pytest.raises(ValueError):
        prepare(raw, "row_id", "income", "scoring")


def test_training_frame_weights_and_split(spark, small_dir):
    cl = C.encode_label(C.clean_dataframe(fx.wide_raw(spark, small_dir), ["money_text"]),
                        "income", "y")
    tf, names = training_frame(cl, "row_id", "y", ["amount", "balance"], ["race", "sex"], "lr")
    assert names[:2] == ["amount", "balance"] and any(n.startswith("race_") for n in names)
    splits = {r.split for r in tf.select("split").distinct().collect()}
    assert splits == {"train", "valid", "test"}
    assert tf.where(F.col("y").isNull()).count() == 0


def test_the_six_training_pipelines(spark, small_dir):
    import itertools

    raw = fx.wide_raw(spark, small_dir)
    cl = C.encode_label(C.clean_dataframe(raw, ["money_text"]), "income", "y")
    seen = {}
    for how, rfe in itertools.product(("orig", "smote", "under"), (False, True)):
        tf, names = training_frame(cl, "row_id", "y", ["amount", "balance"], ["race", "sex"], "lr", rfe=rfe,
                                   smote=how == "smote", undersample=how == "under", n_features=3)
        n = {(r["split"], r["y"]): r["count"] for r in tf.groupBy("split", "y").count().collect()}
        seen[how, rfe] = n
        assert len(names) == (3 if rfe else len(names)) and (rfe or len(names) > 3)
        assert len(tf.first()["features"]) == len(names)
    orig, smote, under = (seen[h, False] for h in ("orig", "smote", "under"))
    assert all(seen[h, True] == seen[h, False] for h in ("orig", "smote", "under"))
    train = {y: n for (s, y), n in orig.items() if s == "train"}
    assert {n for (s, _), n in smote.items() if s == "train"} == {max(train.values())}
    assert {n for (s, _), n in under.items() if s == "train"} == {min(train.values())}
    for other in (smote, under):
        assert {k: v for k, v in other.items() if k[0] != "train"} == {k: v for k, v in orig.items() if k[0] != "train"}
