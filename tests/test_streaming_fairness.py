"""Streaming scoring, fairness and explanation operators on small inputs."""

import json
import os
import uuid

from pyspark.sql import functions as F

from binscope import fixtures as fx
from binscope.operators import explain as E
from binscope.operators import fairness as K
from binscope.session import ensure_checkpoint_dir
from binscope.streaming.scoring import start_scoring


def test_stream_scores_every_row(spark, small_dir):
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/test-stream-{uuid.uuid4().hex}"
    src, sink = os.path.join(base, "in"), os.path.join(base, "out")
    rows = fx.wide_raw(spark, small_dir).select("row_id", "amount", "balance", "num_text")
    rows.write.parquet(src)
    coefs = {"amount": 0.00002, "balance": -0.0003}
    q = start_scoring(spark, src, rows.schema, sink, "row_id", {"types": {"num_text": "double"}},
                      coefs, {"amount": 1.0, "balance": 2.0}, -0.25,
                      name=f"t{uuid.uuid4().hex[:8]}", trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == rows.count()
    assert set(out.columns) == {"row_id", "Top 5 Features", "y_pred", "y_pred_proba"}


def test_group_metrics_and_disparities(spark):
    df = spark.createDataFrame(
        [(i, "m", y, p, g) for i, (y, p, g) in enumerate(
            [(1, .9, "A"), (0, .2, "A"), (1, .6, "A"), (0, .7, "B"), (1, .4, "B"), (0, .1, "B")])],
        "id long, model string, y int, p double, grp string")
    sl = K.group_slices(df, ["grp"])
    gm = {r.attribute_value: r for r in K.group_metrics(sl, ["model", "attribute", "attribute_value"]).collect()}
    assert gm["A"]["Accuracy"] == 1.0 and abs(gm["B"]["Accuracy"] - 1 / 3) < 1e-12
    assert gm["A"]["ROC AUC"] == 1.0
    d = {r.attribute_value: r for r in K.group_disparities(
        K.group_metrics(sl, ["model", "attribute", "attribute_value"]),
        ["model", "attribute", "attribute_value"], {"grp": "A"}).collect()}
    assert d["A"]["Accuracy_ratio"] == 1.0 and abs(d["B"]["Accuracy_ratio"] - 1 / 3) < 1e-12


def test_top_contributions_rank_after_rounding(spark):
    df = spark.createDataFrame([(1, 0.004, -0.5, 0.5)], "k int, a double, b double, c double")
    means = {"a": 0.0, "b": 0.0, "c": 0.0}
    coefs = {"a": 1.0, "b": 1.0, "c": 1.0}
    d = E.linear_contributions(df, coefs, means)
    js = E.top_contributions_json(d, ["a", "b", "c"], 2).collect()[0]["Top 2 Features"]
    assert list(json.loads(js).items()) == [("b", 0.5), ("c", 0.5)]   # tie -> earlier feature
    names = E.top_contribution_names(d, ["a", "b", "c"], 3).collect()[0]["Top 3 Features"]
    assert names == "b, c, a"


def test_explanation_table_rejects_bad_hold_out(spark):
    import pytest
    df = spark.createDataFrame([(1, 1.0, 1, "valid")], "k int, a double, y int, split string")
    with pytest.raises(ValueError):
        E.explanation_table(df, "k", ["a"], {"a": 1.0}, {"a": 0.0}, label="y", hold_out="train")
    out = E.explanation_table(df, "k", ["a"], {"a": 1.0}, {"a": 0.0}, label="y", hold_out="valid")
    assert out.collect()[0]["TP"] == 1
    assert F is not None
