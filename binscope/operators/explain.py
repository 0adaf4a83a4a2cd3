"""Per-row explanations and coefficient scoring (E1-E4, T7 coefficient form).

The reference explains tree models with a per-row solver library; here the
explanation is re-aimed at linear models, where ``coef * (x - mean)`` is the
exact additive contribution. Everything is a per-row projection (array sort,
``to_json``): no shuffle, no explode, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.functions.exprs import c, np_round
from binscope.operators.metrics import row_outcome_flags
from binscope.operators.reshape import top_k_per_row


def linear_contributions(df: DataFrame, coefs: dict[str, float], means: dict[str, float],
                         prefix: str = "contrib_") -> DataFrame:
    """``contrib_<f> = coef_f * (x_f - mean_f)``; a missing x (imputed to the
    mean) contributes 0."""
    return df.select("*", *[
        (F.lit(float(coefs[f])) * F.coalesce(c(f).cast("double") - F.lit(float(means[f])),
                                             F.lit(0.0))).alias(prefix + f)
        for f in coefs])


def _ranked(df: DataFrame, features: list[str], k: int, prefix: str) -> DataFrame:
    """abs, rounded to 2 (half to even) BEFORE ranking, k largest, ties to the
    earlier feature."""
    tmp = df.select("*", *[np_round(F.abs(c(prefix + f)), 2).alias(f"_a_{i}")
                           for i, f in enumerate(features)])
    cols = [f"_a_{i}" for i in range(len(features))]
    return top_k_per_row(tmp, cols, k, out="_top", names=list(features)).drop(*cols)


def top_contributions_json(df: DataFrame, features: list[str], k: int = 5,
                           prefix: str = "contrib_", out: str | None = None) -> DataFrame:
    """``{feature: |contribution|}`` of the k largest, as JSON in rank order
    (encoded once)."""
    out = out or f"Top {k} Features"
    r = _ranked(df, features, k, prefix)
    js = F.to_json(F.map_from_arrays(F.transform("_top", lambda e: e["name"]),
                                     F.transform("_top", lambda e: e["value"])))
    return r.withColumn(out, js).drop("_top")


def top_contribution_names(df: DataFrame, features: list[str], k: int = 5,
                           prefix: str = "contrib_", out: str | None = None) -> DataFrame:
    """The same ranking, names only, joined by ", "."""
    out = out or f"Top {k} Features"
    r = _ranked(df, features, k, prefix)
    return r.withColumn(out, F.array_join(F.transform("_top", lambda e: e["name"]), ", ")
                        ).drop("_top")


def score_linear(df: DataFrame, coefs: dict[str, float], means: dict[str, float],
                 intercept: float = 0.0, threshold: float | None = 0.5) -> DataFrame:
    """T7 (coefficient table): ``predicted_probas`` = sigmoid(intercept + sum of
    contributions); ``predictions`` = probability > threshold (0.5 when the
    stored threshold is missing)."""
    t = 0.5 if threshold is None else float(threshold)
    z = F.lit(float(intercept))
    for f in coefs:
        z = z + F.lit(float(coefs[f])) * F.coalesce(c(f).cast("double") - F.lit(float(means[f])),
                                                    F.lit(0.0))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.select("*", p.alias("predicted_probas")).withColumn(
        "predictions", (F.col("predicted_probas") > F.lit(t)).cast("int"))


HOLD_OUTS = ("valid", "test")


def explanation_table(df: DataFrame, key: str, features: list[str], coefs: dict, means: dict,
                      intercept: float = 0.0, threshold: float = 0.5, label: str | None = None,
                      outcome: str = "income", hold_out: str | None = "valid",
                      split_col: str = "split", k: int = 5, with_values: bool = True) -> DataFrame:
    """Explanations + scores (+ truth columns and TP/FN/FP/TN flags when a
    ``label`` is given, i.e. the training form on a hold-out split). A bad
    ``hold_out`` raises."""
    if label is not None:
        if hold_out not in HOLD_OUTS:
            raise ValueError(f"hold_out must be one of {HOLD_OUTS}, got {hold_out!r}")
        df = df.where(F.col(split_col) == hold_out)
    d = linear_contributions(df, coefs, means)
    fn = top_contributions_json if with_values else top_contribution_names
    d = fn(d, list(coefs), k)
    d = score_linear(d, coefs, means, intercept, threshold)
    top = f"Top {k} Features"
    cols = [c(key), c(top)]
    if label is not None:
        d = row_outcome_flags(d.withColumnRenamed("predicted_probas", "_pp"), threshold, label, "_pp")
        d = d.withColumnRenamed("_pp", "predicted_probas")
        cols += [F.col("TP"), F.col("FN"), F.col("FP"), F.col("TN"), c(label).alias("y_true")]
    cols += [F.col("predictions").alias("y_pred"), F.col("predicted_probas").alias("y_pred_proba"),
             F.lit(outcome).alias("Outcome")]
    return d.select(*cols)
