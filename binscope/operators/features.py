"""Fitted feature transforms.

``fit`` runs one aggregation job and returns small state (a dict or a state
DataFrame); ``apply`` is a pure projection, identical for training and
inference and usable on a streaming DataFrame. The SQL forms (one 0/1 column
per category, arithmetic scaling) stay inside whole-stage codegen; the
``pyspark.ml`` forms are there for model fitting.
"""

from __future__ import annotations

import threading

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.functions.exprs import c, np_round
from binscope.operators.clean import batched_agg

STATE_DIGITS = 6  # fitted statistics are kept at 1e-6 precision


# ------------------------------------------------------------------ X1-X3

def scale_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """X1 fit: mean and population sd of each column (missing skipped), kept at
    1e-6 precision (rounded inside the aggregate)."""
    r = batched_agg(df, [e for i, n in enumerate(cols)
                         for e in (np_round(F.avg(c(n)), STATE_DIGITS).alias(f"m{i}"),
                                   np_round(F.stddev_pop(c(n)), STATE_DIGITS).alias(f"s{i}"))])
    return {n: (r[f"m{i}"], r[f"s{i}"]) for i, n in enumerate(cols)}


def scale_then_impute(df: DataFrame, state: dict) -> DataFrame:
    """X1 apply: ``(x - mean) / sd`` (sd 0 -> 1), then missing -> 0 (the mean of
    the scaled column). Unlike ``ml.StandardScaler``: population sd, NULL-aware."""
    out = []
    for n in df.columns:
        if n in state:
            m, s = state[n]
            scale = 1.0 if not s else s
            out.append(F.coalesce((c(n) - F.lit(m if m is not None else 0.0)) / F.lit(scale),
                                  F.lit(0.0)).alias(n))
        else:
            out.append(c(n))
    return df.select(*out)


def mean_fit(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """X2 fit: column means (missing skipped), kept at 1e-6 precision."""
    r = batched_agg(df, [np_round(F.avg(c(n)), STATE_DIGITS).alias(f"m{i}")
                         for i, n in enumerate(cols)])
    return {n: r[f"m{i}"] for i, n in enumerate(cols)}


def impute_mean(df: DataFrame, means: dict) -> DataFrame:
    """X2 apply: missing -> fitted mean."""
    return df.select(*[(F.coalesce(c(n), F.lit(means[n])).alias(n) if n in means else c(n))
                       for n in df.columns])


def impute_constant(df: DataFrame, cols: list[str], value: str = "missing") -> DataFrame:
    """Missing category -> ``value``."""
    s = set(cols)
    return df.select(*[(F.coalesce(c(n), F.lit(value)).alias(n) if n in s else c(n))
                       for n in df.columns])


# ------------------------------------------------------------------ X4

def onehot_fit(df: DataFrame, cols: list[str], max_categories: int = 1000) -> dict[str, list[str]]:
    """X4 fit: the sorted categories of each column (NULL excluded). One job for
    all columns; refuses columns with more than ``max_categories`` values,
    since one output column per category would not be usable anyway."""
    if not cols:
        return {}
    arr = F.array(*[F.struct(F.lit(n).alias("v"), c(n).cast("string").alias("x")) for n in cols])
    vc = (df.select(F.inline(arr)).where(F.col("x").isNotNull()).groupBy("v", "x").count())
    card = {r["v"]: r["k"] for r in vc.groupBy("v").agg(F.count(F.lit(1)).alias("k")).collect()}
    big = [n for n, k in card.items() if k > max_categories]
    if big:
        raise ValueError(f"too many categories for one-hot: {big}")
    rows = vc.select("v", "x").collect()
    out: dict[str, list[str]] = {n: [] for n in cols}
    for r in rows:
        out[r["v"]].append(r["x"])
    return {n: sorted(v) for n, v in out.items()}


def onehot_name(col: str, cat: str) -> str:
    return f"{col}_{cat}"


def onehot_apply(df: DataFrame, cats: dict[str, list[str]], drop_original: bool = True) -> DataFrame:
    """X4 apply: one 0/1 column per training category (sorted); an unknown or
    missing value gives all zeros (handle-unknown = ignore)."""
    keep = [c(n) for n in df.columns if not (drop_original and n in cats)]
    dummies = [F.coalesce((c(n) == F.lit(v)).cast("int"), F.lit(0)).alias(onehot_name(n, v))
               for n, vs in cats.items() for v in vs]
    return df.select(*keep, *dummies)


# ------------------------------------------------------------------ X5-X7

def assemble_features(df: DataFrame, numeric: list[str], categorical_dummies: list[str],
                      passthrough: list[str] | None = None, out: str = "features") -> DataFrame:
    """Numeric block then categorical block into one vector. The base
    form drops every other column except ``passthrough`` (key, label)."""
    va = VectorAssembler(inputCols=numeric + categorical_dummies, outputCol=out,
                         handleInvalid="keep")
    return va.transform(df).select(*[c(n) for n in (passthrough or [])], out)


NO_SCALE_MODELS = ("xgb", "cat")


def preprocessing_plan(model_type: str, rfe: bool = False, smote: bool = False) -> list[tuple]:
    """Steps ``(block, pos, stage)`` by model. ``lr``/``rf``: scale then
    impute numerics, impute then one-hot categoricals. ``xgb``/``cat``: with
    RFE or SMOTE impute numerics by mean and impute + one-hot categoricals;
    without, raw numerics and one-hot only (other columns passed through)."""
    if model_type in NO_SCALE_MODELS:
        if rfe or smote:
            return [("num", 0, "impute_mean"), ("cat", 0, "impute_constant"),
                    ("cat", 1, "onehot"), ("rest", 0, "passthrough")]
        return [("num", 0, "passthrough"), ("cat", 0, "onehot"), ("rest", 0, "passthrough")]
    plan = [("num", 0, "scale"), ("num", 1, "impute_mean_scaled"), ("cat", 0, "impute_constant"),
            ("cat", 1, "onehot")]
    if rfe:
        plan.append(("select", 0, "rfe"))
    return plan


def apply_plan(train: DataFrame, frames: list[DataFrame], plan: list[tuple], numeric: list[str],
               categorical: list[str], allow_missing: bool = False
               ) -> tuple[list[DataFrame], list[str]]:
    """Fit the plan's statistics on ``train`` and apply them to every frame.
    Returns the transformed frames and the ordered feature column names.

    Spark's tree learners reject missing values (the reference's boosting
    libraries route them natively), so a ``passthrough`` numeric block is
    mean-imputed unless ``allow_missing``."""
    stages = {s for _, _, s in plan}
    out = list(frames)
    if "scale" in stages:
        st = scale_fit(train, numeric)
        out = [scale_then_impute(f, st) for f in out]
    elif "impute_mean" in stages or not allow_missing:
        mm = mean_fit(train, numeric)
        out = [impute_mean(f, mm) for f in out]
    if "impute_constant" in stages:
        out = [impute_constant(f, categorical) for f in out]
        train = impute_constant(train, categorical)
    cats = onehot_fit(train, categorical)
    out = [onehot_apply(f, cats) for f in out]
    names = numeric + [onehot_name(n, v) for n in categorical for v in cats[n]]
    return out, names


def prune_param_grid(pipeline_stages: list[str], grid: dict) -> dict:
    """Drop ``feature_selection*`` keys when no RFE stage exists. Returns a
    new dict (the input is left unchanged)."""
    if any(s == "rfe" for s in pipeline_stages):
        return dict(grid)
    return {k: v for k, v in grid.items() if "feature_selection" not in k}


# ------------------------------------------------------------------ X8

class Elimination:
    """The course of X8 over features 0..``total`` - 1, for any number of targets.

    ``fit(kept)`` gives the coefficients of a model of the features ``kept``. A round depends on
    the features it begins with, not on the target, so targets share their rounds: each is fitted
    once, whichever target asks first, also when threads ask at the same time."""

    def __init__(self, fit, total: int, step: float = 0.1):
        self._fit, self._total, self._per_round = fit, total, max(1, int(step * total))
        self._rounds: list[list[int]] = [list(range(total))]  # kept at the start of each round
        self._orders: list[list[int]] = []  # the same, in the order in which they would go
        self._lock = threading.Lock()

    def kept(self, n_features: int | float) -> list[int]:
        """The features left for ``n_features`` (an int, or a fraction of the original count)."""
        share = isinstance(n_features, float) and n_features <= 1
        target = max(1, min(int(n_features * self._total) if share else int(n_features), self._total))
        with self._lock:
            i = 0
            while len(keep := self._rounds[i]) > target:
                if i == len(self._orders):
                    coefs = self._fit(keep)
                    self._orders.append([k for _, k in sorted((c ** 2, k) for c, k in zip(coefs, keep))])
                drop = min(self._per_round, len(keep) - target)
                gone = set(self._orders[i][:drop])
                left = [k for k in keep if k not in gone]
                if drop < self._per_round:  # the last round of this target only
                    return left
                if i + 1 == len(self._rounds):
                    self._rounds.append(left)
                i += 1
            return list(keep)


def rfe_select(df: DataFrame, features: list[str], label: str, n_features: int | float = 10,
               step: float = 0.1, weight: str | None = None, max_iter: int = 100) -> list[str]:
    """Recursive feature elimination with a logistic model: drop the
    ``step`` share of the ORIGINAL feature count with the smallest squared
    coefficient, refit, until ``n_features`` remain (an int, or a fraction of
    the original count). Each round is one distributed fit; the loop itself is a handful of driver iterations."""
    from binscope.operators.models import dealt, elimination_fit

    va = VectorAssembler(inputCols=[f"_{i}" for i in range(len(features))], outputCol="_f", handleInvalid="keep")
    wide = df.select(*[c(n).cast("double").alias(f"_{i}") for i, n in enumerate(features)], c(label).alias("_y"),
                     *([c(weight).alias("_w")] if weight else []))
    rows = va.transform(wide).select("_f", "_y", *(["_w"] if weight else []))
    with dealt(rows) as data:
        fit = elimination_fit(data, len(features), "_f", "_y", "_w" if weight else None, max_iter)
        return [features[i] for i in Elimination(fit, len(features), step).kept(n_features)]


def prune_param_grid_table(runs: DataFrame, grid: DataFrame, run_name: str = "run_name"
                           ) -> DataFrame:
    """X7 as tables: ``grid(model, key)`` joined to each run by the model part
    of its name; ``feature_selection*`` keys are kept only for runs whose
    pipeline has an RFE step (``..._rfe_...`` in the run name). The grid table
    has one row per (model, parameter): a fixed, small side."""
    model = F.split(F.col(run_name), "_").getItem(0)
    has_rfe = F.col(run_name).contains("_rfe")
    r = runs.select("run_id", model.alias("model"), has_rfe.alias("_rfe"))
    j = r.join(F.broadcast(grid), "model")
    return j.where(F.col("_rfe") | ~F.col("key").contains("feature_selection")).select(
        "run_id", "model", "key")
