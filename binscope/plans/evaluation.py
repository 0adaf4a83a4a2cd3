"""Train-and-evaluate chain (survey 3.2): tune, fit, calibrate, choose the threshold, measure
every split and log the run.

Everything over rows is a Spark job on one written frame; the driver holds the grid's
points, two calibration coefficients, a threshold and the final metric rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.operators import metrics as M
from binscope.operators import models as T
from binscope.operators.registry import Registry
from binscope.session import cut_lineage


def train_and_evaluate(frame: DataFrame, names: list[str], registry: Registry, experiment: str, run_name: str,
                       fit_fn, grid: dict, n_iter: int | None = 1, seed: int = 222, rfe: bool = False,
                       calibration: str | None = "sigmoid", target_precision: float = 0.5, delta: float = 0.01,
                       workers: int = 4, key: str = "row_id", weight: str | None = "weight") -> DataFrame:
    """Metrics of every split (``run_name, metric, value``, as M12) of the best model of the search.

    ``frame`` holds ``key, y, split, weight, features`` (``training_frame``), ``names`` its features. The search
    and the fits see the train rows, the choice of the point, the calibration and the threshold
    (T6 on the calibrated scores) the valid rows; test rows are only measured. The run's parameters, threshold, metrics,
    model and kept features go to ``registry``. Raises ValueError where no point can be scored (no
    valid row of either class)."""
    data = cut_lineage(frame, "train_frame", T.ROWS_PER_TASK)
    train, valid = (data.where(F.col("split") == s) for s in ("train", "valid"))
    kept: dict = {}
    cuts: dict = {}
    with T.dealt(train) as rows:
        eliminate = T.shared_elimination(rows, names, weight=weight)

        def select(_, n_features):
            kept[n_features], cuts[n_features] = eliminate(n_features)
            return cuts[n_features]

        model, params, tried = T.random_grid_search(rows, valid, fit_fn, grid, n_iter, seed,
                                                    select_fn=select if rfe else None, workers=workers)
    if model is None:
        raise ValueError("no point of the grid could be scored on the valid rows")
    setting = params.get(T.RFE_KEY)
    cut = cuts.get(setting, lambda d: d)
    scored = T.score_model(model, cut(data), keep=[key, "y", "split"])
    score = "predicted_probas"
    if calibration:
        scored = T.calibrate_scores(scored.where(F.col("split") == "valid"), calibration)(scored)
        score = "calibrated"
    rows = cut_lineage(scored.select(F.lit(run_name).alias("run_name"), F.col(key), F.col("y").cast("int").alias("y"),
                                     "split", F.col(score).alias("p")), "scored", T.ROWS_PER_TASK)
    best = M.optimal_threshold(rows.where(F.col("split") == "valid"), ["run_name"], target_precision, delta).first()
    out = M.split_metrics(rows, ["run_name"], "split", best["threshold"])
    values = {r["metric"]: r["value"] for r in out.collect()}  # six of each split
    run_id = registry.get_or_create_run(experiment, run_name)
    registry.log_params(run_id, {"threshold": best["threshold"], "beta": best["beta"], "calibration": calibration}, hyperparameters=params)
    registry.log_metrics(run_id, values)
    registry.save_model(run_id, model)
    registry.save_state(experiment, run_name, "features", kept.get(setting, names))
    return out
