"""Fairness tables by sensitive group (K1-K7).

The sensitive columns are unpivoted to ``(attribute, attribute_value)`` so one
grouped query serves every attribute; bootstraps add a ``bootstrap`` key
instead of a loop. All metrics come from the same score-grouped aggregate as
the overall metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binscope.functions.exprs import safe_div
from binscope.operators import metrics as M
from binscope.operators.running import DEFAULT_BUCKETS
from binscope.operators.sample import bootstrap_sample

# Metric names of the group tables (as in the reference notebooks).
GROUP_METRICS = ("Accuracy", "Precision", "Recall", "F1", "Specificity", "Prevalence",
                 "Predicted Prevalence", "ROC AUC", "Average Precision", "Brier")

SLICE_KEYS = ["attribute", "attribute_value"]


def group_slices(scored: DataFrame, group_cols: list[str]) -> DataFrame:
    """K1: one row per (scored row, sensitive attribute): ``attribute`` is the
    column name, ``attribute_value`` its value (as text)."""
    arr = F.array(*[F.struct(F.lit(g).alias("attribute"),
                             F.col(g).cast("string").alias("attribute_value"))
                    for g in group_cols])
    rest = [n for n in scored.columns if n not in group_cols]
    return scored.select(*rest, F.inline(arr))


def group_metrics(slices: DataFrame, keys: list[str], threshold: float = 0.5, label: str = "y",
                  score: str = "p", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """K2: the ten group metrics per key (e.g. model, attribute, value)."""
    s = M.score_summary(slices, keys, threshold, label, score, n_buckets)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    share = M._share
    vals = {
        "Accuracy": safe_div(tp + tn, n),
        "Precision": share(tp, tp + fp),
        "Recall": share(tp, tp + fn),
        "F1": share(2 * tp, 2 * tp + fp + fn),
        "Specificity": safe_div(tn, tn + fp),
        "Prevalence": safe_div(tp + fn, n),
        "Predicted Prevalence": safe_div(tp + fp, n),
        "ROC AUC": F.col("roc_auc"),
        "Average Precision": F.col("average_precision"),
        "Brier": F.col("brier"),
    }
    return s.select(*keys, n.alias("n"), *[vals[m].cast("double").alias(m) for m in GROUP_METRICS])


def group_disparities(gm: DataFrame, keys: list[str], reference: dict[str, str],
                      attribute: str = "attribute", value: str = "attribute_value") -> DataFrame:
    """K4: every metric divided by the same metric of the reference group of
    its attribute (``<metric>_ratio``); a 0 or missing denominator gives NULL.

    ``gm`` has one row per group, so the reference value is picked with a
    window over the keys other than the attribute value (a handful of rows
    per window partition); no self-join, so ``gm`` is computed once."""
    is_ref = None
    for attr, val in reference.items():
        cond = (F.col(attribute) == F.lit(attr)) & (F.col(value) == F.lit(val))
        is_ref = cond if is_ref is None else is_ref | cond
    outer = [k for k in keys if k != value]
    w = Window.partitionBy(*outer)
    return gm.select(*keys, *[
        safe_div(F.col(f"`{m}`"), F.max(F.when(is_ref, F.col(f"`{m}`"))).over(w)).alias(f"{m}_ratio")
        for m in GROUP_METRICS])


def group_curves(slices: DataFrame, keys: list[str], n_bins: int = 10, label: str = "y",
                 score: str = "p", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """K3: ROC, PR and calibration points per group value (long form)."""
    b = M.evaluation_bundle(slices, keys, 0.5, n_bins, label, score, n_buckets)
    return b.where(F.col("curve").isin("roc", "pr", "calibration"))


def bootstrap_slices(slices: DataFrame, key: str, keys: list[str], num_bootstraps: int = 10,
                     size: int = 2000, balanced: bool = False) -> DataFrame:
    """G5 applied per slice group: ``keys`` end with the attribute's value, and ``size`` draws a
    bootstrap are those of all values of one attribute (and model)."""
    return bootstrap_sample(slices, key, keys, num_bootstraps, size, balanced=balanced, within=keys[:-1])


def bootstrap_group_metrics(boot: DataFrame, keys: list[str], **kw) -> DataFrame:
    """K5: K2 with ``bootstrap`` added to the keys."""
    return group_metrics(boot, keys + ["bootstrap"], **kw)


def bootstrap_disparities(bgm: DataFrame, keys: list[str], reference: dict[str, str],
                          quantiles=(0.025, 0.5, 0.975)) -> DataFrame:
    """K6: K4 inside each bootstrap, then per group and ratio the mean and
    quantiles over bootstraps (``percentile`` over at most num_bootstraps
    values per group)."""
    d = group_disparities(bgm, keys + ["bootstrap"], reference)
    ratio_cols = [f"{m}_ratio" for m in GROUP_METRICS]
    long = d.unpivot([*keys, "bootstrap"], [F.col(f"`{r}`") for r in ratio_cols], "metric", "value")
    return long.groupBy(*keys, "metric").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        *[F.percentile("value", q).alias(f"q{int(round(q * 1000)):03d}") for q in quantiles])


def _grid_index_up(x, grid: int):
    """Smallest i with i/grid >= x."""
    g0 = F.ceil(x * grid)
    return F.when(x <= (g0 - 1) / F.lit(float(grid)), g0 - 1).otherwise(g0)


def _grid_index_down(x, grid: int):
    """Largest i with i/grid <= x."""
    g0 = F.floor(x * grid)
    return F.when((g0 + 1) / F.lit(float(grid)) <= x, g0 + 1).otherwise(g0)


def bootstrap_curves(boot: DataFrame, keys: list[str], grid: int = 100, n_bins: int = 5,
                     label: str = "y", score: str = "p",
                     n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """K7: per group, ROC / PR / calibration averaged over bootstraps on a
    common grid ``x = i / grid``. ROC: tpr at x = largest tpr among points with
    fpr <= x (step curve, start point (0, 0) included). PR: interpolated
    precision = largest precision among points with recall >= x (end point
    (0, 1) included). Calibration: the ``n_bins`` bins are the grid."""
    kb = keys + ["bootstrap"]
    cum = M.cumulative_counts(boot, kb, label, score, n_buckets)
    tp, fp, P, N = (F.col(x) for x in ("tp", "fp", "P", "N"))
    fpr, tpr = safe_div(fp, N), safe_div(tp, P)
    prec, rec = safe_div(tp, tp + fp), safe_div(tp, P)
    roc_pts = cum.select(*kb, _grid_index_up(fpr, grid).alias("gi"), tpr.alias("y"))
    pr_pts = cum.select(*kb, _grid_index_down(rec, grid).alias("gi"), prec.alias("y"))
    curves = cum.select(*kb).distinct()
    roc_pts = roc_pts.unionByName(curves.select(*kb, F.lit(0).cast("long").alias("gi"),
                                                F.lit(0.0).alias("y")))
    pr_pts = pr_pts.unionByName(curves.select(*kb, F.lit(0).cast("long").alias("gi"),
                                              F.lit(1.0).alias("y")))
    full = curves.select(*kb, F.explode(F.sequence(F.lit(0).cast("long"),
                                                   F.lit(grid).cast("long"))).alias("gi"))

    def on_grid(pts: DataFrame, name: str, ascending: bool) -> DataFrame:
        best = pts.groupBy(*kb, "gi").agg(F.max("y").alias("y"))
        g = full.join(best, kb + ["gi"], "left")
        w = Window.partitionBy(*kb).orderBy(F.col("gi") if ascending else F.col("gi").desc())
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        return g.select(*kb, "gi", F.max("y").over(w).alias("y"), F.lit(name).alias("curve"))

    both = on_grid(roc_pts, "roc", True).unionByName(on_grid(pr_pts, "pr", False))
    avg = both.groupBy(*keys, "curve", "gi").agg(F.avg("y").alias("y"),
                                                 F.count("y").alias("n_boot"))
    out = avg.select(*keys, "curve", (F.col("gi") / F.lit(float(grid))).alias("x"), "y", "n_boot")
    cal = M.calibration_curve(boot, kb, n_bins, label, score)
    cal_avg = cal.groupBy(*keys, "bin").agg(F.avg("mean_predicted").alias("x"),
                                             F.avg("fraction_positive").alias("y"),
                                             F.count(F.lit(1)).alias("n_boot"))
    return out.unionByName(cal_avg.select(*keys, F.lit("calibration").alias("curve"), "x", "y",
                                          "n_boot"))
