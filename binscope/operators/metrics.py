"""Metric and curve tables for binary scores.

Input is long scored rows: group columns (``model``, ``split``, ...), a 0/1
label and a score. Everything is derived from one score-grouped aggregate
``(keys, score, pos, neg)``: ties collapse into one row, a running sum in
descending score order gives TP/FP at every distinct threshold, and all curve
points and threshold-free metrics (AUC, AP) follow from it. The aggregate is
map-side combined, so the shuffle carries one row per distinct score per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binscope.functions.exprs import np_round, safe_div
from binscope.operators.running import DEFAULT_BUCKETS, null_safe_join, running_sums

# Names used by the metrics report (same text as the reference).
REPORT_METRICS = ("Precision/PPV", "Average Precision", "Sensitivity", "Specificity",
                  "AUC ROC", "Brier Score")

INF = float("inf")


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


# ------------------------------------------------------------------ basic blocks

def threshold_predict(df: DataFrame, threshold: float = 0.5, score: str = "p",
                      out: str = "y_pred") -> DataFrame:
    """class 1 when score > threshold (strict)."""
    return df.withColumn(out, (F.col(score) > F.lit(float(threshold))).cast("int"))


def score_counts(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p") -> DataFrame:
    """``(keys, score, pos, neg)``: one row per distinct score of each group."""
    k = _keys(keys)
    y = F.col(label).cast("long")
    return (scored.groupBy(*k, F.col(score).alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def cumulative_counts(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Score table plus ``tp``/``fp`` = counts with score >= this score and the
    group totals ``P``/``N``."""
    k = _keys(keys)
    st = score_counts(scored, k, label, score)
    cum = running_sums(st, k, "score", ["pos", "neg"], descending=True, n_buckets=n_buckets)
    return (cum.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")
            .withColumnRenamed("tot_pos", "P").withColumnRenamed("tot_neg", "N"))


# ------------------------------------------------------------------ M1-M3, M14

def confusion_counts(scored: DataFrame, keys=("model",), threshold: float = 0.5,
                     label: str = "y", score: str = "p") -> DataFrame:
    """M1: TN, FP, FN, TP at ``score > threshold``."""
    k = _keys(keys)
    y1 = F.col(label) == 1
    pr = F.col(score) > F.lit(float(threshold))

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    return scored.groupBy(*k).agg(
        F.lit(float(threshold)).alias("threshold"),
        cnt(~y1 & ~pr).alias("tn"), cnt(~y1 & pr).alias("fp"),
        cnt(y1 & ~pr).alias("fn"), cnt(y1 & pr).alias("tp"))


def _share(num, den):
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def confusion_normalized(scored: DataFrame, keys=("model",), threshold: float = 0.5,
                         label: str = "y", score: str = "p") -> DataFrame:
    """M2: the confusion cells as shares by true class (``true``), by predicted
    class (``pred``) and of all rows (``all``); 0/0 gives 0."""
    k = _keys(keys)
    cc = confusion_counts(scored, k, threshold, label, score)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    forms = F.array(
        F.struct(F.lit("true").alias("normalize"), _share(tn, tn + fp).alias("tn"),
                 _share(fp, tn + fp).alias("fp"), _share(fn, fn + tp).alias("fn"),
                 _share(tp, fn + tp).alias("tp")),
        F.struct(F.lit("pred").alias("normalize"), _share(tn, tn + fn).alias("tn"),
                 _share(fp, fp + tp).alias("fp"), _share(fn, tn + fn).alias("fn"),
                 _share(tp, fp + tp).alias("tp")),
        F.struct(F.lit("all").alias("normalize"), _share(tn, n).alias("tn"),
                 _share(fp, n).alias("fp"), _share(fn, n).alias("fn"), _share(tp, n).alias("tp")))
    return cc.select(*k, "threshold", F.inline(forms))


def rates_from_counts(cc: DataFrame) -> DataFrame:
    """M3 columns from a table holding tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return cc.select(
        "*",
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("sensitivity"),
        safe_div(tn, tn + fp).alias("specificity"),
        safe_div(tp + tn, n).alias("accuracy"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_div(tp + fn, n).alias("prevalence"),
        safe_div(tp + fp, n).alias("predicted_prevalence"))


def classification_rates(scored: DataFrame, keys=("model",), threshold: float = 0.5,
                         label: str = "y", score: str = "p") -> DataFrame:
    """M3: precision (0 without predicted positives), sensitivity, specificity
    (NULL for 0/0), accuracy, F1, prevalence, predicted prevalence."""
    return rates_from_counts(confusion_counts(scored, keys, threshold, label, score))


def row_outcome_flags(scored: DataFrame, threshold: float = 0.5, label: str = "y",
                      score: str = "p") -> DataFrame:
    """Per-row TP / FN / FP / TN as 0/1 ints."""
    y1 = F.col(label) == 1
    pr = F.col(score) > F.lit(float(threshold))
    return scored.select("*", (y1 & pr).cast("int").alias("TP"), (y1 & ~pr).cast("int").alias("FN"),
                         (~y1 & pr).cast("int").alias("FP"), (~y1 & ~pr).cast("int").alias("TN"))


# ------------------------------------------------------------------ M4-M7

def _summary_aggs(threshold: float):
    pos, neg, tp, fp, s = (F.col(x) for x in ("pos", "neg", "tp", "fp", "score"))
    above = s > F.lit(float(threshold))
    return [
        F.sum(pos).alias("P"), F.sum(neg).alias("N"),
        F.sum(F.when(above, pos).otherwise(0)).alias("tp_t"),
        F.sum(F.when(above, neg).otherwise(0)).alias("fp_t"),
        F.sum(neg.cast("double") * (tp.cast("double") - pos.cast("double") / 2)).alias("auc_num"),
        F.sum(pos.cast("double") * tp.cast("double") / (tp + fp).cast("double")).alias("ap_num"),
        F.sum(pos * (s - 1) * (s - 1) + neg * s * s).alias("brier_num"),
    ]


def score_summary(scored: DataFrame, keys=("model",), threshold: float = 0.5, label: str = "y",
                  score: str = "p", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Per group: P, N, confusion at ``threshold``, AUC, AP and Brier from one
    score-grouped aggregate and one running sum."""
    k = _keys(keys)
    st = score_counts(scored, k, label, score)
    cum = running_sums(st, k, "score", ["pos", "neg"], descending=True, n_buckets=n_buckets,
                       totals_prefix=None)
    cum = cum.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")
    g = cum.groupBy(*k).agg(*_summary_aggs(threshold))
    P, N, tpt, fpt = (F.col(x) for x in ("P", "N", "tp_t", "fp_t"))
    return g.select(
        *k, "P", "N",
        tpt.alias("tp"), fpt.alias("fp"), (P - tpt).alias("fn"), (N - fpt).alias("tn"),
        safe_div(F.col("auc_num"), P.cast("double") * N).alias("roc_auc"),
        safe_div(F.col("ap_num"), P).alias("average_precision"),
        safe_div(F.col("brier_num"), P + N).alias("brier"))


def roc_auc(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
            n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """M4: area under ROC, tied scores count half; NULL for a one-class group."""
    return score_summary(scored, keys, 0.5, label, score, n_buckets).select(*_keys(keys), "roc_auc")


def average_precision(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """M5: step-wise AP = sum over distinct scores (descending) of dRecall * precision."""
    return score_summary(scored, keys, 0.5, label, score, n_buckets).select(
        *_keys(keys), "average_precision")


def brier_score(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p") -> DataFrame:
    """M6: mean squared difference between score and label."""
    k = _keys(keys)
    d = F.col(score) - F.col(label)
    return scored.groupBy(*k).agg(F.avg(d * d).alias("brier"))


def metrics_long(scored: DataFrame, keys=("model",), threshold: float = 0.5, label: str = "y",
                 score: str = "p", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """The six report metrics per group in long form ``(keys, metric, value)``."""
    k = _keys(keys)
    s = score_summary(scored, k, threshold, label, score, n_buckets)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    vals = [_share(tp, tp + fp), F.col("average_precision"), _share(tp, tp + fn),
            safe_div(tn, tn + fp), F.col("roc_auc"), F.col("brier")]
    arr = F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"))
                    for n, v in zip(REPORT_METRICS, vals)])
    return s.select(*k, F.inline(arr))


def pivot_metrics(long: DataFrame, column: str = "model", values: list[str] | None = None,
                  metric: str = "metric", value: str = "value", digits: int = 3) -> DataFrame:
    """R2: metrics as rows, one column per ``column`` value, each rounded to
    ``digits`` (half to even), then ``Mean`` = mean of the rounded values,
    rounded again. One aggregate (a conditional ``first`` per column value and
    the mean), no pivot job and no join. Pass ``values`` to skip the job that
    finds them."""
    if values is None:
        values = sorted(r[0] for r in long.select(column).distinct().limit(1001).collect())
        if len(values) > 1000:
            raise ValueError("too many pivot values; pass `values` explicitly")
    r = long.select(metric, column, np_round(F.col(value), digits).alias("_v"))
    cells = [F.first(F.when(F.col(column) == F.lit(v), F.col("_v")), ignorenulls=True).alias(v)
             for v in values]
    return r.groupBy(metric).agg(*cells, np_round(F.avg("_v"), digits).alias("Mean"))


def metrics_report(scored: DataFrame, keys=("model",), threshold: float = 0.5, label: str = "y",
                   score: str = "p", models: list[str] | None = None,
                   n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """M7: the six metrics per model at ``threshold`` pivoted with a ``Mean`` column."""
    k = _keys(keys)
    long = metrics_long(scored, k, threshold, label, score, n_buckets)
    return pivot_metrics(long, column=k[0], values=models)


# ------------------------------------------------------------------ curves M8-M11

def roc_curve(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
              n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """M8: ``(keys, threshold, fpr, tpr, roc_auc)``; every distinct score is a
    threshold, plus the start point (0, 0) at +infinity."""
    k = _keys(keys)
    cum = cumulative_counts(scored, k, label, score, n_buckets)
    pts = cum.select(*k, F.col("score").alias("threshold"),
                     safe_div(F.col("fp"), F.col("N")).alias("fpr"),
                     safe_div(F.col("tp"), F.col("P")).alias("tpr"),
                     (F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("_a"),
                     "P", "N")
    start = pts.groupBy(*k).agg(F.sum("_a").alias("_a"), F.first("P").alias("P"),
                                F.first("N").alias("N"))
    auc = start.select(*k, safe_div(F.col("_a"), F.col("P").cast("double") * F.col("N")).alias("roc_auc"))
    starts = auc.select(*k, F.lit(INF).alias("threshold"), F.lit(0.0).alias("fpr"),
                        F.lit(0.0).alias("tpr"))
    return null_safe_join(pts.select(*k, "threshold", "fpr", "tpr").unionByName(starts), auc, k)


def precision_recall_curve(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
                           n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """M9: ``(keys, threshold, precision, recall, pr_auc)`` at every distinct
    score plus the end point (recall 0, precision 1, threshold NULL). ``pr_auc``
    is the trapezoid area over the points, not average precision."""
    k = _keys(keys)
    cum = cumulative_counts(scored, k, label, score, n_buckets)
    tp, fp, pos, neg, P = (F.col(x) for x in ("tp", "fp", "pos", "neg", "P"))
    tp0, fp0 = tp - pos, fp - neg
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, P)
    prev_prec = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(safe_div(tp0, tp0 + fp0))
    prev_rec = safe_div(tp0, P)
    pts = cum.select(*k, F.col("score").alias("threshold"), prec.alias("precision"),
                     rec.alias("recall"),
                     ((rec - prev_rec) * (prec + prev_prec) / 2).alias("_a"))
    area = pts.groupBy(*k).agg(F.sum("_a").alias("pr_auc"))
    ends = area.select(*k, F.lit(None).cast("double").alias("threshold"),
                       F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return null_safe_join(pts.drop("_a").unionByName(ends), area, k)


def calibration_edges(n_bins: int) -> list[float]:
    """Inner bin edges ``i * (1/n)`` (the same doubles numpy's linspace gives)."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def calibration_bin(score_col, n_bins: int = 10):
    """Bin number = count of inner edges strictly below the score, so a score on
    an inner edge falls into the lower bin."""
    expr = F.lit(0)
    for e in calibration_edges(n_bins):
        expr = expr + (score_col > F.lit(e)).cast("int")
    return expr


def calibration_curve(scored: DataFrame, keys=("model",), n_bins: int = 10, label: str = "y",
                      score: str = "p") -> DataFrame:
    """Per non-empty bin ``n``, mean score, share of positives; plus the
    group's Brier score."""
    k = _keys(keys)
    b = scored.select(*k, calibration_bin(F.col(score), n_bins).alias("bin"),
                      F.col(score).alias("_p"), F.col(label).cast("double").alias("_y"))
    d = F.col("_p") - F.col("_y")
    bins = b.groupBy(*k, "bin").agg(F.count(F.lit(1)).alias("n"),
                                    F.avg("_p").alias("mean_predicted"),
                                    F.avg("_y").alias("fraction_positive"),
                                    F.sum(d * d).alias("_s"), F.count(d).alias("_m"))
    # at most n_bins rows a group: their sums are the group's, without a second pass or a join
    group = Window.partitionBy(*k)
    brier = safe_div(F.sum("_s").over(group), F.sum("_m").over(group)).alias("brier")
    return bins.select(*k, "bin", "n", "mean_predicted", "fraction_positive", brier)


def threshold_metrics(scored: DataFrame, keys=("model",), label: str = "y", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Precision, recall, F1 = 2pr/(p+r+1e-9) and specificity at every
    distinct score, "positive" meaning score >= threshold."""
    k = _keys(keys)
    cum = cumulative_counts(scored, k, label, score, n_buckets)
    tp, fp, P, N = (F.col(x) for x in ("tp", "fp", "P", "N"))
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, P)
    return cum.select(*k, F.col("score").alias("threshold"), prec.alias("precision"),
                      rec.alias("recall"),
                      (2 * prec * rec / (prec + rec + F.lit(1e-9))).alias("f1"),
                      safe_div(N - fp, N).alias("specificity"))


# ------------------------------------------------------------------ M12, M13

def split_metrics(scored: DataFrame, keys=("model",), split: str = "split", threshold: float = 0.5,
                  label: str = "y", score: str = "p", n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Report metrics for every split at once, named ``"<split> <metric>"``
    and rounded to 3 (half to even)."""
    k = _keys(keys)
    long = metrics_long(scored, k + [split], threshold, label, score, n_buckets)
    return long.select(*k, F.concat(F.col(split), F.lit(" "), F.col("metric")).alias("metric"),
                       np_round(F.col("value"), 3).alias("value"))


def evaluation_bundle(scored: DataFrame, keys=("model", "split"), threshold: float = 0.5,
                      n_bins: int = 10, label: str = "y", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """ROC, PR, threshold-metric, confusion and calibration points in one
    long table ``(keys, curve, x_name, x, y_name, y, threshold)``, with the start
    of the ROC and the end of the PR curve; the curve tables share one cumulative
    aggregate."""
    k = _keys(keys)
    cum = cumulative_counts(scored, k, label, score, n_buckets)
    tp, fp, P, N = (F.col(x) for x in ("tp", "fp", "P", "N"))
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, P)
    fpr = safe_div(fp, N)
    t = F.col("score")
    rows = F.array(
        F.struct(F.lit("roc").alias("curve"), F.lit("fpr").alias("x_name"), fpr.alias("x"),
                 F.lit("tpr").alias("y_name"), rec.alias("y"), t.alias("threshold")),
        F.struct(F.lit("pr").alias("curve"), F.lit("recall").alias("x_name"), rec.alias("x"),
                 F.lit("precision").alias("y_name"), prec.alias("y"), t.alias("threshold")),
        *[F.struct(F.lit("threshold").alias("curve"), F.lit("threshold").alias("x_name"), t.alias("x"),
                   F.lit(name).alias("y_name"), y.alias("y"), t.alias("threshold"))
          for name, y in (("precision", prec), ("recall", rec), ("specificity", safe_div(N - fp, N)),
                          ("f1", 2 * prec * rec / (prec + rec + F.lit(1e-9))))])
    curves = cum.select(*k, F.inline(rows))
    cal = calibration_curve(scored, k, n_bins, label, score).select(
        *k, F.lit("calibration").alias("curve"), F.lit("mean_predicted").alias("x_name"),
        F.col("mean_predicted").alias("x"), F.lit("fraction_positive").alias("y_name"),
        F.col("fraction_positive").alias("y"), F.lit(None).cast("double").alias("threshold"))
    cm = confusion_counts(scored, k, threshold, label, score)
    conf = cm.select(*k, F.inline(F.array(*[
        F.struct(F.lit("confusion").alias("curve"), F.lit("cell").alias("x_name"),
                 F.lit(float(i)).alias("x"), F.lit(name).alias("y_name"),
                 F.col(name).cast("double").alias("y"), F.col("threshold").alias("threshold"))
        for i, name in enumerate(("tn", "fp", "fn", "tp"))])))

    def point(curve: str, x_name: str, x: float, y_name: str, y: float, threshold: float | None):
        return F.struct(F.lit(curve).alias("curve"), F.lit(x_name).alias("x_name"), F.lit(x).alias("x"),
                        F.lit(y_name).alias("y_name"), F.lit(y).alias("y"),
                        F.lit(threshold).cast("double").alias("threshold"))

    # the points that no score gives: nothing predicted positive
    ends = cm.select(*k, F.inline(F.array(point("roc", "fpr", 0.0, "tpr", 0.0, INF),
                                          point("pr", "recall", 0.0, "precision", 1.0, None))))
    return curves.unionByName(cal).unionByName(conf).unionByName(ends)


# ------------------------------------------------------------------ T6

def beta_grid(lo: float = 0.01, hi: float = 4.0, num: int = 40) -> list[float]:
    """``num`` evenly spaced values from ``lo`` to ``hi`` inclusive (numpy linspace)."""
    step = (hi - lo) / (num - 1)
    vals = [lo + i * step for i in range(num)]
    vals[-1] = hi
    return vals


def fbeta_expr(prec, rec, beta: float):
    b2 = F.lit(float(beta * beta))
    num = (F.lit(1.0) + b2) * prec * rec
    den = b2 * prec + rec
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def _hull(fp: np.ndarray, tp: np.ndarray) -> list[int]:
    """Places of the points that are not below a line between two others (and of some beside such a line:
    the products are rounded, and a point is left out only where that does not matter)."""
    out: list[int] = []
    for i in np.lexsort((tp, fp)).tolist():
        x, y = fp[i], tp[i]
        while len(out) > 1:
            ax, ay, mx, my = fp[out[-2]], tp[out[-2]], fp[out[-1]], tp[out[-1]]
            above, across = (mx - ax) * (y - ay), (my - ay) * (x - ax)
            if above - across <= 1e-9 * (abs(above) + abs(across)):
                break
            out.pop()
        out.append(i)
    return out


def _hull_rows(keys: list[str]):
    """Keeps the rows of every batch that are on the upper hull of their group's (fp, tp) points there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.zeros(batch.num_rows, dtype=np.int64)
            for n in keys:
                codes = pc.dictionary_encode(batch.column(n), null_encoding="encode")
                group = np.unique(group * (len(codes.dictionary) + 1) + codes.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            fp, tp = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in ("_fp", "_tp"))
            order = np.argsort(group, kind="stable")
            ends = np.cumsum(np.bincount(group)) if batch.num_rows else []
            keep = [own[_hull(fp[own], tp[own])] for own in np.split(order, ends[:-1])] if batch.num_rows else []
            yield batch.take(pa.array(np.sort(np.concatenate(keep)))) if keep else batch
    return run


def optimal_threshold(scored: DataFrame, keys=("model",), target_precision: float = 0.5,
                      delta: float = 0.01, betas: list[float] | None = None,
                      default_threshold: float = 0.5, label: str = "y", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """For each beta, the threshold maximising F-beta over the distinct
    scores (largest threshold on ties); then the smallest beta whose precision
    at that threshold is within ``delta`` of ``target_precision``. No beta
    qualifies -> ``default_threshold`` and NULL beta.

    F-beta is a ratio of linear functions of (fp, tp), so whatever beta is, a vertex
    of the points' upper convex hull maximises it. Every Arrow batch of thresholds
    first keeps its own hull, a handful of its rows; what is a vertex of all
    is one of its batch. Only those meet the ``len(betas)`` values, and one row per
    (group, beta), the best of all batches, is ranked."""
    k = _keys(keys)
    betas = betas or beta_grid()
    cum = cumulative_counts(scored, k, label, score, n_buckets)
    points = cum.select(*k, F.col("score").alias("threshold"), safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        safe_div(F.col("tp"), F.col("P")).alias("recall"), F.col("fp").alias("_fp"), F.col("tp").alias("_tp"))
    tm = points.mapInArrow(_hull_rows(k), points.schema)
    prec, rec, thr = F.col("precision"), F.col("recall"), F.col("threshold")
    grid = F.explode(F.array(*[F.lit(float(b)) for b in betas])).alias("beta")
    b2 = F.col("beta") * F.col("beta")
    den = b2 * prec + rec
    fb = F.when(den == 0, F.lit(0.0)).otherwise((F.lit(1.0) + b2) * prec * rec / den)
    per_beta = (tm.select(*k, thr, prec, rec, grid)
                .groupBy(*k, "beta")
                .agg(F.max_by(F.struct(thr.alias("t"), prec.alias("p")),
                              F.struct(fb, thr)).alias("best")))
    ok = F.abs(F.col("best.p") - F.lit(float(target_precision))) <= F.lit(float(delta))
    ok_beta = F.when(ok, F.col("beta"))
    pick = per_beta.groupBy(*k).agg(F.min_by(F.col("best"), ok_beta).alias("best"),
                                    F.min(ok_beta).alias("beta"))
    return pick.select(*k, F.coalesce(F.col("best.t"), F.lit(float(default_threshold)))
                       .alias("threshold"), "beta", F.col("best.p").alias("precision"))
