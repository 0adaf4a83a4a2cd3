"""Key joins.

All joins are equi-joins on an explicit key. Spark picks the strategy: a side
whose size statistics fall under ``autoBroadcastJoinThreshold`` is broadcast
(the size check), otherwise sort-merge; AQE re-plans with runtime sizes and
splits skewed partitions. No hint is forced on sides whose size is unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.functions.exprs import c


def join_features_target(X: DataFrame, y: DataFrame, key: str) -> DataFrame:
    """Inner join of features and targets on the row id."""
    return X.join(y, key, "inner")


def align_xy(X: DataFrame, y: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Label next to features by key, plus an audit table
    ``(check, n)``: rows of X without a label, labels without features, and
    keys that occur more than once on either side. The audit is computed with
    one full outer join of per-key counts (each side pre-aggregated by key)."""
    xk = X.groupBy(c(key).alias("_k")).agg(F.count(F.lit(1)).alias("_nx"))
    yk = y.groupBy(c(key).alias("_k")).agg(F.count(F.lit(1)).alias("_ny"))
    j = xk.join(yk, "_k", "full_outer")
    audit = j.agg(
        F.sum((F.col("_ny").isNull()).cast("long")).alias("x_without_label"),
        F.sum((F.col("_nx").isNull()).cast("long")).alias("label_without_x"),
        F.sum((F.col("_nx") > 1).cast("long")).alias("duplicate_keys_x"),
        F.sum((F.col("_ny") > 1).cast("long")).alias("duplicate_keys_y"))
    audit_long = audit.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).alias("n"))
        for n in ("x_without_label", "label_without_x", "duplicate_keys_x",
                  "duplicate_keys_y")])))
    return X.join(y, key, "inner"), audit_long


def unmatched(X: DataFrame, y: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of X with no label and labels with no X (``left_anti`` both ways)."""
    return X.join(y, key, "left_anti"), y.join(X, key, "left_anti")


def join_scores_groups(scores: DataFrame, groups: DataFrame, key: str,
                       group_cols: list[str]) -> DataFrame:
    """Scored rows + their sensitive-attribute columns, equi-join on key."""
    return scores.join(groups.select(c(key), *[c(g) for g in group_cols]), key, "inner")
