"""Training frame (survey 3.2): prepared rows -> features by the model's plan
-> split -> class weights -> one assembled vector column.

The assembled frame is what every fit of one plan shares; callers cache or
checkpoint it once per plan (three distinct plans: scaled, imputed, raw).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.functions.exprs import md5_uniform, q
from binscope.operators import clean as C
from binscope.operators import features as X
from binscope.operators import sample as G
from binscope.session import cut_lineage


def training_frame(df: DataFrame, key: str, label: str, numeric: list[str],
                   categorical: list[str], model_type: str = "lr", rfe: bool = False,
                   smote: bool = False, split_col: str | None = None,
                   seed: str = "split", undersample: bool = False,
                   n_features: int | float = 10) -> tuple[DataFrame, list[str]]:
    """Returns (frame with ``key, y, split, weight, features``, feature names).

    The six pipelines are {as is, ``smote``, ``undersample``} x {with, without
    ``rfe``}. Resampling changes the train rows only (synthetic rows have
    negative keys); RFE is fitted on the resampled train rows and leaves
    ``n_features`` (a number, or a share) of the features.

    Rows without a label are not trainable and are left out. ``split_col``
    names an existing split column; otherwise a seeded md5 60/20/20 split is
    used. Statistics (scaling, categories, weights) come from the train rows."""
    if smote and undersample:
        raise ValueError("a pipeline resamples one way: smote or undersample")
    d = df.where(F.col(label).isNotNull())
    if split_col is None:
        u = md5_uniform(F.col(key), seed)
        d = d.withColumn("split", F.when(u < 0.6, "train").when(u < 0.8, "valid")
                         .otherwise("test"))
    elif split_col != "split":
        d = d.withColumnRenamed(split_col, "split")
    train = d.where(F.col("split") == "train")
    plan = X.preprocessing_plan(model_type, rfe=rfe, smote=smote)
    (out,), names = X.apply_plan(train, [d], plan, numeric, categorical)
    if smote or undersample:
        rows = out.select(F.col(q(key)).alias(key), F.col(q(label)).alias(label), "split", *[F.col(q(n)) for n in names])
        fit_on = rows.where(F.col("split") == "train")
        if undersample:
            fit_on = G.random_undersample(fit_on, key, label)
        else:
            grown = G.smote_oversample(fit_on.drop("split"), key, label, names)
            fit_on = grown.select(key, label, F.lit("train").alias("split"), *[F.col(q(n)) for n in names])
        out = cut_lineage(rows.where(F.col("split") != "train").unionByName(fit_on), "resampled")
    if rfe:
        names = X.rfe_select(out.where(F.col("split") == "train"), names, label, n_features)
    out = G.balanced_class_weights(out, label, "weight")
    assembled = X.assemble_features(out.withColumn("y", F.col(label).cast("double")),
                                    names, [], passthrough=[key, "y", "split", "weight"])
    return assembled, names


def numeric_and_categorical(df: DataFrame, key: str, label: str,
                            categorical: tuple = ("race", "sex")) -> tuple[list[str], list[str]]:
    nums = [n for n in C.numeric_columns(df) if n not in (key, label)]
    cats = [n for n in categorical if n in df.columns]
    return nums, cats
