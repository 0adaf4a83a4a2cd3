"""Reshaping (R1, R3, R4; R2 lives with the metrics as ``pivot_metrics``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.functions.exprs import c


def union_metric_frames(frames: dict[str, DataFrame], metric: str = "metric") -> DataFrame:
    """Stack one metric table per split; metric names become ``"<split> <metric>"``."""
    out = None
    for split, df in frames.items():
        d = df.withColumn(metric, F.concat(F.lit(f"{split} "), F.col(metric)))
        out = d if out is None else out.unionByName(d)
    return out


def unpivot_disparities(df: DataFrame, id_cols: list[str], metric_cols: list[str] | None = None,
                        metric: str = "metric", value: str = "value") -> DataFrame:
    """Wide per-group metric rows -> ``(id_cols, metric, value)``."""
    vals = metric_cols or [n for n in df.columns if n not in id_cols]
    return df.unpivot([c(n) for n in id_cols], [c(n) for n in vals], metric, value)


def top_k_per_row(df: DataFrame, cols: list[str], k: int = 5, out: str = "top",
                  largest: bool = True, names: list[str] | None = None) -> DataFrame:
    """The ``k`` largest entries across ``cols`` of each row as an array of
    ``struct(name, value)``; ties go to the earlier column, missing values are
    skipped; ``names`` labels the entries (default: the column names). A
    per-row array sort: no shuffle, no explode."""
    sign = -1.0 if largest else 1.0
    names = names or cols
    entries = F.array(*[F.struct((F.lit(sign) * c(n).cast("double")).alias("o"),
                                 F.lit(i).alias("pos"), F.lit(lab).alias("name"),
                                 c(n).cast("double").alias("value"))
                        for i, (n, lab) in enumerate(zip(cols, names))])
    kept = F.filter(entries, lambda e: e["value"].isNotNull())
    top = F.slice(F.array_sort(kept), 1, k)
    return df.withColumn(out, F.transform(top, lambda e: F.struct(e["name"].alias("name"),
                                                                  e["value"].alias("value"))))
