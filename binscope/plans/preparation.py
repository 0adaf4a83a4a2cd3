"""Preparation chain (survey 3.1) as one lazy plan with two small forced jobs.

training: clean (type probe job) -> zero-variance + missing-share decisions
(one aggregate job) -> drop/select -> sparse-row filter -> row missing share.
inference: the same projection with the saved lists, no row filter.
The state lists are returned (and can be saved with ``Registry.save_state``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from binscope.operators import clean as C
from binscope.operators import profile as A


def prepare(df: DataFrame, key: str, target: str, stage: str = "training",
            thousands_cols: list[str] | None = None, state: dict | None = None,
            missing_threshold: float = 60.0, sparse_threshold: float = 0.5,
            gain_col: str = "capital-gain") -> tuple[DataFrame, dict]:
    """Returns (prepared DataFrame, state) where state holds ``zero_variance``
    and ``kept_columns`` (key and target excluded from both lists) and
    ``types`` (column types that training decided; inference does not probe)."""
    if stage not in ("training", "inference"):
        raise ValueError(f"stage must be 'training' or 'inference', got {stage!r}")
    if stage == "inference" and not state:
        raise ValueError("inference needs the saved state")
    types = C.probe_types(df, thousands_cols) if stage == "training" else state.get("types")
    d = C.clean_dataframe(df, thousands_cols, types)
    if stage == "training":
        zero = A.zero_variance_columns(d, key=key,
                                       cols=[n for n in C.numeric_columns(d) if n != target])
        d = C.drop_columns(d, zero)
        kept = [r["column"] for r in A.keep_columns_below(d, missing_threshold, key=key,
                                                           exclude=[target])
                .orderBy("pos").collect()]
        state = {"zero_variance": zero, "kept_columns": kept, "types": types}
    else:
        d = C.drop_columns(d, state["zero_variance"])
    keep = [key] + state["kept_columns"] + ([target] if target in d.columns else [])
    d = C.select_saved_columns(d, keep)
    if stage == "training":
        d = C.filter_sparse_rows(d, key=key, gain_col=gain_col, threshold=sparse_threshold)
    return C.row_missing_fraction(d, key=key), state
