"""Inference chain (survey 3.3): saved state -> prepared projection ->
scores -> explanations. A pure map from scan to sink: no shuffle at all, so
it also runs unchanged on a streaming DataFrame (see ``binscope.streaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from binscope.operators import clean as C
from binscope.operators import explain as E


def score_and_explain(df: DataFrame, key: str, state: dict, coefs: dict, means: dict,
                      intercept: float, threshold: float | None = 0.5,
                      thousands_cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """Clean with the saved column lists (no data-dependent probe: the types
    are fixed by ``state['types']`` when given), then score and explain."""
    d = C.nullify_tokens(C.nan_to_null(df))
    types = state.get("types") or {}
    if thousands_cols:  # no probe: a stream has none
        d = C.strip_thousands(d, thousands_cols, {n: types.get(n) or "double" for n in thousands_cols})
    for n, t in types.items():
        if t and n in d.columns and n not in (thousands_cols or []):
            from binscope.functions.exprs import c, strict_numeric
            d = d.withColumn(n, strict_numeric(c(n), t))
    d = C.drop_columns(d, state.get("zero_variance", []))
    d = E.linear_contributions(d, coefs, means)
    d = E.top_contributions_json(d, list(coefs), k)
    d = E.score_linear(d, coefs, means, intercept, threshold)
    top = f"Top {k} Features"
    return d.select(key, top, d["predictions"].alias("y_pred"),
                    d["predicted_probas"].alias("y_pred_proba"))
