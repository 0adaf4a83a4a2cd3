"""Column-expression helpers shared by the operators (all JVM-side, no UDFs)."""

from binscope.functions.exprs import (  # noqa: F401
    NUMERIC_SHAPE,
    is_missing_token,
    md5_uniform,
    md5_order_cols,
    md5_order_key,
    np_round,
    numeric_ok,
    q,
    safe_div,
    strict_numeric,
)
