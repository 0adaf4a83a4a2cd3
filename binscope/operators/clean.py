"""Cleaning, typing and column selection.

Decisions that depend on the data (which text columns are numeric, which
categories are frequent) are two-phase: one aggregation job returns a single
small row to the driver (a few booleans per column), then a plain projection
applies it. Nothing proportional to the row count ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, NumericType, StringType)

from binscope.functions.exprs import (INTEGER_SHAPE, NUMERIC_SHAPE, c, integer_given_shape,
                                      is_missing_token, md5_order_cols, numeric_ok, q,
                                      strict_numeric)
from binscope.operators.running import hash_row_number

AGG_BATCH = 200  # expressions per aggregate, keeps generated code under the JVM method limit


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in table order; booleans are not numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def batched_agg(df: DataFrame, exprs: list[Column]) -> dict:
    """Run aggregate expressions in batches of ``AGG_BATCH``; one small row each."""
    out: dict = {}
    for i in range(0, len(exprs), AGG_BATCH):
        row = df.agg(*exprs[i:i + AGG_BATCH]).collect()[0]
        out.update(row.asDict())
    return out


# ------------------------------------------------------------------ P1-P4

def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating-point column becomes NULL, so that it counts as missing everywhere."""
    todo = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if not todo:
        return df
    return df.select(*[F.when(~F.isnan(c(n)), c(n)).alias(n) if n in todo else c(n) for n in df.columns])


def nullify_tokens(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A text cell becomes NULL if it is "" or contains "--" or ".." anywhere."""
    todo = set(cols if cols is not None else string_columns(df)) & set(string_columns(df))
    return df.select(*[
        (F.when(is_missing_token(c(n)), F.lit(None).cast("string")).otherwise(c(n)).alias(n)
         if n in todo else c(n)) for n in df.columns])


def _no_commas(v: Column) -> Column:
    return F.regexp_replace(v, ",", "")


def numeric_probe(df: DataFrame, cols: list[str], coerce_cols: list[str] | None = None
                  ) -> dict[str, str | None]:
    """One aggregation job deciding the numeric type of text columns.

    ``cols`` (strict parse, P3): ``"bigint"`` / ``"double"`` if every
    non-missing value parses (all integers and nothing missing -> bigint),
    else ``None`` (column stays text). ``coerce_cols`` (P2, commas removed,
    bad values become NULL): ``"bigint"`` when every value is an integer and
    none is missing, else ``"double"``."""
    exprs = []
    for i, n in enumerate(cols):
        v = c(n)
        exprs += [
            F.coalesce(F.bool_and(numeric_ok(v)), F.lit(True)).alias(f"ok{i}"),
            F.coalesce(F.bool_and(F.coalesce(integer_given_shape(v), F.lit(False))),
                       F.lit(True)).alias(f"int{i}"),
        ]
    for i, n in enumerate(coerce_cols or []):
        v = _no_commas(c(n))
        exprs.append(F.coalesce(F.bool_and(F.coalesce(v.rlike(INTEGER_SHAPE), F.lit(False))),
                                F.lit(True)).alias(f"cint{i}"))
    if not exprs:
        return {}
    row = batched_agg(df, exprs)
    out = {n: (("bigint" if row[f"int{i}"] else "double") if row[f"ok{i}"] else None)
           for i, n in enumerate(cols)}
    out.update({n: ("bigint" if row[f"cint{i}"] else "double")
                for i, n in enumerate(coerce_cols or [])})
    return out


def _p2_targets(df: DataFrame, cols: list[str] | None) -> list[str]:
    strs = set(string_columns(df))
    return [n for n in df.columns if n in set(cols or []) and n in strs]


def strip_thousands(df: DataFrame, cols: list[str], kinds: dict | None = None) -> DataFrame:
    """For the named text columns that exist, drop "," and parse; a value
    that does not parse becomes NULL (per value, not per column). The type is
    bigint when every value is an integer, else double (one probe job unless
    ``kinds`` is given)."""
    todo = _p2_targets(df, cols)
    if kinds is None:
        kinds = numeric_probe(df, [], todo)
    return df.select(*[(strict_numeric(_no_commas(c(n)), kinds[n]).alias(n) if n in todo
                        else c(n)) for n in df.columns])


def infer_numeric(df: DataFrame, cols: list[str] | None = None, skip: list[str] | None = None,
                  kinds: dict | None = None, guard: bool = False) -> DataFrame:
    """A text column becomes numeric only if every non-missing value parses;
    otherwise the whole column stays text. "" counts as missing. With ``guard``
    a value without numeric shape becomes NULL (types that were not probed here)."""
    cand = [n for n in (cols if cols is not None else string_columns(df))
            if n in set(string_columns(df)) and n not in set(skip or [])]
    if kinds is None:
        kinds = numeric_probe(df, cand)
    # the probe proved every non-missing value has the numeric shape: no per-value regex
    return df.select(*[
        (strict_numeric(c(n), kinds[n], guard=guard).alias(n) if kinds.get(n) and n in cand
         else c(n))
        for n in df.columns])


def probe_types(df: DataFrame, thousands_cols: list[str] | None = None) -> dict[str, str | None]:
    """The column types that ``clean_dataframe`` gives ``df``, to be saved with the training state."""
    d = nullify_tokens(nan_to_null(df))
    p3 = [n for n in string_columns(d) if n not in set(thousands_cols or [])]
    return numeric_probe(d, p3, _p2_targets(d, thousands_cols))


def clean_dataframe(df: DataFrame, thousands_cols: list[str] | None = None,
                    kinds: dict[str, str | None] | None = None) -> DataFrame:
    """P1 -> P2 -> P3 (P3 skips the P2 columns), after NaN has become NULL.
    The types of P2 and P3 are decided together in ONE aggregation job over the
    P1 output; ``kinds`` (types saved by training) skips it, so that a batch or a
    stream at inference gets the types of training."""
    d = nullify_tokens(nan_to_null(df))
    p2 = _p2_targets(d, thousands_cols)
    p3 = [n for n in string_columns(d) if n not in set(thousands_cols or [])]
    saved = kinds is not None
    if not saved:
        kinds = probe_types(df, thousands_cols)
    d = strip_thousands(d, p2, {n: kinds.get(n) or "double" for n in p2})
    return infer_numeric(d, p3, kinds=kinds, guard=saved)


# ------------------------------------------------------------------ P5-P9

def fill_missing(df: DataFrame, columns: list[str], value=None) -> DataFrame:
    """P5: fill NULLs of ``columns`` with ``value``; ``None`` is a no-op.
    Unlike ``DataFrame.fillna`` a column of another type raises instead of
    being skipped silently."""
    if value is None:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    for n in columns:
        if n not in types:
            raise KeyError(n)
        t = types[n]
        ok = (isinstance(value, str) and isinstance(t, StringType)) or (
            isinstance(value, (int, float)) and not isinstance(value, bool)
            and isinstance(t, NumericType))
        if not ok:
            raise TypeError(f"cannot fill column {n!r} of type {t.simpleString()} with {value!r}")
    return df.fillna(value, subset=list(columns))


def columns_by_type(df: DataFrame, exclude: list[str] | None = None) -> dict[str, list[str]]:
    """String and numeric column names, in table order."""
    ex = set(exclude or [])
    return {"string": [n for n in string_columns(df) if n not in ex],
            "numeric": [n for n in numeric_columns(df) if n not in ex]}


def columns_by_pattern(columns: list[str], contains: tuple = ("Daysto",),
                       contains_not_suffix: tuple = (("HCC", "_HCC"), ("CCS", "_CCS"))) -> list[str]:
    """Names containing any ``contains`` text, or containing X without ending
    in the paired suffix; sorted and unique."""
    hits = [n for n in columns if any(s in n for s in contains)]
    for sub, suf in contains_not_suffix:
        hits += [n for n in columns if sub in n and not n.endswith(suf)]
    return sorted(set(hits))


def select_saved_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Project to a saved ordered list; a missing column is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not in table: {missing}")
    return df.select(*[c(n) for n in names])


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by list (names that are absent are ignored)."""
    return df.drop(*[n for n in names if n in df.columns])


# ------------------------------------------------------------------ P10-P14

def missing_indicators(df: DataFrame, cols: list[str] | None = None, key: str | None = None,
                       suffix: str = "_missing") -> DataFrame:
    """P10: ``<col>_missing`` 0/1 for every feature column, after the originals."""
    feats = cols if cols is not None else [n for n in df.columns if n != key]
    return df.select("*", *[c(n).isNull().cast("int").alias(n + suffix) for n in feats])


# Label text and its code after trailing dots are stripped.
LABEL_MAP = (("<=50K", 0), (">50K", 1))


def encode_label_expr(col: Column, mapping=LABEL_MAP) -> Column:
    """Strip all trailing ".", then map; anything else -> NULL."""
    s = F.rtrim(col, F.lit("."))
    expr = None
    for text, code in mapping:
        expr = (F.when(s == F.lit(text), F.lit(code)) if expr is None
                else expr.when(s == F.lit(text), F.lit(code)))
    return expr.cast("int")


def encode_label(df: DataFrame, col: str = "income", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, encode_label_expr(c(col)))


def top_n_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """A4: the ``n`` most frequent non-missing values (count desc, then value
    asc, since rows have no order in Spark). ``groupBy`` is map-side combined;
    the ordered limit is a single TakeOrderedAndProject of ``n`` rows."""
    return (df.where(c(col).isNotNull()).groupBy(c(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")).limit(n))


def bucket_rare_fit(df: DataFrame, col: str, n: int = 10) -> list:
    """P12 fit: the kept categories (at most ``n``, so safe to inline)."""
    return [r["value"] for r in top_n_values(df, col, n).collect()]


def bucket_rare_apply(df: DataFrame, col: str, keep: list, other: str = "other") -> DataFrame:
    """P12 apply: values outside ``keep`` become ``other``; NULL stays NULL."""
    v = c(col)
    return df.withColumn(col, F.when(v.isNull(), v).when(v.isin(list(keep)), v)
                         .otherwise(F.lit(other)))


def id_params(seed: int, span: int = 9 * 10 ** 8) -> tuple[int, int]:
    """``a`` coprime to ``span`` = 9 * 10^d (a = 30m + 1 is odd, not divisible by 3 or 5), ``b`` any."""
    m = (seed * 7919) % 1_000_000
    return 30 * m + 1, (seed * 104_729) % span


def add_ids(df: DataFrame, source_key: str, seed: int = 111, out: str = "census_id", num_digits: int = 9) -> DataFrame:
    """Unique id of ``num_digits`` digits per row, ``10^(d-1) + (a*i + b) mod 9*10^(d-1)`` where ``i``
    is the 0-based rank of ``md5(key:seed)``. Unique by construction (the map
    is a bijection), no random pool to shuffle; raises if the table has more
    rows than there are such ids. The rank comes from equal buckets of the
    uniform digest plus bucket offsets (``running.hash_row_number``), not a
    single-task global window."""
    if not 1 <= num_digits <= 18:
        raise ValueError("num_digits must be between 1 and 18")
    low = 10 ** (num_digits - 1)
    span = 9 * low
    n = df.count()
    if n > span:
        raise ValueError(f"{n} rows need more than {num_digits} digits")
    a, b = id_params(seed, span)
    cols = md5_order_cols(c(source_key), seed)
    d = df.select("*", *[x.alias(f"_o{i}") for i, x in enumerate(cols)])
    ranked = hash_row_number(d, "_o0", ["_o1", "_o2"], out="_i").drop("_o0", "_o1", "_o2")
    # beyond 2^63 the product needs a decimal
    product = F.lit(a) * F.col("_i") if a * max(n, 1) + b < 2 ** 63 else F.lit(a).cast("decimal(38,0)") * F.col("_i")
    ident = F.lit(low) + F.pmod(product + F.lit(b), F.lit(span))
    return ranked.withColumn(out, ident.cast("bigint")).drop("_i")


def feature_target_split(df: DataFrame, key: str, target: str = "income",
                         extra: tuple = ("race", "sex")) -> tuple[DataFrame, DataFrame]:
    """X = numeric columns (table order) then ``extra``; y = key + target.
    The key is in both and never a feature; the target never in X."""
    nums = [n for n in numeric_columns(df) if n not in (key, target)]
    xs = nums + [n for n in extra if n in df.columns and n not in nums]
    return df.select(c(key), *[c(n) for n in xs]), df.select(c(key), c(target))


# ------------------------------------------------------------------ F1-F2

def missing_fraction_expr(cols: list[str]) -> Column:
    """Share of NULL cells among ``cols`` for one row (0-1)."""
    total = F.lit(0)
    for n in cols:
        total = total + c(n).isNull().cast("int")
    return total / F.lit(float(len(cols)))


def filter_sparse_rows(df: DataFrame, key: str | None = None, gain_col: str = "capital-gain",
                       threshold: float = 0.5) -> DataFrame:
    """drop a row when ``gain == 0`` and its missing share (over non-key
    columns) is above ``threshold`` (strict). A missing gain keeps the row;
    without the gain column the rule is off."""
    if gain_col not in df.columns:
        return df
    cols = [n for n in df.columns if n != key]
    drop = (c(gain_col) == 0) & (missing_fraction_expr(cols) > F.lit(float(threshold)))
    return df.where(~F.coalesce(drop, F.lit(False)))


def row_missing_fraction(df: DataFrame, key: str | None = None,
                         out: str = "percentage_missing") -> DataFrame:
    """per-row missing share over the non-key columns, not counting itself."""
    cols = [n for n in df.columns if n != key]
    return df.withColumn(out, missing_fraction_expr(cols))


__all__ = [n for n in dir() if not n.startswith("_")] + ["NUMERIC_SHAPE", "q"]
