"""Scalar building blocks.

Everything returns a ``Column`` made of built-in functions so that it compiles
into whole-stage codegen; none of these needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must agree with the reference's parsing rules):
# a text cell counts as missing when it is exactly "" or contains two or more
# dashes or two or more dots anywhere. "Two or more in a row" is the same as
# containing the doubled character, so a plain substring test is used.
MISSING_TOKEN_SUBSTRINGS = ("--", "..")

# Shape of a value that pandas' numeric parser accepts (leading/trailing blanks,
# optional sign, decimal or exponent form, inf/infinity). Spark's cast also
# accepts "NaN", "5d", "1f", which pandas rejects, so casts are guarded by it.
NUMERIC_SHAPE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
INTEGER_SHAPE = r"^\s*[+-]?\d+\s*$"


def q(name: str) -> str:
    """Backtick-quote a column name (names such as ``capital-gain`` need it)."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    return F.col(q(name))


def is_missing_token(col: Column) -> Column:
    """True when a string cell is one of the missing-value tokens."""
    cond = col == F.lit("")
    for sub in MISSING_TOKEN_SUBSTRINGS:
        cond = cond | col.contains(sub)
    return cond


def numeric_ok(col: Column) -> Column:
    """NULL and "" count as missing (fine); anything else must look numeric."""
    return col.isNull() | (col == F.lit("")) | col.rlike(NUMERIC_SHAPE)


def strict_numeric(col: Column, to: str = "double", guard: bool = True) -> Column:
    """Parse a numeric-looking string, NULL for anything else (per value).
    ``guard=False`` skips the shape test when every non-missing value is
    already known to have the numeric shape (after a probe)."""
    trimmed = F.trim(col)
    if not guard:
        return trimmed.try_cast(to)
    return F.when(col.rlike(NUMERIC_SHAPE), trimmed.try_cast(to))


# Characters that only non-integer numeric shapes contain (".", exponent, inf).
NON_INTEGER_CHARS = (".", "e", "E", "i", "I")


def integer_given_shape(col: Column) -> Column:
    """For a value already known to have the numeric shape: present, not "",
    and an integer (no decimal point, exponent or infinity)."""
    cond = col.isNotNull() & (col != F.lit(""))
    for ch in NON_INTEGER_CHARS:
        cond = cond & ~col.contains(ch)
    return cond


def np_round(col: Column, digits: int) -> Column:
    """Round half to even on the scaled value, like numpy's ``round``."""
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode raises on x/0)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def md5_order_key(key: Column, seed: int | str) -> Column:
    """Deterministic pseudo-random sort key, identical in Spark and DuckDB."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def md5_order_cols(key: Column, seed: int | str) -> list[Column]:
    """Columns ordering rows by ``md5(key:seed)`` then key: a numeric prefix
    (first 15 hex digits, 60 bits, usable for percentile bucketing), the full
    digest and the key as tie-breakers. Same order as sorting by the digest."""
    h = md5_order_key(key, seed)
    return [F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), h, key]


def md5_uniform(*parts: Column | str) -> Column:
    """Uniform number in [0, 1) from the first 8 hex digits of md5(parts joined by ':')."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    joined = F.concat_ws(":", *[x.cast("string") for x in cols])
    hex8 = F.substring(F.md5(joined), 1, 8)
    return F.conv(hex8, 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)
