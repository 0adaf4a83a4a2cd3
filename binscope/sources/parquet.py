"""Sources and sinks.

Reads are lazy: nothing is scanned until an action, and Catalyst prunes the
columns and pushes filters into the Parquet reader. Writes keep the key as an
ordinary column (never an index) so the next step can join on it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from binscope.functions.exprs import q


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scan_parquet(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Read a Parquet table; ``key`` must be one of its columns when given."""
    df = spark.read.parquet(path)
    if key is not None and key not in df.columns:
        raise KeyError(f"key column {key!r} not in {df.columns}")
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write Parquet; the key stays a column."""
    df.write.mode(mode).parquet(path)


# NULL is written as an explicit marker so that an empty string survives the round trip.
NULL_TOKEN = "\\N"


def write_csv(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite") -> None:
    """S3: write CSV with a header line, key first."""
    if key is not None:
        df = df.select(q(key), *[q(c) for c in df.columns if c != key])
    (df.write.mode(mode).option("header", True).option("nullValue", NULL_TOKEN)
     .option("emptyValue", '""').csv(path))


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back a CSV written by :func:`write_csv` with an explicit schema (no inference pass)."""
    return (spark.read.option("header", True).option("nullValue", NULL_TOKEN)
            .option("emptyValue", "").schema(schema).csv(path))


SET_NAMES = ("X_train", "X_valid", "X_test", "y_train", "y_valid", "y_test")


def load_variant_data(spark: SparkSession, data_variants: dict, path: str, outcomes_map: dict,
                      return_sets: list[str] | None = None) -> tuple:
    """Six files ``<set>_<variant>.parquet`` per variant, handed out per outcome.

    ``data_variants`` maps a variant key to the file suffix; ``outcomes_map``
    maps an outcome to a variant key. Result: one dict per set name
    (``X_train`` ... ``y_test``) of ``{outcome: DataFrame}``, plus ``outcomes``
    = ``{outcome: {set: DataFrame}}``. An outcome whose variant key is unknown
    gets ``None``. ``return_sets`` picks and orders the returned items. Reads are
    lazy (schema only), so unused sets cost nothing.
    """
    loaded = {key: {s: spark.read.parquet(os.path.join(path, f"{s}_{variant}.parquet"))
                    for s in SET_NAMES}
              for key, variant in data_variants.items()}
    datasets: dict = {s: {o: (loaded[v][s] if v in loaded else None)
                          for o, v in outcomes_map.items()} for s in SET_NAMES}
    datasets["outcomes"] = {o: {s: (loaded[v][s] if v in loaded else None) for s in SET_NAMES}
                            for o, v in outcomes_map.items()}
    names = list(return_sets) if return_sets else list(datasets)
    return tuple(datasets[n] for n in names)


def union_variant_sets(sets: dict[str, DataFrame], part_name: str = "part") -> DataFrame:
    """Union form of S4: one DataFrame tagged with ``part`` (X/y) and ``split``."""
    dfs = []
    for name, df in sets.items():
        part, split = name.split("_", 1)
        dfs.append(df.withColumn(part_name, F.lit(part)).withColumn("split", F.lit(split)))
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
