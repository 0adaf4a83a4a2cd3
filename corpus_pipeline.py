"""A training-corpus pipeline over ``documents``: quality, near-dedup, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The first four
return the columns of ``documents``; the last returns each document with its token statistics.

Defined results: rows are treated one by one, repeated rows and rows with null ids included; a null or
empty text fails the quality rules; empty tables give empty results; columns that ``docs`` has beyond
those of ``documents`` pass through the first four stages unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binscope.llm import decontaminate, neardup, pieces, quality, secrets
from binscope.llm.queries import tokenizer_path
from binscope.session import cut_lineage, ensure_checkpoint_dir, table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and the quality model."""
    model = quality.fit_quality(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    found = quality.score_quality(docs, model)
    return found.filter("_quality.kept").select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, that of the least id."""
    return neardup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents in which a benchmark window occurs."""
    return decontaminate.decontaminate(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows a changed text."""
    out = secrets.redact(docs.withColumn("__before", F.col("text")))
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col("__before"))
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text."""
    found = pieces.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"])
    return found.select("doc_id", "_pieces.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("tokenize", tokenize),
]

#: Learned quality weights and the tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
