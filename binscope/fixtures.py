"""Derived input views over the given tables (see FIXTURES.md).

Each view exists twice: as a Spark DataFrame builder (what the operators run
on) and as DuckDB SQL text (what the oracle queries in ``catalog`` run on).
Both are plain arithmetic on the same columns, so they return the same rows.

Scale notes: ``orders`` x ``customer`` is the only large join; nation/region are
fixed-size dimension tables and Spark's size-checked auto-broadcast handles
them. The two scored models come from one pass via ``explode`` of a two-element
array, not a union that would run the join twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binscope.sources.parquet import read_table

# ---------------------------------------------------------------- Spark side


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, model, split, race, sex, y, p``: two models over all orders."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    re_ = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    b = (o.join(cu, o.o_custkey == cu.c_custkey)
         .join(na, cu.c_nationkey == na.n_nationkey)
         .join(re_, na.n_regionkey == re_.r_regionkey))
    key = F.col("o_orderkey")
    pa = ((key * 37) % 1000).cast("double") / 1000
    noise = ((F.col("o_custkey") * 91 + key * 13) % 997).cast("double") / 997
    split = (F.when(key % 10 < 6, "train").when(key % 10 < 8, "valid").otherwise("test"))
    y = F.when(F.lit(0.6) * pa + F.lit(0.4) * noise > F.lit(0.55), 1).otherwise(0).cast("int")
    base = b.select(key.alias("id"), F.col("c_mktsegment").alias("race"),
                    F.col("r_name").alias("sex"), split.alias("split"), pa.alias("pa"), y.alias("y"))
    pb = ((F.col("id") * 53 + F.col("y") * 211) % 1009).cast("double") / 1009
    both = F.explode(F.array(
        F.struct(F.lit("a").alias("model"), F.col("pa").alias("p")),
        F.struct(F.lit("b").alias("model"), pb.alias("p"))))
    return (base.select("id", "split", "race", "sex", "y", both.alias("m"))
            .select("id", F.col("m.model").alias("model"), "split", "race", "sex", "y",
                    F.col("m.p").alias("p")))


def wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty wide table: NULL patterns, text numbers, tokens, thousands commas."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = o.join(cu, o.o_custkey == cu.c_custkey)
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    sparse = k % 17 == 0
    null = F.lit(None)
    return j.select(
        k.alias("row_id"),
        F.when((k % 11 == 0) | sparse, null).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when((k % 7 == 0) | sparse, null).otherwise(F.col("c_acctbal")).alias("balance"),
        F.when(k % 13 == 0, null).when(k % 3 == 0, F.col("o_totalprice") / 10)
        .otherwise(F.lit(0.0)).alias("capital-gain"),
        F.lit(1.0).alias("constant_col"),
        F.when(k % 4 == 0, F.col("c_acctbal")).alias("mostly_missing"),
        F.when(k % 5 < 2, F.col("o_totalprice")).alias("edge_missing"),
        F.when(sparse, null).otherwise(ck.cast("string")).alias("num_text"),
        F.when(k % 10 == 0, "").when(k % 10 == 1, "--").when(k % 10 == 2, "x..y")
        .when(k % 10 == 3, "-").otherwise(ck.cast("string")).alias("dirty_text"),
        F.when(sparse, null).otherwise(F.concat(
            (F.lit(1) + k % 89).cast("string"), F.lit(","),
            F.lpad((ck % 1000).cast("string"), 3, "0"))).alias("money_text"),
        F.when(sparse, null).otherwise(F.col("o_orderpriority")).alias("marital-status"),
        F.when(sparse, null).otherwise(F.col("c_mktsegment")).alias("race"),
        F.when(sparse, null).otherwise(F.col("o_orderstatus")).alias("sex"),
        F.when(k % 6 == 0, ">50K").when(k % 6 == 1, ">50K.").when(k % 6 == 2, "<=50K..")
        .otherwise("<=50K").alias("income"),
    )


def docs_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: natural NULLs in ``quality``/``toxic``."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings; class 1 (minority) = label 0 against the rest."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", "label",
                    (F.col("label") == 0).cast("int").alias("y"))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the JSON property ``k`` as text."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value",
                    F.get_json_object("props", "$.k").alias("k_text"))


# The linear model used by the explanation operators.
COEFS = (("amount", 0.00002), ("balance", -0.0003), ("num_text", 0.0015))


# ---------------------------------------------------------------- DuckDB side

SCORED_SQL = """
WITH b AS (
  SELECT o_orderkey AS id, c_mktsegment AS race, r_name AS sex,
         CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1000 AS pa,
         CAST((o_custkey * 91 + o_orderkey * 13) % 997 AS DOUBLE) / 997 AS noise,
         CASE WHEN o_orderkey % 10 < 6 THEN 'train' WHEN o_orderkey % 10 < 8 THEN 'valid' ELSE 'test' END AS split
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
yy AS (SELECT *, CASE WHEN CAST(0.6 AS DOUBLE) * pa + CAST(0.4 AS DOUBLE) * noise > CAST(0.55 AS DOUBLE)
                 THEN 1 ELSE 0 END AS y FROM b)
SELECT id, 'a' AS model, split, race, sex, y, pa AS p FROM yy
UNION ALL
SELECT id, 'b' AS model, split, race, sex, y, CAST((id * 53 + y * 211) % 1009 AS DOUBLE) / 1009 AS p FROM yy
"""

WIDE_RAW_SQL = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS amount,
  CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE c_acctbal END AS balance,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_totalprice / 10
       ELSE CAST(0 AS DOUBLE) END AS "capital-gain",
  CAST(1 AS DOUBLE) AS constant_col,
  CASE WHEN o_orderkey % 4 = 0 THEN c_acctbal END AS mostly_missing,
  CASE WHEN o_orderkey % 5 < 2 THEN o_totalprice END AS edge_missing,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS num_text,
  CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN '--' WHEN 2 THEN 'x..y' WHEN 3 THEN '-'
       ELSE CAST(o_custkey AS VARCHAR) END AS dirty_text,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
       ELSE concat(CAST(1 + o_orderkey % 89 AS VARCHAR), ',', lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0')) END AS money_text,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS "marital-status",
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS race,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS sex,
  CASE o_orderkey % 6 WHEN 0 THEN '>50K' WHEN 1 THEN '>50K.' WHEN 2 THEN '<=50K..' ELSE '<=50K' END AS income
FROM orders JOIN customer ON o_custkey = c_custkey
"""

DOCS_LABELLED_SQL = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

VECTORS_SQL = """
SELECT vec_id, embedding, label, CAST(label = 0 AS INTEGER) AS y FROM embeddings
"""

EVENT_PROPS_SQL = """
SELECT event_id, user_id, event_type, value, json_extract_string(props, '$.k') AS k_text FROM events
"""

COEFS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{f}', CAST({v!r} AS DOUBLE))" for f, v in COEFS) + ") t(feature, coef)"

VIEW_SQL = {
    "scored": SCORED_SQL,
    "wide_raw": WIDE_RAW_SQL,
    "docs_labelled": DOCS_LABELLED_SQL,
    "vectors": VECTORS_SQL,
    "event_props": EVENT_PROPS_SQL,
    "coefs": COEFS_SQL,
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with ``WITH name AS (...)`` for the named fixture views."""
    defs = [(n, VIEW_SQL[n]) for n in names]
    if extra:
        defs += list(extra.items())
    if not defs:
        return sql
    body = ",\n".join(f"{n} AS ({s.strip()})" for n, s in defs)
    rest = sql.strip()
    if rest[:5].upper() == "WITH ":
        return f"WITH {body},\n{rest[5:]}"
    return f"WITH {body}\n{rest}"


# ---------------------------------------------------------------- run registry views

# Model and pipeline names of the reference's training runs.
RUN_MODELS = ("lr", "rf", "xgb", "cat")
RUN_PIPELINES = (("AUTOMOBILE", "orig"), ("BUILDING", "smote"), ("FURNITURE", "under"),
                 ("HOUSEHOLD", "orig_rfe"), ("MACHINERY", "smote_rfe"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per (nation, market segment) of ``customer``: ``experiment,
    run_id, run_name, start_time`` plus the run's statistics ``n_customers``,
    ``average_precision`` (NULL for every fourth run size) and ``roc_auc``."""
    cu = read_table(spark, sf_dir, "customer")
    g = cu.groupBy("c_nationkey", "c_mktsegment").agg(
        F.min("c_custkey").alias("start_time"), F.count(F.lit(1)).alias("n_customers"),
        F.avg("c_acctbal").alias("bal"))
    model = F.element_at(F.array(*[F.lit(m) for m in RUN_MODELS]),
                         (F.col("c_nationkey") % 4 + 1).cast("int"))
    pipe = F.lit("orig")
    for seg, name in reversed(RUN_PIPELINES):
        pipe = F.when(F.col("c_mktsegment") == seg, F.lit(name)).otherwise(pipe)
    return g.select(
        F.concat(F.lit("exp_"), (F.col("c_nationkey") % 3).cast("string")).alias("experiment"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_mktsegment")).alias("run_id"),
        F.concat(model, F.lit("_"), pipe, F.lit("_training")).alias("run_name"),
        F.col("start_time").cast("bigint").alias("start_time"),
        "n_customers",
        F.when(F.col("n_customers") % 4 != 0, F.col("bal") / 10000).alias("average_precision"),
        (F.col("bal") / 20000 + 0.5).alias("roc_auc"))


RUNS_SQL = """
SELECT 'exp_' || CAST(c_nationkey % 3 AS VARCHAR) AS experiment,
       CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment AS run_id,
       ['lr', 'rf', 'xgb', 'cat'][c_nationkey % 4 + 1] || '_' ||
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'orig' WHEN 'BUILDING' THEN 'smote'
            WHEN 'FURNITURE' THEN 'under' WHEN 'HOUSEHOLD' THEN 'orig_rfe'
            WHEN 'MACHINERY' THEN 'smote_rfe' ELSE 'orig' END || '_training' AS run_name,
       CAST(min(c_custkey) AS BIGINT) AS start_time, count(*) AS n_customers,
       CASE WHEN count(*) % 4 <> 0 THEN avg(c_acctbal) / 10000 END AS average_precision,
       avg(c_acctbal) / 20000 + 0.5 AS roc_auc
FROM customer GROUP BY c_nationkey, c_mktsegment
"""
VIEW_SQL["runs"] = RUNS_SQL
