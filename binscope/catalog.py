"""Registered queries: one Spark callable and, where SQL can say it, one DuckDB
oracle per operator key of the survey's inventory.

Every query reads the given tables (or views Spark derives from them in
``fixtures``) in full. Double results are rounded to 6 decimals half-to-even on
both sides (``rint`` in Spark, ``round_even`` in DuckDB, identical on the same
double), so engine-specific summation order cannot flip a value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from binscope import fixtures as fx
from binscope.functions.exprs import np_round, q
from binscope.operators import metrics as M
from binscope.sources.parquet import read_table, scan_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column half-to-even (no-op for other types)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(np_round(F.col(q(f.name)).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(q(f.name)))
    return df.select(*cols)


def r6(expr: str) -> str:
    return f"round_even(CAST({expr} AS DOUBLE) * 1000000.0, 0) / 1000000.0"


def r3(expr: str) -> str:
    return f"round_even(CAST({expr} AS DOUBLE) * 1000.0, 0) / 1000.0"


def cum_sql(source: str, keys: list[str], label: str = "y", score: str = "p") -> str:
    """CTEs ``st`` (score table) and ``cum`` (running TP/FP, totals) for DuckDB."""
    k = ", ".join(keys)
    return f"""
st AS (SELECT {k}, {score} AS score, CAST(sum({label}) AS BIGINT) AS pos,
              CAST(sum(1 - {label}) AS BIGINT) AS neg
       FROM {source} GROUP BY {k}, {score}),
cum AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
               CAST(sum(pos) OVER (PARTITION BY {k}) AS BIGINT) AS tot_p,
               CAST(sum(neg) OVER (PARTITION BY {k}) AS BIGINT) AS tot_n
        FROM st
        WINDOW w AS (PARTITION BY {k} ORDER BY score DESC
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def summary_sql(keys: list[str], threshold: float = 0.5) -> str:
    """CTE ``g``: per-group totals, confusion at ``threshold``, AUC and AP numerators."""
    k = ", ".join(keys)
    t = repr(float(threshold))
    return f"""
g AS (SELECT {k}, CAST(sum(pos) AS BIGINT) AS pp, CAST(sum(neg) AS BIGINT) AS nn,
             CAST(sum(CASE WHEN score > {t} THEN pos ELSE 0 END) AS BIGINT) AS tpt,
             CAST(sum(CASE WHEN score > {t} THEN neg ELSE 0 END) AS BIGINT) AS fpt,
             sum(CAST(neg AS DOUBLE) * (CAST(tp AS DOUBLE) - CAST(pos AS DOUBLE) / 2)) AS auc_num,
             sum(CAST(pos AS DOUBLE) * CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) AS ap_num
      FROM cum GROUP BY {k})"""


def share_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def ratio_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


# ============================================================ 2.1 sources

@register("scan_parquet", "SELECT * FROM customer")
def q_scan_parquet(spark, sf):
    return scan_parquet(spark, f"{sf}/customer.parquet", key="c_custkey")


# ============================================================ 2.3 / 2.10 metrics

@register("threshold_predict", fx.with_views(
    f"SELECT id, model, y, {r6('p')} AS p, CAST(p > 0.5 AS INTEGER) AS y_pred FROM scored", "scored"))
def q_threshold_predict(spark, sf):
    s = fx.scored(spark, sf)
    return rounded(M.threshold_predict(s, 0.5).select("id", "model", "y", "p", "y_pred"))


_CONF_SQL = """
SELECT model, split, CAST(0.5 AS DOUBLE) AS threshold,
  CAST(sum(CASE WHEN y <> 1 AND NOT p > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN y <> 1 AND p > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN y = 1 AND NOT p > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y = 1 AND p > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM scored GROUP BY model, split"""


@register("confusion_counts", fx.with_views(_CONF_SQL, "scored"))
def q_confusion_counts(spark, sf):
    return M.confusion_counts(fx.scored(spark, sf), ["model", "split"], 0.5)


@register("confusion_normalized", fx.with_views(f"""
WITH c AS ({_CONF_SQL})
SELECT model, split, threshold, 'true' AS normalize, {r6(share_sql('tn', 'tn + fp'))} AS tn,
       {r6(share_sql('fp', 'tn + fp'))} AS fp, {r6(share_sql('fn', 'fn + tp'))} AS fn,
       {r6(share_sql('tp', 'fn + tp'))} AS tp FROM c
UNION ALL
SELECT model, split, threshold, 'pred', {r6(share_sql('tn', 'tn + fn'))}, {r6(share_sql('fp', 'fp + tp'))},
       {r6(share_sql('fn', 'tn + fn'))}, {r6(share_sql('tp', 'fp + tp'))} FROM c
UNION ALL
SELECT model, split, threshold, 'all', {r6(share_sql('tn', 'tn + fp + fn + tp'))},
       {r6(share_sql('fp', 'tn + fp + fn + tp'))}, {r6(share_sql('fn', 'tn + fp + fn + tp'))},
       {r6(share_sql('tp', 'tn + fp + fn + tp'))} FROM c""", "scored"))
def q_confusion_normalized(spark, sf):
    return rounded(M.confusion_normalized(fx.scored(spark, sf), ["model", "split"], 0.5))


_RATES_SQL = f"""
WITH c AS ({_CONF_SQL})
SELECT *, {r6(share_sql('tp', 'tp + fp'))} AS precision, {r6(share_sql('tp', 'tp + fn'))} AS sensitivity,
       {r6(ratio_sql('tn', 'tn + fp'))} AS specificity, {r6(ratio_sql('tp + tn', 'tn + fp + fn + tp'))} AS accuracy,
       {r6(share_sql('2 * tp', '2 * tp + fp + fn'))} AS f1,
       {r6(ratio_sql('tp + fn', 'tn + fp + fn + tp'))} AS prevalence,
       {r6(ratio_sql('tp + fp', 'tn + fp + fn + tp'))} AS predicted_prevalence
FROM c"""


@register("classification_rates", fx.with_views(_RATES_SQL, "scored"))
def q_classification_rates(spark, sf):
    return rounded(M.classification_rates(fx.scored(spark, sf), ["model", "split"], 0.5))


_MS = ["model", "split"]


@register("roc_auc", fx.with_views(f"""
WITH {cum_sql('scored', _MS)}, {summary_sql(_MS)}
SELECT model, split, {r6(ratio_sql('auc_num', 'CAST(pp AS DOUBLE) * nn'))} AS roc_auc FROM g""", "scored"))
def q_roc_auc(spark, sf):
    return rounded(M.roc_auc(fx.scored(spark, sf), _MS))


@register("average_precision", fx.with_views(f"""
WITH {cum_sql('scored', _MS)}, {summary_sql(_MS)}
SELECT model, split, {r6(ratio_sql('ap_num', 'pp'))} AS average_precision FROM g""", "scored"))
def q_average_precision(spark, sf):
    return rounded(M.average_precision(fx.scored(spark, sf), _MS))


@register("brier_score", fx.with_views(f"""
SELECT model, split, {r6('avg((p - y) * (p - y))')} AS brier FROM scored GROUP BY model, split""",
                                       "scored"))
def q_brier_score(spark, sf):
    return rounded(M.brier_score(fx.scored(spark, sf), _MS))


def _metrics_long_sql(keys: list[str], threshold: float = 0.5) -> str:
    """CTE ``ml``: the six report metrics per group, long form, full precision."""
    k = ", ".join(keys)
    gk = ", ".join(f"g.{x}" for x in keys)
    on = " AND ".join(f"g.{x} = b.{x}" for x in keys)
    parts = [
        ("Precision/PPV", share_sql("tpt", "tpt + fpt")),
        ("Average Precision", ratio_sql("ap_num", "pp")),
        ("Sensitivity", share_sql("tpt", "pp")),
        ("Specificity", ratio_sql("nn - fpt", "nn")),
        ("AUC ROC", ratio_sql("auc_num", "CAST(pp AS DOUBLE) * nn")),
        ("Brier Score", "b.brier"),
    ]
    union = "\n    UNION ALL ".join(
        f"SELECT {gk}, '{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM g JOIN b ON {on}"
        for name, expr in parts)
    return f"""{cum_sql('scored', keys)}, {summary_sql(keys, threshold)},
b AS (SELECT {k}, avg((p - y) * (p - y)) AS brier FROM scored GROUP BY {k}),
ml AS ({union})"""


def _pivot_sql(col: str, values: list[str]) -> str:
    cols = ", ".join(f"max(CASE WHEN {col} = '{v}' THEN v3 END) AS \"{v}\"" for v in values)
    return f"""
SELECT metric, {cols}, {r3('avg(v3)')} AS "Mean"
FROM (SELECT metric, {col}, {r3('value')} AS v3 FROM ml) r GROUP BY metric"""


@register("metrics_report", fx.with_views(
    f"WITH {_metrics_long_sql(['model'])}\n{_pivot_sql('model', ['a', 'b'])}", "scored"))
def q_metrics_report(spark, sf):
    return M.metrics_report(fx.scored(spark, sf), ["model"], 0.5, models=["a", "b"])


@register("pivot_metrics", fx.with_views(
    f"WITH {_metrics_long_sql(['split'])}\n{_pivot_sql('split', ['test', 'train', 'valid'])}",
    "scored"))
def q_pivot_metrics(spark, sf):
    long = M.metrics_long(fx.scored(spark, sf), ["split"], 0.5)
    return M.pivot_metrics(long, "split", ["test", "train", "valid"])


# ============================================================ 2.1 sinks, 2.2 cleaning

from binscope.functions.exprs import NUMERIC_SHAPE, md5_uniform  # noqa: E402
from binscope.operators import clean as C  # noqa: E402
from binscope.operators import joins as J  # noqa: E402
from binscope.operators import profile as A  # noqa: E402
from binscope.operators import registry as N  # noqa: E402
from binscope.session import scratch_path  # noqa: E402
from binscope.sources import parquet as S  # noqa: E402

WIDE_COLS = ["row_id", "amount", "balance", "capital-gain", "constant_col", "mostly_missing",
             "edge_missing", "num_text", "dirty_text", "money_text", "marital-status", "race",
             "sex", "income"]
WIDE_STR = ["num_text", "dirty_text", "money_text", "marital-status", "race", "sex", "income"]
WIDE_NUM = ["amount", "balance", "capital-gain", "constant_col", "mostly_missing", "edge_missing"]


def dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def wide_select(over: dict[str, str] | None = None, cols=None) -> str:
    """Column list of wide_raw with some columns replaced by SQL expressions."""
    over = over or {}
    return ", ".join(f"{over[n]} AS {dq(n)}" if n in over else dq(n) for n in (cols or WIDE_COLS))


def token_sql(x: str) -> str:
    return (f"CASE WHEN {x} = '' OR regexp_matches({x}, '-{{2,}}') OR regexp_matches({x}, '\\.{{2,}}') "
            f"THEN NULL ELSE {x} END")


def strict_num_sql(x: str, to: str = "DOUBLE") -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMERIC_SHAPE}') THEN TRY_CAST(trim({x}) AS {to}) END"


@register("write_parquet_roundtrip", fx.with_views(f"SELECT {wide_select()} FROM wide_raw", "wide_raw"))
def q_write_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "wide_raw_parquet")
    S.write_parquet(fx.wide_raw(spark, sf), path)
    return S.scan_parquet(spark, path, key="row_id")


@register("write_csv_roundtrip", fx.with_views(f"SELECT {wide_select()} FROM wide_raw", "wide_raw"))
def q_write_csv_roundtrip(spark, sf):
    df = fx.wide_raw(spark, sf)
    path = scratch_path(spark, "wide_raw_csv")
    S.write_csv(df, path, key="row_id")
    return S.read_csv(spark, path, df.schema)


_SPLIT_U = "('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':split'), 1, 8))::BIGINT / 4294967296.0"
_SPLIT_SQL = (f"CASE WHEN {_SPLIT_U} < 0.6 THEN 'train' WHEN {_SPLIT_U} < 0.8 THEN 'valid' "
              f"ELSE 'test' END")


@register("load_variant_data", fx.with_views(f"""
SELECT row_id, amount, balance, NULL::VARCHAR AS income, {_SPLIT_SQL} AS split, 'X' AS part FROM wide_raw
UNION ALL
SELECT row_id, NULL::DOUBLE, NULL::DOUBLE, income, {_SPLIT_SQL}, 'y' FROM wide_raw""", "wide_raw"))
def q_load_variant_data(spark, sf):
    w = fx.wide_raw(spark, sf)
    u = md5_uniform(F.col("row_id"), "split")
    w = w.withColumn("_split", F.when(u < 0.6, "train").when(u < 0.8, "valid").otherwise("test"))
    root = scratch_path(spark, "variants")
    for split in ("train", "valid", "test"):
        part = w.where(F.col("_split") == split)
        S.write_parquet(part.select("row_id", "amount", "balance"), f"{root}/X_{split}_orig.parquet")
        S.write_parquet(part.select("row_id", "income"), f"{root}/y_{split}_orig.parquet")
    (outcomes,) = S.load_variant_data(spark, {"orig": "orig"}, root, {"income": "orig"},
                                      return_sets=["outcomes"])
    return S.union_variant_sets(outcomes["income"]).select(
        "row_id", "amount", "balance", "income", "split", "part")


@register("nullify_tokens", fx.with_views(
    f"SELECT {wide_select({n: token_sql(dq(n)) for n in WIDE_STR})} FROM wide_raw", "wide_raw"))
def q_nullify_tokens(spark, sf):
    return C.nullify_tokens(fx.wide_raw(spark, sf))


_MONEY_NOCOMMA = "replace(money_text, ',', '')"


@register("strip_thousands", fx.with_views(
    f"SELECT {wide_select({'money_text': strict_num_sql(_MONEY_NOCOMMA)})} FROM wide_raw",
    "wide_raw"))
def q_strip_thousands(spark, sf):
    return C.strip_thousands(fx.wide_raw(spark, sf), ["money_text", "not_there"])


@register("infer_numeric", fx.with_views(
    f"SELECT {wide_select({'num_text': strict_num_sql('num_text')})} FROM wide_raw", "wide_raw"))
def q_infer_numeric(spark, sf):
    return C.infer_numeric(fx.wide_raw(spark, sf))


_CLEAN_OVER = {n: token_sql(dq(n)) for n in WIDE_STR}
_CLEAN_OVER["num_text"] = strict_num_sql(token_sql("num_text"))
_CLEAN_OVER["money_text"] = strict_num_sql(f"replace({token_sql('money_text')}, ',', '')")
_CLEAN_SQL = f"SELECT {wide_select(_CLEAN_OVER)} FROM wide_raw"


@register("clean_dataframe", fx.with_views(_CLEAN_SQL, "wide_raw"))
def q_clean_dataframe(spark, sf):
    return C.clean_dataframe(fx.wide_raw(spark, sf), ["money_text"])


@register("fill_missing", fx.with_views(
    f"SELECT {wide_select({'amount': 'coalesce(amount, 0.0)', 'balance': 'coalesce(balance, 0.0)'})} "
    "FROM wide_raw", "wide_raw"))
def q_fill_missing(spark, sf):
    return C.fill_missing(fx.wide_raw(spark, sf), ["amount", "balance"], 0.0)


def _state_df(spark, name: str, values: list) -> DataFrame:
    return spark.createDataFrame([(name, i, v) for i, v in enumerate(values)],
                                 "state_name string, pos int, value string")


def _values_sql(name: str, values: list[str]) -> str:
    rows = ", ".join(f"('{name}', {i}, '{v}')" for i, v in enumerate(values))
    return f"SELECT * FROM (VALUES {rows}) t(state_name, pos, value)"


_CLEAN_STR = ["dirty_text", "marital-status", "race", "sex", "income"]
_CLEAN_NUM = ["row_id", "amount", "balance", "capital-gain", "constant_col", "mostly_missing",
              "edge_missing", "num_text", "money_text"]


@register("columns_by_type", _values_sql("string", _CLEAN_STR) + "\nUNION ALL\n"
          + _values_sql("numeric", _CLEAN_NUM))
def q_columns_by_type(spark, sf):
    kinds = C.columns_by_type(C.clean_dataframe(fx.wide_raw(spark, sf), ["money_text"]))
    return _state_df(spark, "string", kinds["string"]).unionByName(
        _state_df(spark, "numeric", kinds["numeric"]))


_LI_MATCH = ["l_discount", "l_extendedprice", "l_linenumber", "l_linestatus", "l_orderkey",
             "l_partkey", "l_quantity", "l_returnflag", "l_suppkey", "l_tax"]


@register("columns_by_pattern", f"SELECT {', '.join(_LI_MATCH)} FROM lineitem")
def q_columns_by_pattern(spark, sf):
    li = read_table(spark, sf, "lineitem")
    names = C.columns_by_pattern(li.columns, contains=("price",),
                                 contains_not_suffix=(("l_", "date"),))
    return li.select(*names)


_KEPT = [n for n in WIDE_COLS if n not in ("row_id", "mostly_missing", "income")]


@register("select_saved_columns", fx.with_views(
    f"SELECT {wide_select(cols=['row_id'] + _KEPT)} FROM wide_raw", "wide_raw"))
def q_select_saved_columns(spark, sf):
    w = fx.wide_raw(spark, sf)
    kept = [r["column"] for r in A.keep_columns_below(w, 60.0, key="row_id", exclude=["income"])
            .orderBy("pos").collect()]
    return C.select_saved_columns(w, ["row_id"] + kept)


@register("drop_columns", fx.with_views(
    f"SELECT {wide_select(cols=[n for n in WIDE_COLS if n not in ('constant_col', 'income')])} "
    "FROM wide_raw", "wide_raw"))
def q_drop_columns(spark, sf):
    w = fx.wide_raw(spark, sf)
    return C.drop_columns(w, A.zero_variance_columns(w, key="row_id") + ["income"])


@register("missing_indicators", fx.with_views(
    f"SELECT {wide_select()}, "
    + ", ".join(f"CAST({dq(n)} IS NULL AS INTEGER) AS {dq(n + '_missing')}" for n in WIDE_COLS[1:])
    + " FROM wide_raw", "wide_raw"))
def q_missing_indicators(spark, sf):
    return C.missing_indicators(fx.wide_raw(spark, sf), key="row_id")


_LABEL_SQL = "CASE rtrim(income, '.') WHEN '<=50K' THEN 0 WHEN '>50K' THEN 1 END"


@register("encode_label", fx.with_views(
    f"SELECT row_id, income, CAST({_LABEL_SQL} AS INTEGER) AS y FROM wide_raw", "wide_raw"))
def q_encode_label(spark, sf):
    return C.encode_label(fx.wide_raw(spark, sf).select("row_id", "income"), "income", "y")


@register("bucket_rare", """
WITH top AS (SELECT p_type FROM part GROUP BY p_type ORDER BY count(*) DESC, p_type ASC LIMIT 10)
SELECT p_partkey, CASE WHEN p_type IS NULL THEN NULL WHEN p_type IN (SELECT p_type FROM top)
                       THEN p_type ELSE 'other' END AS p_type
FROM part""")
def q_bucket_rare(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_type")
    keep = C.bucket_rare_fit(part, "p_type", 10)
    return C.bucket_rare_apply(part, "p_type", keep)


_A, _B = C.id_params(111)


@register("add_ids", f"""
SELECT c_custkey, c_name, 100000000 + ({_A} * (row_number() OVER (
         ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':111'), c_custkey) - 1) + {_B}) % {9 * 10 ** 8}
       AS census_id
FROM customer""")
def q_add_ids(spark, sf):
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    return C.add_ids(cu, "c_custkey", seed=111)


_X_COLS = ["row_id", "amount", "balance", "capital-gain", "constant_col", "mostly_missing",
           "edge_missing", "num_text", "money_text", "race", "sex"]


@register("feature_target_split", fx.with_views(
    f"WITH cl AS ({_CLEAN_SQL}) SELECT {wide_select(cols=_X_COLS)} FROM cl", "wide_raw"))
def q_feature_target_split(spark, sf):
    X, _ = C.feature_target_split(C.clean_dataframe(fx.wide_raw(spark, sf), ["money_text"]),
                                  key="row_id", target="income")
    return X


_FRAC_SQL = "(" + " + ".join(f"CAST({dq(n)} IS NULL AS INTEGER)" for n in WIDE_COLS[1:]) + \
    f") / {float(len(WIDE_COLS) - 1)}"
_F1_WHERE = f'NOT coalesce("capital-gain" = 0 AND {_FRAC_SQL} > 0.5, false)'


@register("filter_sparse_rows", fx.with_views(
    f"SELECT {wide_select()} FROM wide_raw WHERE {_F1_WHERE}", "wide_raw"))
def q_filter_sparse_rows(spark, sf):
    return C.filter_sparse_rows(fx.wide_raw(spark, sf), key="row_id")


@register("row_missing_fraction", fx.with_views(
    f"SELECT {wide_select()}, {r6(_FRAC_SQL)} AS percentage_missing FROM wide_raw WHERE {_F1_WHERE}",
    "wide_raw"))
def q_row_missing_fraction(spark, sf):
    w = C.filter_sparse_rows(fx.wide_raw(spark, sf), key="row_id")
    return rounded(C.row_missing_fraction(w, key="row_id"))


# ============================================================ 2.4 joins

_DOC_COLS = "d.doc_id, d.lang, d.source, d.n_chars"


@register("join_features_target", f"""
SELECT {_DOC_COLS}, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_join_features_target(spark, sf):
    X = read_table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return J.join_features_target(X, read_table(spark, sf, "labels"), "doc_id")


@register("align_xy", """
WITH xk AS (SELECT doc_id AS k, count(*) AS nx FROM documents GROUP BY doc_id),
     yk AS (SELECT doc_id AS k, count(*) AS ny FROM labels GROUP BY doc_id),
     j AS (SELECT xk.nx, yk.ny FROM xk FULL OUTER JOIN yk ON xk.k = yk.k)
SELECT 'x_without_label' AS "check", CAST(count_if(ny IS NULL) AS BIGINT) AS n FROM j
UNION ALL SELECT 'label_without_x', CAST(count_if(nx IS NULL) AS BIGINT) FROM j
UNION ALL SELECT 'duplicate_keys_x', CAST(count_if(nx > 1) AS BIGINT) FROM j
UNION ALL SELECT 'duplicate_keys_y', CAST(count_if(ny > 1) AS BIGINT) FROM j""")
def q_align_xy(spark, sf):
    X = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    _, audit = J.align_xy(X, read_table(spark, sf, "labels"), "doc_id")
    return audit


# ============================================================ 2.5 profiles

def _zero_var_sql(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{n}' AS value, {i} AS ord FROM {src} HAVING min({dq(n)}) = max({dq(n)}) "
             f"AND count({dq(n)}) >= 2" for i, n in enumerate(cols)]
    return " UNION ALL ".join(parts)


@register("zero_variance_columns", fx.with_views(f"""
SELECT 'zero_variance' AS state_name, CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS pos, value
FROM ({_zero_var_sql('wide_raw', WIDE_NUM)}) z""", "wide_raw"))
def q_zero_variance_columns(spark, sf):
    return _state_df(spark, "zero_variance", A.zero_variance_columns(fx.wide_raw(spark, sf),
                                                                     key="row_id"))


def _missing_pct_sql(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", {i} AS pos, {r6(f'100.0 * count_if({dq(n)} IS NULL) / count(*)')} AS pct "
        f"FROM {src}" for i, n in enumerate(cols))


@register("column_missing_percent", fx.with_views(
    _missing_pct_sql("docs_labelled", ["lang", "source", "n_chars", "quality", "toxic"]),
    "docs_labelled"))
def q_column_missing_percent(spark, sf):
    return rounded(A.column_missing_percent(fx.docs_labelled(spark, sf), key="doc_id"))


@register("keep_columns_below", fx.with_views(
    f"SELECT \"column\", pos FROM ({_missing_pct_sql('wide_raw', WIDE_COLS[1:-1])}) t "
    "WHERE pct <= 60.0", "wide_raw"))
def q_keep_columns_below(spark, sf):
    return A.keep_columns_below(fx.wide_raw(spark, sf), 60.0, key="row_id", exclude=["income"])


@register("top_n", """
SELECT p_type AS value, count(*) AS count FROM part WHERE p_type IS NOT NULL
GROUP BY p_type ORDER BY count(*) DESC, p_type ASC LIMIT 10""")
def q_top_n(spark, sf):
    return A.top_n(read_table(spark, sf, "part"), "p_type", 10)


@register("class_balance", fx.with_views(f"""
SELECT y, count(*) AS count, {r6('count(*) / sum(count(*)) OVER ()')} AS share
FROM (SELECT CAST({_LABEL_SQL} AS INTEGER) AS y FROM wide_raw) t GROUP BY y""", "wide_raw"))
def q_class_balance(spark, sf):
    w = C.encode_label(fx.wide_raw(spark, sf), "income", "y")
    return rounded(A.class_balance(w, "y"))


@register("step_audit", fx.with_views(f"""
WITH f AS (SELECT {_F1_WHERE} AS k1, ({_LABEL_SQL}) IS NOT NULL AS k2 FROM wide_raw),
     c AS (SELECT count(*) AS r0, CAST(count_if(k1) AS BIGINT) AS r1,
                  CAST(count_if(k1 AND k2) AS BIGINT) AS r2 FROM f)
SELECT 'filter_sparse_rows' AS step, 1 AS pos, r0 AS rows_before, r1 AS rows_after, r0 - r1 AS removed FROM c
UNION ALL SELECT 'label_known', 2, r1, r2, r1 - r2 FROM c""", "wide_raw"))
def q_step_audit(spark, sf):
    w = fx.wide_raw(spark, sf)
    cols = [n for n in w.columns if n != "row_id"]
    keep1 = ~F.coalesce((F.col("`capital-gain`") == 0)
                        & (C.missing_fraction_expr(cols) > F.lit(0.5)), F.lit(False))
    keep2 = C.encode_label_expr(F.col("income")).isNotNull()
    return A.step_audit(w, [("filter_sparse_rows", keep1), ("label_known", keep2)])


# ============================================================ 2.13 N5 state store

@register("fitted_state_store", fx.with_views(f"""
SELECT 'zero_variance' AS state_name, CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS pos, value
FROM ({_zero_var_sql('wide_raw', WIDE_NUM)}) z
UNION ALL
SELECT 'kept_columns', CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER), "column"
FROM ({_missing_pct_sql('wide_raw', WIDE_COLS[1:-1])}) t WHERE pct <= 60.0""", "wide_raw"))
def q_fitted_state_store(spark, sf):
    w = fx.wide_raw(spark, sf)
    reg = N.Registry(spark, scratch_path(spark, "registry"))
    reg.save_state("prep", "preproc_training", "zero_variance", ["stale"])  # older write loses
    reg.save_state("prep", "preproc_training", "zero_variance",
                   A.zero_variance_columns(w, key="row_id"))
    kept = [r["column"] for r in A.keep_columns_below(w, 60.0, key="row_id", exclude=["income"])
            .orderBy("pos").collect()]
    reg.save_state("prep", "preproc_training", "kept_columns", kept)
    cur = N.latest_state(reg.state_table())
    return cur.where(F.col("pos") >= 0).select("state_name", "pos", "value")


# ============================================================ 2.10 curves (M8-M14), R1, T6

from binscope.operators import reshape as R  # noqa: E402


@register("roc_curve", fx.with_views(f"""
WITH {cum_sql('scored', _MS)},
a AS (SELECT model, split, {r6(ratio_sql('sum(CAST(neg AS DOUBLE) * (CAST(tp AS DOUBLE) - CAST(pos AS DOUBLE) / 2))', 'max(tot_p) * max(tot_n)'))} AS roc_auc
      FROM cum GROUP BY model, split),
pts AS (SELECT model, split, score AS threshold, {r6(ratio_sql('fp', 'tot_n'))} AS fpr,
               {r6(ratio_sql('tp', 'tot_p'))} AS tpr FROM cum
        UNION ALL SELECT model, split, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM a)
SELECT pts.*, a.roc_auc FROM pts JOIN a USING (model, split)""", "scored"))
def q_roc_curve(spark, sf):
    return rounded(M.roc_curve(fx.scored(spark, sf), _MS))


@register("precision_recall_curve", fx.with_views(f"""
WITH {cum_sql('scored', _MS)},
p1 AS (SELECT model, split, score AS threshold, {ratio_sql('tp', 'tp + fp')} AS precision,
              {ratio_sql('tp', 'tot_p')} AS recall,
              CASE WHEN tp - pos + fp - neg = 0 THEN 1.0
                   ELSE CAST(tp - pos AS DOUBLE) / CAST(tp - pos + fp - neg AS DOUBLE) END AS pprev,
              {ratio_sql('tp - pos', 'tot_p')} AS rprev FROM cum),
a AS (SELECT model, split, {r6('sum((recall - rprev) * (precision + pprev) / 2)')} AS pr_auc
      FROM p1 GROUP BY model, split),
pts AS (SELECT model, split, threshold, {r6('precision')} AS precision, {r6('recall')} AS recall FROM p1
        UNION ALL SELECT model, split, NULL::DOUBLE, 1.0, 0.0 FROM a)
SELECT pts.*, a.pr_auc FROM pts JOIN a USING (model, split)""", "scored"))
def q_precision_recall_curve(spark, sf):
    return rounded(M.precision_recall_curve(fx.scored(spark, sf), _MS))


def calib_bin_sql(x: str, n_bins: int = 10) -> str:
    return "(" + " + ".join(f"CAST({x} > {e!r} AS INTEGER)" for e in M.calibration_edges(n_bins)) + ")"


@register("calibration_curve", fx.with_views(f"""
WITH b AS (SELECT model, split, {r6('avg((p - y) * (p - y))')} AS brier FROM scored GROUP BY model, split),
c AS (SELECT model, split, {calib_bin_sql('p')} AS bin, count(*) AS n, {r6('avg(p)')} AS mean_predicted,
             {r6('avg(CAST(y AS DOUBLE))')} AS fraction_positive
      FROM scored GROUP BY model, split, bin)
SELECT c.*, b.brier FROM c JOIN b USING (model, split)""", "scored"))
def q_calibration_curve(spark, sf):
    return rounded(M.calibration_curve(fx.scored(spark, sf), _MS, 10))


_TM_SQL = f"""
WITH {cum_sql('scored', _MS)},
tm AS (SELECT model, split, score AS threshold, {ratio_sql('tp', 'tp + fp')} AS precision,
              {ratio_sql('tp', 'tot_p')} AS recall, {ratio_sql('tot_n - fp', 'tot_n')} AS specificity
       FROM cum)"""


@register("threshold_metrics", fx.with_views(f"""{_TM_SQL}
SELECT model, split, threshold, {r6('precision')} AS precision, {r6('recall')} AS recall,
       {r6('2 * precision * recall / (precision + recall + 1e-9)')} AS f1, {r6('specificity')} AS specificity
FROM tm""", "scored"))
def q_threshold_metrics(spark, sf):
    return rounded(M.threshold_metrics(fx.scored(spark, sf), _MS))


@register("split_metrics", fx.with_views(f"""
WITH {_metrics_long_sql(['model', 'split'])}
SELECT model, split || ' ' || metric AS metric, {r3('value')} AS value FROM ml""", "scored"))
def q_split_metrics(spark, sf):
    return M.split_metrics(fx.scored(spark, sf), ["model"], "split")


@register("union_metric_frames", fx.with_views(f"""
WITH {_metrics_long_sql(['model', 'split'])}
SELECT model, split || ' ' || metric AS metric, {r6('value')} AS value FROM ml""", "scored"))
def q_union_metric_frames(spark, sf):
    s = fx.scored(spark, sf)
    frames = {sp: M.metrics_long(s.where(F.col("split") == sp), ["model"])
              for sp in ("train", "valid", "test")}
    return rounded(R.union_metric_frames(frames))


def conf_sql(source: str, keys: list[str], threshold: float = 0.5) -> str:
    k = ", ".join(keys)
    t = repr(float(threshold))
    return f"""
SELECT {k}, CAST({t} AS DOUBLE) AS threshold,
  CAST(sum(CASE WHEN y <> 1 AND NOT p > {t} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN y <> 1 AND p > {t} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN y = 1 AND NOT p > {t} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y = 1 AND p > {t} THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM {source} GROUP BY {k}"""


def bundle_sql(source: str, keys: list[str], curves=("roc", "pr", "threshold", "calibration",
                                                      "confusion"), n_bins: int = 10) -> str:
    k = ", ".join(keys)
    parts = {
        "roc": [f"SELECT {k}, 'roc' AS curve, 'fpr' AS x_name, fpr AS x, 'tpr' AS y_name, rec AS y, "
                "t AS threshold FROM c",
                f"SELECT {k}, 'roc', 'fpr', 0.0, 'tpr', 0.0, 'infinity'::DOUBLE FROM conf"],
        "pr": [f"SELECT {k}, 'pr', 'recall', rec, 'precision', prec, t FROM c",
               f"SELECT {k}, 'pr', 'recall', 0.0, 'precision', 1.0, NULL::DOUBLE FROM conf"],
        "threshold": [f"SELECT {k}, 'threshold', 'threshold', t, '{n}', {e}, t FROM c" for n, e in (
            ("precision", "prec"), ("recall", "rec"), ("specificity", "spec"),
            ("f1", "2 * prec * rec / (prec + rec + 1e-9)"))],
        "calibration": [f"SELECT {k}, 'calibration', 'mean_predicted', mp, 'fraction_positive', fpos, "
                        "NULL::DOUBLE FROM cal"],
        "confusion": [f"SELECT {k}, 'confusion', 'cell', {float(i)}, '{n}', CAST({n} AS DOUBLE), "
                      "threshold FROM conf" for i, n in enumerate(("tn", "fp", "fn", "tp"))],
    }
    union = "\n  UNION ALL ".join(x for cv in curves for x in parts[cv])
    return f"""
WITH {cum_sql(source, keys)},
c AS (SELECT {k}, score AS t, {ratio_sql('tp', 'tp + fp')} AS prec,
             {ratio_sql('tp', 'tot_p')} AS rec, {ratio_sql('fp', 'tot_n')} AS fpr,
             {ratio_sql('tot_n - fp', 'tot_n')} AS spec FROM cum),
conf AS ({conf_sql(source, keys)}),
cal AS (SELECT {k}, avg(p) AS mp, avg(CAST(y AS DOUBLE)) AS fpos
        FROM {source} GROUP BY {k}, {calib_bin_sql('p', n_bins)}),
u AS ({union})
SELECT {k}, curve, x_name, {r6('x')} AS x, y_name, {r6('y')} AS y, {r6('threshold')} AS threshold
FROM u"""


_BUNDLE_SQL = bundle_sql("scored", _MS)


@register("evaluation_bundle", fx.with_views(_BUNDLE_SQL, "scored"))
def q_evaluation_bundle(spark, sf):
    return rounded(M.evaluation_bundle(fx.scored(spark, sf), _MS))


@register("row_outcome_flags", fx.with_views("""
SELECT id, model, split, y, p,
       CAST(y = 1 AND p > 0.5 AS INTEGER) AS "TP", CAST(y = 1 AND NOT p > 0.5 AS INTEGER) AS "FN",
       CAST(y <> 1 AND p > 0.5 AS INTEGER) AS "FP", CAST(y <> 1 AND NOT p > 0.5 AS INTEGER) AS "TN"
FROM scored""", "scored"))
def q_row_outcome_flags(spark, sf):
    s = fx.scored(spark, sf).select("id", "model", "split", "y", "p")
    return M.row_outcome_flags(s, 0.5)


def _betas_sql() -> str:
    return "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, CAST({b!r} AS DOUBLE))" for i, b in enumerate(M.beta_grid())) + ") t(bi, beta)"


@register("optimal_threshold", fx.with_views(f"""{_TM_SQL},
bt AS ({_betas_sql()}),
fb AS (SELECT tm.model, tm.split, bt.beta, tm.threshold, tm.precision,
              CASE WHEN (bt.beta * bt.beta) * tm.precision + tm.recall = 0 THEN 0.0
                   ELSE (1.0 + bt.beta * bt.beta) * tm.precision * tm.recall
                        / ((bt.beta * bt.beta) * tm.precision + tm.recall) END AS f
       FROM tm, bt),
best AS (SELECT *, row_number() OVER (PARTITION BY model, split, beta ORDER BY f DESC, threshold DESC) AS rk
         FROM fb),
ok AS (SELECT model, split, beta, threshold, precision,
              row_number() OVER (PARTITION BY model, split ORDER BY beta) AS rb
       FROM best WHERE rk = 1 AND abs(precision - 0.5) <= 0.01),
g AS (SELECT DISTINCT model, split FROM scored)
SELECT g.model, g.split, {r6('coalesce(ok.threshold, 0.5)')} AS threshold, {r6('ok.beta')} AS beta,
       {r6('ok.precision')} AS precision
FROM g LEFT JOIN ok ON g.model = ok.model AND g.split = ok.split AND ok.rb = 1""", "scored"))
def q_optimal_threshold(spark, sf):
    return rounded(M.optimal_threshold(fx.scored(spark, sf), _MS))


# ============================================================ 2.7 splits, 2.11 fairness

from binscope.operators import fairness as K  # noqa: E402
from binscope.operators import sample as G  # noqa: E402

_WY_SQL = f"SELECT row_id, CAST({_LABEL_SQL} AS INTEGER) AS y, race FROM wide_raw"
_RANK_SQL = f"""
WITH w AS ({_WY_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY y, race ORDER BY md5(CAST(row_id AS VARCHAR) || ':222'), row_id) AS r,
             count(*) OVER (PARTITION BY y, race) AS m FROM w)"""


def _wide_y(spark, sf):
    return C.encode_label(fx.wide_raw(spark, sf).select("row_id", "income", "race"),
                          "income", "y").select("row_id", "y", "race")


@register("stratified_split", fx.with_views(f"""{_RANK_SQL}
SELECT row_id, y, race, CASE WHEN r <= floor(m * 6 / 10) THEN 'train'
                             WHEN r <= floor(m * 8 / 10) THEN 'valid' ELSE 'test' END AS split
FROM r""", "wide_raw"))
def q_stratified_split(spark, sf):
    return G.stratified_split(_wide_y(spark, sf), "row_id", ["y", "race"], seed=222)


@register("kfold_assign", fx.with_views(f"""{_RANK_SQL}
SELECT row_id, y, race, CAST((r - 1) % 5 AS INTEGER) AS fold FROM r""", "wide_raw"))
def q_kfold_assign(spark, sf):
    return G.kfold_assign(_wide_y(spark, sf), "row_id", ["y", "race"], k=5, seed=222)


@register("random_undersample", fx.with_views("""
WITH r AS (SELECT vec_id, label, y,
                  row_number() OVER (PARTITION BY y ORDER BY md5(CAST(vec_id AS VARCHAR) || ':222'), vec_id) AS r
           FROM vectors),
mn AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM vectors GROUP BY y) t)
SELECT vec_id, label, y FROM r, mn WHERE r <= m""", "vectors"))
def q_random_undersample(spark, sf):
    v = fx.vectors(spark, sf).select("vec_id", "label", "y")
    return G.random_undersample(v, "vec_id", "y", seed=222)


EMB_DIM = 64  # width of embeddings.embedding


def _smote_sql(dim: int = EMB_DIM, k: int = 5, seed: int = 222) -> str:
    xs = ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS x{j}" for j in range(dim))
    var = ", ".join(f"var_samp(x{j}) AS v{j}" for j in range(dim))
    dist = " + ".join(f"(a.x{j} - b.x{j}) * (a.x{j} - b.x{j}) / st.v{j}" for j in range(dim))
    orig = ", ".join(r6(f"x{j}") for j in range(dim))
    syn = ", ".join(r6(f"s.x{j} + s.lam * (coalesce(n.x{j}, s.x{j}) - s.x{j})") for j in range(dim))
    return f"""
WITH v AS (SELECT vec_id, y, {xs} FROM vectors),
st AS (SELECT {var} FROM v),
cnt AS (SELECT y, count(*) AS n FROM v GROUP BY y),
mx AS (SELECT max(n) AS big FROM cnt),
mino AS (SELECT v.* FROM v JOIN cnt ON v.y = cnt.y, mx WHERE cnt.n < mx.big),
pairs AS (SELECT a.y, a.vec_id AS k, b.vec_id AS nk, {dist} AS d
          FROM mino a JOIN mino b ON a.y = b.y AND a.vec_id <> b.vec_id, st),
nn AS (SELECT y, k, nk, row_number() OVER (PARTITION BY y, k ORDER BY d, nk) AS j FROM pairs),
nl AS (SELECT y, k, count(*) AS len FROM nn WHERE j <= {k} GROUP BY y, k),
base AS (SELECT mino.*, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(vec_id AS VARCHAR) || ':{seed}'), vec_id) - 1 AS b,
                count(*) OVER (PARTITION BY y) AS m FROM mino),
offs AS (SELECT y, big - n AS g, coalesce(sum(big - n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING
                                                                 AND 1 PRECEDING), 0) AS off
         FROM cnt, mx WHERE n < big),
draws AS (SELECT y, i, off + i AS gid FROM (SELECT y, off, unnest(range(g)) AS i FROM offs)),
hd AS (SELECT y, i, gid, md5(CAST(y AS VARCHAR) || ':' || CAST(i AS VARCHAR) || ':{seed}') AS h FROM draws),
s AS (SELECT hd.y, hd.i, hd.gid, base.vec_id AS base_key, base.* EXCLUDE (vec_id, y, b, m),
             ('0x' || substr(hd.h, 9, 8))::BIGINT / 4294967296.0 AS lam,
             CASE WHEN coalesce(nl.len, 0) > 0 THEN 1 + ('0x' || substr(hd.h, 1, 8))::BIGINT % nl.len END AS jj
      FROM hd JOIN base ON hd.y = base.y AND base.b = hd.i % base.m
      LEFT JOIN nl ON nl.y = base.y AND nl.k = base.vec_id)
SELECT vec_id, y, [{orig}] AS embedding, 0 AS synthetic, CAST(-1 AS BIGINT) AS synth_no,
       vec_id AS base_key, vec_id AS nn_key FROM v
UNION ALL
SELECT CAST(-(s.gid + 1) AS BIGINT), s.y, [{syn}], 1, s.i, s.base_key, coalesce(nn.nk, s.base_key)
FROM s LEFT JOIN nn ON nn.y = s.y AND nn.k = s.base_key AND nn.j = s.jj
LEFT JOIN v n ON n.vec_id = nn.nk"""


@register("smote_oversample", fx.with_views(_smote_sql(), "vectors"))
def q_smote_oversample(spark, sf):
    """G3 on the embedding vectors: class y=1 grows to the size of y=0."""
    v = fx.vectors(spark, sf)
    names = [f"e{j}" for j in range(EMB_DIM)]
    wide = v.select("vec_id", "y", *[F.col("embedding")[j].cast("double").alias(n)
                                     for j, n in enumerate(names)])
    out = G.smote_oversample(wide, "vec_id", "y", names, k=5, seed=222)
    r = rounded(out)
    return r.select("vec_id", "y", F.array(*names).alias("embedding"), "synthetic", "synth_no",
                    "base_key", "nn_key")


@register("balanced_class_weights", fx.with_views(f"""
WITH c AS (SELECT y, count(*) AS nc FROM vectors GROUP BY y),
t AS (SELECT sum(nc) AS n, count(*) AS k FROM c)
SELECT v.vec_id, v.label, v.y, {r6('t.n / (t.k * c.nc)')} AS weight
FROM vectors v JOIN c ON v.y = c.y, t""", "vectors"))
def q_balanced_class_weights(spark, sf):
    v = fx.vectors(spark, sf).select("vec_id", "label", "y")
    return rounded(G.balanced_class_weights(v, "y"))


_GK = ["model", "attribute", "attribute_value"]
_SLICES_SQL = """SELECT id, model, split, y, p, 'race' AS attribute, race AS attribute_value FROM scored
UNION ALL SELECT id, model, split, y, p, 'sex', sex FROM scored"""
_REF = {"race": "AUTOMOBILE", "sex": "AMERICA"}


def _slices(spark, sf):
    return K.group_slices(fx.scored(spark, sf), ["race", "sex"])


@register("group_slices", fx.with_views(_SLICES_SQL, "scored"))
def q_group_slices(spark, sf):
    return _slices(spark, sf)


def group_metrics_sql(source: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"g.{x} = b.{x}" for x in keys)
    gk = ", ".join(f"g.{x}" for x in keys)
    n = "(g.pp + g.nn)"
    tn, fn = "(g.nn - g.fpt)", "(g.pp - g.tpt)"
    vals = {
        "Accuracy": ratio_sql(f"g.tpt + {tn}", n),
        "Precision": share_sql("g.tpt", "g.tpt + g.fpt"),
        "Recall": share_sql("g.tpt", "g.pp"),
        "F1": share_sql("2 * g.tpt", f"2 * g.tpt + g.fpt + {fn}"),
        "Specificity": ratio_sql(tn, "g.nn"),
        "Prevalence": ratio_sql("g.pp", n),
        "Predicted Prevalence": ratio_sql("g.tpt + g.fpt", n),
        "ROC AUC": ratio_sql("g.auc_num", "g.pp * g.nn"),
        "Average Precision": ratio_sql("g.ap_num", "g.pp"),
        "Brier": "b.brier",
    }
    cols = ", ".join(f"CAST({v} AS DOUBLE) AS {dq(m)}" for m, v in vals.items())
    return f"""{cum_sql(source, keys)}, {summary_sql(keys)},
b AS (SELECT {k}, avg((p - y) * (p - y)) AS brier FROM {source} GROUP BY {k}),
gm AS (SELECT {gk}, {n} AS n, {cols} FROM g JOIN b ON {on})"""


def _gm_out(keys: list[str]) -> str:
    return ", ".join(keys) + ", n, " + ", ".join(f"{r6(dq(m))} AS {dq(m)}" for m in K.GROUP_METRICS)


@register("group_metrics", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {group_metrics_sql('slices', _GK)}
SELECT {_gm_out(_GK)} FROM gm""", "scored"))
def q_group_metrics(spark, sf):
    return rounded(K.group_metrics(_slices(spark, sf), _GK))


def disparities_sql(keys: list[str], ref: dict[str, str]) -> str:
    outer = [k for k in keys if k != "attribute_value"]
    cond = " OR ".join(f"(attribute = '{a}' AND attribute_value = '{v}')" for a, v in ref.items())
    on = " AND ".join(f"gm.{x} = rf.{x}" for x in outer)
    ratios = ", ".join(f"CASE WHEN rf.{dq(m)} = 0 THEN NULL ELSE gm.{dq(m)} / rf.{dq(m)} END AS "
                       f"{dq(m + '_ratio')}" for m in K.GROUP_METRICS)
    return f"""rf AS (SELECT * FROM gm WHERE {cond}),
dp AS (SELECT {', '.join('gm.' + x for x in keys)}, {ratios} FROM gm LEFT JOIN rf ON {on})"""


@register("group_disparities", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {group_metrics_sql('slices', _GK)}, {disparities_sql(_GK, _REF)}
SELECT {', '.join(_GK)}, {', '.join(f"{r6(dq(m + '_ratio'))} AS {dq(m + '_ratio')}" for m in K.GROUP_METRICS)}
FROM dp""", "scored"))
def q_group_disparities(spark, sf):
    gm = K.group_metrics(_slices(spark, sf), _GK)
    return rounded(K.group_disparities(gm, _GK, _REF))


@register("group_curves", fx.with_views(
    bundle_sql("slices", _GK, ("roc", "pr", "calibration")).replace(
        "WITH ", f"WITH slices AS ({_SLICES_SQL}), ", 1), "scored"))
def q_group_curves(spark, sf):
    return rounded(K.group_curves(_slices(spark, sf), _GK))


_SEEDS = G.bootstrap_seeds(10)
_SEEDS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {s})" for i, s in enumerate(_SEEDS)) + \
    ") t(bootstrap, seed)"


def boot_sql(source: str, keys: list[str], key: str = "id", size: int = 2000, balanced: bool = False) -> str:
    k = ", ".join(keys)
    w = ", ".join(keys[:-1])
    share = f"floor({size} / tot.g)" if balanced else f"floor({size} * c.ng / tot.n)"
    hx = " || ':' || ".join(["CAST(d.seed AS VARCHAR)"] + [f"CAST(d.{x} AS VARCHAR)" for x in keys]
                            + ["CAST(d.draw AS VARCHAR)"])
    on = " AND ".join(f"r.{x} = dr.{x}" for x in keys)
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {k}
                                 ORDER BY md5(CAST({key} AS VARCHAR) || ':boot'), {key}) AS idx
           FROM {source}),
counts AS (SELECT {k}, count(*) AS ng FROM {source} GROUP BY {k}),
tot AS (SELECT {w}, sum(ng) AS n, count(*) AS g FROM counts GROUP BY {w}),
seeds AS ({_SEEDS_SQL}),
d0 AS (SELECT c.*, s.bootstrap, s.seed, CAST({share} AS BIGINT) AS mg
       FROM counts c JOIN tot USING ({w}), seeds s),
d AS (SELECT *, unnest(generate_series(1, mg)) AS draw FROM d0 WHERE mg >= 1),
dr AS (SELECT {', '.join('d.' + x for x in keys)}, d.bootstrap, d.draw,
              1 + CAST(floor(('0x' || substr(md5({hx}), 1, 8))::BIGINT / 4294967296.0 * d.ng) AS BIGINT) AS idx
       FROM d),
boot AS (SELECT r.* EXCLUDE (idx), dr.bootstrap, dr.draw FROM ranked r JOIN dr ON {on} AND r.idx = dr.idx)"""


def _boot(spark, sf, balanced: bool = False):
    return K.bootstrap_slices(_slices(spark, sf), "id", _GK, 10, 2000, balanced)


@register("bootstrap_sample", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {boot_sql('slices', _GK)}
SELECT id, model, split, y, {r6('p')} AS p, attribute, attribute_value, bootstrap, draw FROM boot""",
                                            "scored"))
def q_bootstrap_sample(spark, sf):
    return rounded(_boot(spark, sf))


@register("bootstrap_sample_balanced", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {boot_sql('slices', _GK, balanced=True)}
SELECT id, model, split, y, {r6('p')} AS p, attribute, attribute_value, bootstrap, draw FROM boot""",
                                                     "scored"))
def q_bootstrap_sample_balanced(spark, sf):
    return rounded(_boot(spark, sf, balanced=True))


_GKB = _GK + ["bootstrap"]


@register("bootstrap_group_metrics", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {boot_sql('slices', _GK)}, {group_metrics_sql('boot', _GKB)}
SELECT {_gm_out(_GKB)} FROM gm""", "scored"))
def q_bootstrap_group_metrics(spark, sf):
    return rounded(K.bootstrap_group_metrics(_boot(spark, sf), _GK))


def _boot_disp_sql() -> str:
    union = " UNION ALL ".join(
        f"SELECT {', '.join(_GKB)}, '{m}_ratio' AS metric, {dq(m + '_ratio')} AS value FROM dp"
        for m in K.GROUP_METRICS)
    return f"""
WITH slices AS ({_SLICES_SQL}), {boot_sql('slices', _GK)}, {group_metrics_sql('boot', _GKB)},
{disparities_sql(_GKB, _REF)},
lg AS ({union})
SELECT {', '.join(_GK)}, metric, count(value) AS n, {r6('avg(value)')} AS mean,
       {r6('quantile_cont(value, 0.025)')} AS q025, {r6('quantile_cont(value, 0.5)')} AS q500,
       {r6('quantile_cont(value, 0.975)')} AS q975
FROM lg GROUP BY {', '.join(_GK)}, metric"""


@register("bootstrap_disparities", fx.with_views(_boot_disp_sql(), "scored"))
def q_bootstrap_disparities(spark, sf):
    bgm = K.bootstrap_group_metrics(_boot(spark, sf), _GK)
    return rounded(K.bootstrap_disparities(bgm, _GK, _REF))


def _boot_curves_sql(grid: int = 100, n_bins: int = 5) -> str:
    kb = ", ".join(_GKB)
    gk = ", ".join(_GK)
    on = " AND ".join(f"f.{x} = b.{x}" for x in _GKB)
    up = f"CASE WHEN fpr <= (ceil(fpr * {grid}) - 1) / {float(grid)} THEN ceil(fpr * {grid}) - 1 ELSE ceil(fpr * {grid}) END"
    dn = f"CASE WHEN (floor(rec * {grid}) + 1) / {float(grid)} <= rec THEN floor(rec * {grid}) + 1 ELSE floor(rec * {grid}) END"
    return f"""
WITH slices AS ({_SLICES_SQL}), {boot_sql('slices', _GK)}, {cum_sql('boot', _GKB)},
pts AS (SELECT {kb}, {ratio_sql('fp', 'tot_n')} AS fpr, {ratio_sql('tp', 'tot_p')} AS tpr,
               {ratio_sql('tp', 'tp + fp')} AS prec, {ratio_sql('tp', 'tot_p')} AS rec FROM cum),
curves AS (SELECT DISTINCT {kb} FROM cum),
roc AS (SELECT {kb}, CAST({up} AS BIGINT) AS gi, tpr AS y FROM pts
        UNION ALL SELECT {kb}, 0, 0.0 FROM curves),
pr AS (SELECT {kb}, CAST({dn} AS BIGINT) AS gi, prec AS y FROM pts
       UNION ALL SELECT {kb}, 0, 1.0 FROM curves),
full_grid AS (SELECT {kb}, unnest(generate_series(0, {grid})) AS gi FROM curves),
rb AS (SELECT {kb}, gi, max(y) AS y FROM roc GROUP BY ALL),
pb AS (SELECT {kb}, gi, max(y) AS y FROM pr GROUP BY ALL),
rg AS (SELECT f.*, max(b.y) OVER (PARTITION BY {', '.join('f.' + x for x in _GKB)} ORDER BY f.gi
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y, 'roc' AS curve
       FROM full_grid f LEFT JOIN rb b ON {on} AND f.gi = b.gi),
pg AS (SELECT f.*, max(b.y) OVER (PARTITION BY {', '.join('f.' + x for x in _GKB)} ORDER BY f.gi DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y, 'pr' AS curve
       FROM full_grid f LEFT JOIN pb b ON {on} AND f.gi = b.gi),
al AS (SELECT * FROM rg UNION ALL SELECT * FROM pg),
cal AS (SELECT {kb}, {calib_bin_sql('p', n_bins)} AS bin, avg(p) AS mp, avg(CAST(y AS DOUBLE)) AS fpos
        FROM boot GROUP BY ALL)
SELECT {gk}, curve, {r6(f'gi / {float(grid)}')} AS x, {r6('avg(y)')} AS y, count(y) AS n_boot
FROM al GROUP BY {gk}, curve, gi
UNION ALL
SELECT {gk}, 'calibration', {r6('avg(mp)')}, {r6('avg(fpos)')}, count(*) FROM cal GROUP BY {gk}, bin"""


@register("bootstrap_curves", fx.with_views(_boot_curves_sql(), "scored"))
def q_bootstrap_curves(spark, sf):
    return rounded(K.bootstrap_curves(_boot(spark, sf), _GK, grid=100, n_bins=5))


# ============================================================ 2.5 profiles (A7-A12), R3, R4

_CLEAN_NUMS = ["amount", "balance", "capital-gain", "constant_col", "mostly_missing",
               "edge_missing", "num_text", "money_text"]


def _clean(spark, sf):
    return C.clean_dataframe(fx.wide_raw(spark, sf), ["money_text"])


def _t1c_sql() -> str:
    parts = []
    for n in _CLEAN_NUMS:
        x = dq(n)
        parts.append(f"""SELECT '{n}' AS variable, count({x}) AS n,
  CAST(count_if({x} IS NULL) AS BIGINT) AS missing,
  {r6(f'100.0 * count_if({x} IS NULL) / count(*)')} AS missing_pct, {r6(f'avg({x})')} AS mean,
  {r6(f'stddev_samp({x})')} AS sd, {r6(f'quantile_cont({x}, 0.5)')} AS median,
  {r6(f'min({x})')} AS min, {r6(f'max({x})')} AS max,
  {r6(f'(SELECT {x} FROM cl WHERE {x} IS NOT NULL GROUP BY {x} ORDER BY count(*) DESC, {x} ASC LIMIT 1)')} AS mode
FROM cl""")
    return f"WITH cl AS ({_CLEAN_SQL})\n" + "\nUNION ALL\n".join(parts)


@register("table1_continuous", fx.with_views(_t1c_sql(), "wide_raw"))
def q_table1_continuous(spark, sf):
    return rounded(A.table1_continuous(_clean(spark, sf), _CLEAN_NUMS))


def _t1cat_sql(k: int = 3) -> str:
    parts, bases = [], []
    for n in _CLEAN_STR:
        x = dq(n)
        parts.append(f"SELECT '{n}' AS variable, {x} AS value, count(*) AS count FROM cl "
                     f"WHERE {x} IS NOT NULL GROUP BY {x}")
        bases.append(f"SELECT '{n}' AS variable, count({x}) AS n, count(*) AS rows_ FROM cl")
    return f"""WITH cl AS ({_CLEAN_SQL}),
vc AS ({' UNION ALL '.join(parts)}),
base AS ({' UNION ALL '.join(bases)}),
md AS (SELECT variable, arg_min(value, (-count, value)) AS mode FROM vc GROUP BY variable),
top AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY count DESC, value ASC) AS rk FROM vc)
SELECT t.variable, t.value, b.n, b.rows_ - b.n AS missing, {r6('100.0 * (b.rows_ - b.n) / b.rows_')} AS missing_pct,
       md.mode, t.count, {r6('t.count / b.rows_')} AS proportion
FROM top t JOIN base b USING (variable) JOIN md USING (variable) WHERE t.rk <= {k}"""


@register("table1_categorical", fx.with_views(_t1cat_sql(), "wide_raw"))
def q_table1_categorical(spark, sf):
    return rounded(A.table1_categorical(_clean(spark, sf), _CLEAN_STR, value_counts=True,
                                        max_categories=3))


_CLEAN_ALL = ["amount", "balance", "capital-gain", "constant_col", "mostly_missing", "edge_missing",
              "num_text", "dirty_text", "money_text", "marital-status", "race", "sex", "income"]


def _types_sql() -> str:
    parts = []
    for i, n in enumerate(_CLEAN_ALL):
        x = dq(n)
        if n in _CLEAN_NUMS:
            kind = (f"CASE WHEN coalesce(bool_and({x} = (SELECT min({x}) FROM cl) OR "
                    f"{x} = (SELECT max({x}) FROM cl)), true) THEN 'categorical' ELSE 'continuous' END")
            parts.append(f"SELECT '{n}' AS variable, {i} AS pos, {kind} AS kind FROM cl")
        else:
            parts.append(f"SELECT '{n}' AS variable, {i} AS pos, 'categorical' AS kind")
    return f"WITH cl AS ({_CLEAN_SQL})\n" + "\nUNION ALL\n".join(parts)


@register("detect_variable_types", fx.with_views(_types_sql(), "wide_raw"))
def q_detect_variable_types(spark, sf):
    return A.detect_variable_types(_clean(spark, sf), key="row_id")


@register("histogram_density", fx.with_views(f"""
WITH st AS (SELECT min(amount) AS mn, max(amount) AS mx, count(amount) AS n FROM wide_raw),
b AS (SELECT CAST(least(floor((amount - mn) / ((mx - mn) / 10.0)), 9) AS INTEGER) AS bin, mn, mx, n
      FROM wide_raw, st WHERE amount IS NOT NULL),
g AS (SELECT bin, count(*) AS count, min(mn) AS mn, min(mx) AS mx, min(n) AS n FROM b GROUP BY bin)
SELECT 'amount' AS variable, bin, {r6('mn + bin * ((mx - mn) / 10.0)')} AS lo,
       {r6('mn + (bin + 1) * ((mx - mn) / 10.0)')} AS hi, count,
       {r6('count / (n * ((mx - mn) / 10.0))', )} AS density
FROM g""", "wide_raw"))
def q_histogram_density(spark, sf):
    return rounded(A.histogram_density(fx.wide_raw(spark, sf), "amount", 10))


def r12(expr: str) -> str:
    return f"round_even(CAST({expr} AS DOUBLE) * 1000000000000.0, 0) / 1000000000000.0"


@register("kde_curve", fx.with_views(f"""
WITH st AS (SELECT min(balance) AS mn, max(balance) AS mx, count(balance) AS n,
                   stddev_samp(balance) AS sd FROM wide_raw),
p AS (SELECT mn, mx, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
g AS (SELECT i, (mn - 3 * h) + i * (((mx + 3 * h) - (mn - 3 * h)) / 99.0) AS x, n, h
      FROM p, range(0, 100) r(i)),
v AS (SELECT balance AS x, count(*) AS w FROM wide_raw WHERE balance IS NOT NULL GROUP BY balance)
SELECT 'balance' AS variable, CAST(g.i AS INTEGER) AS point, {r6('g.x')} AS x,
       {r12('sum(v.w * exp(-((g.x - v.x) / g.h) * ((g.x - v.x) / g.h) / 2)) / (min(g.n) * min(g.h) * sqrt(2 * pi()))')} AS density
FROM g, v GROUP BY g.i, g.x""", "wide_raw"))
def q_kde_curve(spark, sf):
    d = A.kde_curve(fx.wide_raw(spark, sf), "balance", 100)
    return d.select("variable", F.col("point").cast("int").alias("point"),
                    np_round(F.col("x"), 6).alias("x"), np_round(F.col("density"), 12).alias("density"))


@register("compare_tables", fx.with_views(" UNION ALL ".join(
    f"SELECT row_id, '{n}' AS \"column\", CAST(l AS VARCHAR) AS \"left\", CAST(r AS VARCHAR) AS \"right\" "
    f"FROM (SELECT row_id, {dq(n)} AS l, {token_sql(dq(n)) if n in WIDE_STR else dq(n)} AS r FROM wide_raw) t "
    "WHERE l IS DISTINCT FROM r" for n in WIDE_COLS[1:]), "wide_raw"))
def q_compare_tables(spark, sf):
    w = fx.wide_raw(spark, sf)
    verdict, cells = A.compare_tables(w, C.nullify_tokens(w), key="row_id")
    return cells


@register("unpivot_disparities", fx.with_views(f"""
WITH slices AS ({_SLICES_SQL}), {group_metrics_sql('slices', _GK)}, {disparities_sql(_GK, _REF)}
""" + " UNION ALL ".join(
    f"SELECT {', '.join(_GK)}, '{m}_ratio' AS metric, {r6(dq(m + '_ratio'))} AS value FROM dp"
    for m in K.GROUP_METRICS), "scored"))
def q_unpivot_disparities(spark, sf):
    gm = K.group_metrics(_slices(spark, sf), _GK)
    d = K.group_disparities(gm, _GK, _REF)
    return rounded(R.unpivot_disparities(d, _GK))


_TOPK_COLS = ["amount", "balance", "capital-gain", "mostly_missing", "edge_missing"]


@register("top_k_per_row", fx.with_views(f"""
WITH u AS (""" + " UNION ALL ".join(
    f"SELECT row_id, {i} AS pos, '{n}' AS name, {dq(n)} AS v FROM wide_raw WHERE {dq(n)} IS NOT NULL"
    for i, n in enumerate(_TOPK_COLS)) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY v DESC, pos ASC) AS rk FROM u),
ids AS (SELECT row_id FROM wide_raw)
SELECT ids.row_id, r1.name AS top1_name, r1.v AS top1_value, r2.name AS top2_name, r2.v AS top2_value
FROM ids LEFT JOIN r r1 ON ids.row_id = r1.row_id AND r1.rk = 1
         LEFT JOIN r r2 ON ids.row_id = r2.row_id AND r2.rk = 2""", "wide_raw"))
def q_top_k_per_row(spark, sf):
    t = R.top_k_per_row(fx.wide_raw(spark, sf), _TOPK_COLS, k=2, out="top")
    e1, e2 = F.try_element_at("top", F.lit(1)), F.try_element_at("top", F.lit(2))
    return t.select("row_id", e1["name"].alias("top1_name"), e1["value"].alias("top1_value"),
                    e2["name"].alias("top2_name"), e2["value"].alias("top2_value"))


# ============================================================ 2.8 features

from binscope.operators import explain as E  # noqa: E402
from binscope.operators import features as X  # noqa: E402

_FEAT_NUM = ["amount", "balance", "capital-gain", "num_text", "money_text"]
_FEAT_CAT = ["race", "sex"]
_TRAIN_WHERE = f"{_SPLIT_U} < 0.6"


def _feat_frame(spark, sf):
    cl = _clean(spark, sf).select("row_id", *_FEAT_NUM, *_FEAT_CAT)
    u = md5_uniform(F.col("row_id"), "split")
    return cl, cl.where(u < 0.6)


def _scale_cols_sql(stats: str = "st") -> str:
    return ", ".join(
        f"{r6(f'coalesce(({dq(n)} - {stats}.m{i}) / (CASE WHEN coalesce({stats}.s{i}, 0) = 0 THEN 1.0 ELSE {stats}.s{i} END), 0.0)')} AS {dq(n)}"
        for i, n in enumerate(_FEAT_NUM))


def _scale_stats_sql() -> str:
    return ", ".join(f"{r6(f'avg({dq(n)})')} AS m{i}, {r6(f'stddev_pop({dq(n)})')} AS s{i}"
                     for i, n in enumerate(_FEAT_NUM))


@register("scale_then_impute", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL}), st AS (SELECT {_scale_stats_sql()} FROM cl WHERE {_TRAIN_WHERE})
SELECT row_id, {_scale_cols_sql()} FROM cl, st""", "wide_raw"))
def q_scale_then_impute(spark, sf):
    cl, train = _feat_frame(spark, sf)
    st = X.scale_fit(train, _FEAT_NUM)
    return rounded(X.scale_then_impute(cl.select("row_id", *[C.c(n) for n in _FEAT_NUM]), st))


@register("impute_mean", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL}), st AS (SELECT {', '.join(f"{r6(f'avg({dq(n)})')} AS m{i}" for i, n in enumerate(_FEAT_NUM))}
                                  FROM cl WHERE {_TRAIN_WHERE})
SELECT row_id, {', '.join(f"{r6(f'coalesce({dq(n)}, st.m{i})')} AS {dq(n)}" for i, n in enumerate(_FEAT_NUM))}
FROM cl, st""", "wide_raw"))
def q_impute_mean(spark, sf):
    cl, train = _feat_frame(spark, sf)
    mm = X.mean_fit(train, _FEAT_NUM)
    return rounded(X.impute_mean(cl.select("row_id", *[C.c(n) for n in _FEAT_NUM]), mm))


@register("impute_constant", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL})
SELECT row_id, coalesce(race, 'missing') AS race, coalesce(sex, 'missing') AS sex FROM cl""",
                                           "wide_raw"))
def q_impute_constant(spark, sf):
    cl, _ = _feat_frame(spark, sf)
    return X.impute_constant(cl.select("row_id", *_FEAT_CAT), _FEAT_CAT)


_RACES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SEXES = ["F", "O", "P"]


def _onehot_sql(src: str, cats: dict[str, list[str]]) -> str:
    return ", ".join(f"CAST(coalesce({dq(n)} = '{v}', false) AS INTEGER) AS {dq(X.onehot_name(n, v))}"
                     for n, vs in cats.items() for v in vs)


@register("onehot_ignore_unknown", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL})
SELECT row_id, {_onehot_sql('cl', {'race': _RACES, 'sex': _SEXES})} FROM cl""", "wide_raw"))
def q_onehot_ignore_unknown(spark, sf):
    cl, train = _feat_frame(spark, sf)
    cats = X.onehot_fit(train, _FEAT_CAT)
    return X.onehot_apply(cl.select("row_id", *_FEAT_CAT), cats)


@register("preprocessing_plan", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL}), st AS (SELECT {_scale_stats_sql()} FROM cl WHERE {_TRAIN_WHERE}),
im AS (SELECT row_id, {_scale_cols_sql()}, coalesce(race, 'missing') AS race,
              coalesce(sex, 'missing') AS sex FROM cl, st)
SELECT row_id, {', '.join(dq(n) for n in _FEAT_NUM)},
       {_onehot_sql('im', {'race': _RACES + ['missing'], 'sex': _SEXES + ['missing']})} FROM im""",
                                              "wide_raw"))
def q_preprocessing_plan(spark, sf):
    cl, train = _feat_frame(spark, sf)
    plan = X.preprocessing_plan("lr", rfe=False, smote=False)
    (out,), _names = X.apply_plan(train, [cl], plan, _FEAT_NUM, _FEAT_CAT)
    return rounded(out)


# ============================================================ 2.12 explanations, T7

_COEFS = dict(fx.COEFS)
_INTERCEPT = -0.25
_EXPL_FEATS = list(_COEFS)


def _means_sql() -> str:
    return ", ".join(f"{r6(f'avg({dq(f)})')} AS m{i}" for i, f in enumerate(_EXPL_FEATS))


def _contrib_sql(i: int, f: str) -> str:
    return f"CAST({_COEFS[f]!r} AS DOUBLE) * coalesce({dq(f)} - ms.m{i}, 0.0)"


def _expl_frame(spark, sf):
    cl = _clean(spark, sf)
    means = X.mean_fit(cl, _EXPL_FEATS)
    return cl, means


@register("linear_contributions", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL}), ms AS (SELECT {_means_sql()} FROM cl)
SELECT row_id, {', '.join(f"{r6(_contrib_sql(i, f))} AS {dq('contrib_' + f)}" for i, f in enumerate(_EXPL_FEATS))}
FROM cl, ms""", "wide_raw"))
def q_linear_contributions(spark, sf):
    cl, means = _expl_frame(spark, sf)
    d = E.linear_contributions(cl.select("row_id", *_EXPL_FEATS), _COEFS, means)
    return rounded(d.select("row_id", *[f"contrib_{f}" for f in _EXPL_FEATS]))


def _ranked_sql() -> str:
    u = " UNION ALL ".join(
        f"SELECT row_id, {i} AS pos, '{f}' AS name, "
        f"round_even(abs({_contrib_sql(i, f)}) * 100.0, 0) / 100.0 AS v FROM cl, ms"
        for i, f in enumerate(_EXPL_FEATS))
    return f"""cl AS ({_CLEAN_SQL}), ms AS (SELECT {_means_sql()} FROM cl),
u AS ({u}),
rk AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY v DESC, pos ASC) AS r FROM u)"""


_TOPK = 5


@register("top_contributions_json", fx.with_views(f"""
WITH {_ranked_sql()}
SELECT row_id, '{{' || string_agg('"' || name || '":' || CAST(v AS VARCHAR), ',' ORDER BY r) || '}}'
       AS "Top 5 Features"
FROM rk WHERE r <= {_TOPK} GROUP BY row_id""", "wide_raw"))
def q_top_contributions_json(spark, sf):
    cl, means = _expl_frame(spark, sf)
    d = E.linear_contributions(cl.select("row_id", *_EXPL_FEATS), _COEFS, means)
    return E.top_contributions_json(d, _EXPL_FEATS, _TOPK).select("row_id", "Top 5 Features")


@register("top_contribution_names", fx.with_views(f"""
WITH {_ranked_sql()}
SELECT row_id, string_agg(name, ', ' ORDER BY r) AS "Top 5 Features"
FROM rk WHERE r <= {_TOPK} GROUP BY row_id""", "wide_raw"))
def q_top_contribution_names(spark, sf):
    cl, means = _expl_frame(spark, sf)
    d = E.linear_contributions(cl.select("row_id", *_EXPL_FEATS), _COEFS, means)
    return E.top_contribution_names(d, _EXPL_FEATS, _TOPK).select("row_id", "Top 5 Features")


def _proba_sql() -> str:
    z = f"CAST({_INTERCEPT!r} AS DOUBLE) + " + " + ".join(_contrib_sql(i, f) for i, f in enumerate(_EXPL_FEATS))
    return f"1.0 / (1.0 + exp(-({z})))"


@register("score_rows", fx.with_views(f"""
WITH cl AS ({_CLEAN_SQL}), ms AS (SELECT {_means_sql()} FROM cl),
s AS (SELECT row_id, {_proba_sql()} AS pp FROM cl, ms)
SELECT row_id, {r6('pp')} AS predicted_probas, CAST(pp > 0.5 AS INTEGER) AS predictions FROM s""",
                                      "wide_raw"))
def q_score_rows(spark, sf):
    cl, means = _expl_frame(spark, sf)
    d = E.score_linear(cl.select("row_id", *_EXPL_FEATS), _COEFS, means, _INTERCEPT, None)
    return rounded(d.select("row_id", "predicted_probas", "predictions"))


@register("explanation_table", fx.with_views(f"""
WITH {_ranked_sql()},
j AS (SELECT row_id, '{{' || string_agg('"' || name || '":' || CAST(v AS VARCHAR), ',' ORDER BY r) || '}}' AS js
      FROM rk WHERE r <= {_TOPK} GROUP BY row_id),
s AS (SELECT row_id, {_proba_sql()} AS pp, CAST({_LABEL_SQL} AS INTEGER) AS y, {_SPLIT_SQL} AS split FROM cl, ms)
SELECT s.row_id, j.js AS "Top 5 Features",
       CAST(y = 1 AND pp > 0.5 AS INTEGER) AS "TP", CAST(y = 1 AND NOT pp > 0.5 AS INTEGER) AS "FN",
       CAST(y <> 1 AND pp > 0.5 AS INTEGER) AS "FP", CAST(y <> 1 AND NOT pp > 0.5 AS INTEGER) AS "TN",
       y AS y_true, CAST(pp > 0.5 AS INTEGER) AS y_pred, {r6('pp')} AS y_pred_proba, 'income' AS "Outcome"
FROM s JOIN j USING (row_id) WHERE split = 'valid'""", "wide_raw"))
def q_explanation_table(spark, sf):
    cl, means = _expl_frame(spark, sf)
    u = md5_uniform(F.col("row_id"), "split")
    d = (C.encode_label(cl, "income", "y")
         .withColumn("split", F.when(u < 0.6, "train").when(u < 0.8, "valid").otherwise("test")))
    return rounded(E.explanation_table(d, "row_id", _EXPL_FEATS, _COEFS, means, _INTERCEPT, 0.5,
                                       label="y", hold_out="valid"))


# ============================================================ 2.13 registry

def _registry_with_runs(spark, sf):
    r = fx.runs(spark, sf)
    reg = N.Registry(spark, scratch_path(spark, "registry"))
    reg._append("runs", r.select("experiment", "run_id", "run_name", "start_time"))
    reg._append("params", N.param_rows(
        r.withColumn("model", F.split("run_name", "_").getItem(0)), "run_id",
        ["model", "n_customers"]))
    reg._append("metrics", N.metric_rows(r, "run_id", ["average_precision", "roc_auc"]))
    return reg


@register("registry_runs", fx.with_views("""
SELECT experiment, run_name, arg_max(run_id, (start_time, run_id)) AS run_id, max(start_time) AS start_time
FROM runs GROUP BY experiment, run_name""", "runs"))
def q_registry_runs(spark, sf):
    return N.latest_runs(_registry_with_runs(spark, sf).runs())


@register("registry_log_params", fx.with_views("""
SELECT run_id, 'model' AS key, split_part(run_name, '_', 1) AS value FROM runs
UNION ALL SELECT run_id, 'n_customers', CAST(n_customers AS VARCHAR) FROM runs""", "runs"))
def q_registry_log_params(spark, sf):
    return _registry_with_runs(spark, sf).params()


@register("registry_log_metrics", fx.with_views(f"""
SELECT run_id, 'average_precision' AS key, {r6('average_precision')} AS value, CAST(0 AS BIGINT) AS step
FROM runs WHERE average_precision IS NOT NULL
UNION ALL SELECT run_id, 'roc_auc', {r6('roc_auc')}, CAST(0 AS BIGINT) FROM runs""", "runs"))
def q_registry_log_metrics(spark, sf):
    return rounded(_registry_with_runs(spark, sf).metrics())


@register("find_best_model", fx.with_views(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY experiment
                     ORDER BY average_precision DESC NULLS LAST, start_time DESC, run_id ASC) AS rk FROM runs)
SELECT experiment, run_id, run_name, {r6('average_precision')} AS metric_value,
       split_part(run_name, '_', 1) AS estimator
FROM r WHERE rk = 1""", "runs"))
def q_find_best_model(spark, sf):
    reg = _registry_with_runs(spark, sf)
    return rounded(N.best_runs(reg.runs(), reg.metrics(), "average_precision", "max"))


# ============================================================ 2.8 X5, X8; 2.9 models (rows-only)

from pyspark.ml.classification import LogisticRegressionModel  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from binscope.operators import models as T  # noqa: E402
from binscope.plans import evaluation as EV  # noqa: E402
from binscope.plans import training as TR  # noqa: E402
from binscope.session import cut_lineage  # noqa: E402


def _train_frame(spark, sf, model_type: str = "lr"):
    cl = C.encode_label(_clean(spark, sf), "income", "y")
    tf, names = TR.training_frame(cl, "row_id", "y", _FEAT_NUM, _FEAT_CAT, model_type)
    return cut_lineage(tf, "train_frame", T.ROWS_PER_TASK), names


def _train(tf):
    return tf.where(F.col("split") == "train")


@register("assemble_features")
def q_assemble_features(spark, sf):
    tf, _ = _train_frame(spark, sf)
    return tf.select("row_id", "y", "split", "weight",
                     vector_to_array("features").alias("features"))


@register("fit_logistic")
def q_fit_logistic(spark, sf):
    tf, _ = _train_frame(spark, sf)
    model = T.fit_logistic(_train(tf), weight="weight", C=1.0)
    return T.score_model(model, tf, keep=["row_id"])


@register("fit_random_forest")
def q_fit_random_forest(spark, sf):
    tf, _ = _train_frame(spark, sf, "rf")
    model = T.fit_random_forest(_train(tf), weight="weight", n_estimators=100, max_depth=5)
    return T.score_model(model, tf, keep=["row_id"])


@register("fit_gradient_boosted")
def q_fit_gradient_boosted(spark, sf):
    tf, _ = _train_frame(spark, sf, "xgb")
    fit_rows = tf.where(F.col("split") != "test").withColumn(
        "is_valid", F.col("split") == "valid")
    model = T.fit_gradient_boosted(fit_rows, weight="weight", validation="is_valid",
                                   learning_rate=0.1, n_estimators=10_000, max_depth=3, patience=3)
    return T.score_model(model, tf, keep=["row_id"]).withColumn("rounds", F.lit(model.getNumTrees))


@register("random_grid_search")
def q_random_grid_search(spark, sf):
    tf, _ = _train_frame(spark, sf)
    valid = tf.where(F.col("split") == "valid")
    _, _, tried = T.random_grid_search(
        _train(tf), valid, lambda d, **p: T.fit_logistic(d, weight="weight", **p),
        T.LR_GRID, n_iter=2, seed=222)
    return tried


@register("train_and_evaluate")
def q_train_and_evaluate(spark, sf):
    tf, names = _train_frame(spark, sf)
    reg = N.Registry(spark, scratch_path(spark, "registry"))
    return EV.train_and_evaluate(tf, names, reg, "income", "lr_rfe_training",
                                 lambda d, **p: T.fit_logistic(d, weight="weight", **p), T.LR_GRID, n_iter=3, rfe=True)


@register("calibrate_scores")
def q_calibrate_scores(spark, sf):
    tf, _ = _train_frame(spark, sf)
    model = T.fit_logistic(_train(tf), weight="weight", C=1.0)
    scored_rows = T.score_model(model, tf, keep=["row_id", "y", "split"])
    cal = T.calibrate_scores(scored_rows.where(F.col("split") == "valid"), "sigmoid")
    return cal(scored_rows).select("row_id", "predicted_probas", "calibrated")


# The isotonic fit by its max-min formula: the largest, over starts a <= i, of the least mean of a..b with b >= i.
@register("calibrate_isotonic", fx.with_views(f"""
WITH c AS (SELECT model, p, count(*) AS w, sum(y) AS y FROM scored WHERE split = 'valid' GROUP BY model, p),
n AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p) AS i,
             sum(w) OVER (PARTITION BY model ORDER BY p) AS cw, sum(y) OVER (PARTITION BY model ORDER BY p) AS cy FROM c),
m AS (SELECT a.model, a.i AS a, b.i AS b, (b.cy - a.cy + a.y) / CAST(b.cw - a.cw + a.w AS DOUBLE) AS mean
      FROM n a JOIN n b ON a.model = b.model AND b.i >= a.i),
least_mean AS (SELECT model, b, min(mean) OVER (PARTITION BY model, a ORDER BY b DESC) AS v FROM m),
fit AS (SELECT model, b AS i, max(v) AS v FROM least_mean GROUP BY model, b)
SELECT model, {r6('p')} AS p, {r6('v')} AS calibrated FROM n JOIN fit USING (model, i)""", "scored"))
def q_calibrate_isotonic(spark, sf):
    scored_rows = fx.scored(spark, sf).where("split = 'valid'")
    out = None
    for name in ("a", "b"):
        own = scored_rows.where(F.col("model") == name)
        cal = T.calibrate_scores(own, "isotonic", score="p")
        part = cal(own.select("model", "p").distinct()).select("model", "p", "calibrated")
        out = part if out is None else out.union(part)
    return rounded(out)


@register("rfe_select")
def q_rfe_select(spark, sf):
    tf, names = _train_frame(spark, sf)
    wide = _train(tf).select("y", "weight", vector_to_array("features").alias("_v"))
    wide = wide.select("y", "weight", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])
    kept = X.rfe_select(wide, names, "y", n_features=0.5, step=0.1, weight="weight")
    return _state_df(spark, "rfe_selected", kept)


@register("model_store")
def q_model_store(spark, sf):
    tf, _ = _train_frame(spark, sf)
    model = T.fit_logistic(_train(tf), weight="weight", C=1.0)
    reg = N.Registry(spark, scratch_path(spark, "registry"))
    run_id = reg.get_or_create_run("models", "lr_orig_training")
    reg.save_model(run_id, model)
    loaded = reg.load_model(run_id, LogisticRegressionModel)
    return T.score_model(loaded, tf, keep=["row_id"])


# ============================================================ J3, X7

@register("join_scores_groups", fx.with_views("""
SELECT s.id, s.model, s.split, s.y, s.p, c_mktsegment AS race, r_name AS sex
FROM scored s JOIN orders ON s.id = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""", "scored"))
def q_join_scores_groups(spark, sf):
    scores = fx.scored(spark, sf).select("id", "model", "split", "y", "p")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    re_ = read_table(spark, sf, "region").select("r_regionkey", "r_name")
    groups = (o.join(cu, o.o_custkey == cu.c_custkey).join(na, cu.c_nationkey == na.n_nationkey)
              .join(re_, na.n_regionkey == re_.r_regionkey)
              .select(F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("race"),
                      F.col("r_name").alias("sex")))
    return J.join_scores_groups(scores, groups, "id", ["race", "sex"])


_GRID_KEYS = ([("lr", k) for k in T.LR_GRID] + [("rf", k) for k in T.RF_GRID]
              + [("xgb", k) for k in ("learning_rate", "n_estimators", "max_depth", "subsample",
                                      "feature_selection_RFE__n_features_to_select")]
              + [("cat", k) for k in ("learning_rate", "depth", "l2_leaf_reg",
                                      "feature_selection_RFE__n_features_to_select")])


@register("prune_param_grid", fx.with_views("""
WITH g AS (SELECT * FROM (VALUES """ + ", ".join(f"('{m}', '{k}')" for m, k in _GRID_KEYS) + """) t(model, key)),
r AS (SELECT run_id, split_part(run_name, '_', 1) AS model, contains(run_name, '_rfe') AS rfe FROM runs)
SELECT r.run_id, r.model, g.key FROM r JOIN g USING (model)
WHERE r.rfe OR NOT contains(g.key, 'feature_selection')""", "runs"))
def q_prune_param_grid(spark, sf):
    grid = spark.createDataFrame(_GRID_KEYS, "model string, key string")
    return X.prune_param_grid_table(fx.runs(spark, sf), grid)


# ============================================================ A10 stats lines, G5 Poisson weights

@register("histogram_stats", fx.with_views(f"""
SELECT {r6('avg(amount)')} AS mean, {r6('quantile_cont(amount, 0.5)')} AS median,
       {r6('stddev_samp(amount)')} AS sd,
       {', '.join(f"{r6(f'avg(amount) + {k} * stddev_samp(amount)')} AS plus_{k}sd" for k in (1, 2, 3))},
       {', '.join(f"{r6(f'avg(amount) - {k} * stddev_samp(amount)')} AS minus_{k}sd" for k in (1, 2, 3))}
FROM wide_raw""", "wide_raw"))
def q_histogram_stats(spark, sf):
    return rounded(A.histogram_stats(fx.wide_raw(spark, sf), "amount"))


def _poisson_sql(u: str) -> str:
    return "(" + " + ".join(f"CAST({u} > {cut!r} AS INTEGER)" for cut in G._poisson1_cdf()) + ")"


_PU = "('0x' || substr(md5(CAST(s.seed AS VARCHAR) || ':' || CAST(o.o_orderkey AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0"


@register("bootstrap_weights", f"""
WITH s AS ({_SEEDS_SQL})
SELECT o.o_orderkey, s.bootstrap, {_poisson_sql(_PU)} AS weight
FROM orders o, s""")
def q_bootstrap_weights(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return G.bootstrap_weights(o, "o_orderkey", 10)
