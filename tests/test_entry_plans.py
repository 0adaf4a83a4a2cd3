"""Driver contract and physical-plan properties."""

import __spark_entry__ as E
from binscope import catalog, fixtures as fx
from binscope.operators import metrics as M


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and set(df.columns) == {"metric", "a", "b", "Mean"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_metric_plans(spark, small_dir):
    s = fx.scored(spark, small_dir)
    for df in (M.metrics_long(s, ["model"]), M.threshold_metrics(s, ["model", "split"]),
               M.evaluation_bundle(s, ["model", "split"])):
        p = _plan(df)
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_prunes_columns(spark, small_dir):
    s = fx.scored(spark, small_dir).select("id", "p")
    plan = _plan(s)
    assert "o_orderdate" not in plan and "o_totalprice" not in plan


def test_running_sum_window_is_partitioned_by_bucket(spark, small_dir):
    s = fx.scored(spark, small_dir)
    p = _plan(M.threshold_metrics(s, ["model"]))
    assert "_bucket" in p


def test_small_queries_match_duckdb(spark, small_dir):
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "part", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    for name in ("metrics_report", "roc_auc", "average_precision", "clean_dataframe",
                 "stratified_split", "group_metrics", "top_contributions_json"):
        s = catalog.QUERIES[name](spark, small_dir).toPandas()
        d = con.execute(catalog.ORACLE[name]).df()
        assert len(s) == len(d), name
        assert sorted(s.columns) == sorted(d.columns), name
