"""Run registry kept as append-only tables.

Tables under one root folder (a shared path on a cluster):
``runs(experiment, run_id, run_name, start_time)``,
``params(run_id, key, value)``, ``metrics(run_id, key, value, step)``,
``state(experiment, run_name, state_name, pos, value, written_at)`` and
``models(run_id, path, written_at)``. Writes are appends of small DataFrames;
"latest wins" reads use ``max_by`` / a ranked window, not a driver loop.
Fitted state is an ordered list of strings (no pickles).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS_SCHEMA = "experiment string, run_id string, run_name string, start_time bigint"
PARAMS_SCHEMA = "run_id string, key string, value string"
METRICS_SCHEMA = "run_id string, key string, value double, step bigint"
STATE_SCHEMA = ("experiment string, run_name string, state_name string, pos int, value string, "
                "written_at bigint")
MODELS_SCHEMA = "run_id string, path string, written_at bigint"


def latest_runs(runs: DataFrame) -> DataFrame:
    """N1 read side: the latest run of each (experiment, run_name)."""
    return runs.groupBy("experiment", "run_name").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"),
        F.max("start_time").alias("start_time"))


def metric_rows(df: DataFrame, run_col: str, metric_cols: list[str], step: int = 0) -> DataFrame:
    """N3 bulk form: one metric row per (run, metric column) as float; NULL
    values log nothing."""
    arr = F.array(*[F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value"))
                    for m in metric_cols])
    return (df.select(F.col(run_col).cast("string").alias("run_id"), F.inline(arr))
            .where(F.col("value").isNotNull()).withColumn("step", F.lit(step).cast("bigint")))


def param_rows(df: DataFrame, run_col: str, param_cols: list[str]) -> DataFrame:
    """N2 bulk form: one param row per (run, parameter column), values as text."""
    arr = F.array(*[F.struct(F.lit(p).alias("key"), F.col(p).cast("string").alias("value"))
                    for p in param_cols])
    return df.select(F.col(run_col).cast("string").alias("run_id"), F.inline(arr))


def best_runs(runs: DataFrame, metrics: DataFrame, metric: str, mode: str = "max") -> DataFrame:
    """N4 for every experiment at once: best run by ``metric`` (runs without
    it last, then latest start); ``estimator`` = text before the first ``_``."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    m = metrics.where(F.col("key") == metric).groupBy("run_id").agg(
        F.max_by("value", "step").alias("metric_value"))
    j = runs.join(m, "run_id", "left")
    order = (F.col("metric_value").desc_nulls_last() if mode == "max"
             else F.col("metric_value").asc_nulls_last())
    w = Window.partitionBy("experiment").orderBy(order, F.desc("start_time"), F.asc("run_id"))
    return (j.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1)
            .select("experiment", "run_id", "run_name", "metric_value",
                    F.split(F.col("run_name"), "_").getItem(0).alias("estimator")))


class Registry:
    """Driver-side handle on the registry tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- storage
    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self._path(name))

    def table(self, name: str, schema: str) -> DataFrame:
        """The table, empty only if its folder is not there: the file system of the path is asked,
        and every other error rises."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name))

    def runs(self) -> DataFrame:
        return self.table("runs", RUNS_SCHEMA)

    def metrics(self) -> DataFrame:
        return self.table("metrics", METRICS_SCHEMA)

    def params(self) -> DataFrame:
        return self.table("params", PARAMS_SCHEMA)

    # -- N1
    def get_or_create_run(self, experiment: str, run_name: str, prefix: str | None = None) -> str:
        """Latest run with this name in the experiment, or a new one."""
        name = f"{prefix}/{run_name}" if prefix else run_name
        hit = (latest_runs(self.runs().where((F.col("experiment") == experiment)
                                             & (F.col("run_name") == name)))
               .select("run_id").collect())
        if hit:
            return hit[0]["run_id"]
        rid = uuid.uuid4().hex
        self._append("runs", self.spark.createDataFrame(
            [(experiment, rid, name, time.time_ns())], RUNS_SCHEMA))
        return rid

    # -- N2
    def log_params(self, run_id: str, params: dict | None = None, keys: list[str] | None = None,
                   hyperparameters: dict | None = None) -> None:
        """Log only ``keys`` of ``params`` (all when None) plus every hyper-parameter."""
        rows = []
        for k, v in (params or {}).items():
            if keys is None or k in keys:
                rows.append((run_id, str(k), None if v is None else str(v)))
        for k, v in (hyperparameters or {}).items():
            rows.append((run_id, str(k), None if v is None else str(v)))
        if rows:
            self._append("params", self.spark.createDataFrame(rows, PARAMS_SCHEMA))

    # -- N3
    def log_metrics(self, run_id: str, metrics: dict | None, step: int = 0) -> None:
        """Each metric as float; None or empty logs nothing."""
        if not metrics:
            return
        rows = [(run_id, str(k), float(v), int(step)) for k, v in metrics.items() if v is not None]
        if rows:
            self._append("metrics", self.spark.createDataFrame(rows, METRICS_SCHEMA))

    # -- N4
    def find_best_model(self, experiment: str, metric: str, mode: str = "max") -> tuple[str, str]:
        r = best_runs(self.runs().where(F.col("experiment") == experiment), self.metrics(),
                      metric, mode).collect()
        if not r:
            raise LookupError(f"no runs in experiment {experiment!r}")
        return r[0]["run_name"], r[0]["estimator"]

    # -- N5
    def save_state(self, experiment: str, run_name: str, name: str, values: list) -> None:
        ts = time.time_ns()
        rows = [(experiment, run_name, name, i, None if v is None else str(v), ts)
                for i, v in enumerate(values)]
        if not rows:  # an empty list is still a saved state: one marker row
            rows = [(experiment, run_name, name, -1, None, ts)]
        self._append("state", self.spark.createDataFrame(rows, STATE_SCHEMA))

    def state_table(self) -> DataFrame:
        return self.table("state", STATE_SCHEMA)

    def load_state(self, experiment: str, run_name: str, name: str) -> list:
        cur = latest_state(self.state_table().where(
            (F.col("experiment") == experiment) & (F.col("run_name") == run_name)
            & (F.col("state_name") == name)))
        rows = cur.orderBy("pos").collect()
        if not rows:
            raise LookupError(f"no state {name!r} for {experiment}/{run_name}")
        return [r["value"] for r in rows if r["pos"] >= 0]

    # -- N6
    def save_model(self, run_id: str, model) -> str:
        path = f"{self.root}/models/{run_id}/{uuid.uuid4().hex}"
        model.write().overwrite().save(path)
        self._append("models", self.spark.createDataFrame(
            [(run_id, path, time.time_ns())], MODELS_SCHEMA))
        return path

    def load_model(self, run_id: str, loader):
        m = self.table("models", MODELS_SCHEMA).where(F.col("run_id") == run_id)
        r = m.orderBy(F.desc("written_at")).limit(1).collect()
        if not r:
            raise LookupError(f"no model for run {run_id}")
        return loader.load(r[0]["path"])


def latest_state(state: DataFrame) -> DataFrame:
    """N5 read side: for each (experiment, run_name, state_name) the rows of the
    most recent write only."""
    last = state.groupBy("experiment", "run_name", "state_name").agg(
        F.max("written_at").alias("written_at"))
    return state.join(last, ["experiment", "run_name", "state_name", "written_at"])
