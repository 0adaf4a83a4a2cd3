"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "binscope") -> SparkSession:
    """Session used by tests and bench on one machine.

    On a cluster the session comes from the platform; nothing here is needed.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster this setting names a shared folder (HDFS/S3/ABFS); it is never
    overridden here. Only a bare local session (tests) gets a fresh temp folder;
    elsewhere an unset folder is an error, as executors do not share local disks.
    """
    share_package(spark)
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="binscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, whatever the working
    folder is; a cluster that installs the package on its machines is not affected."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def cut_lineage(df: DataFrame, name: str = "table", rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: the lineage is cut, the result survives executor loss, and unlike
    ``Dataset.checkpoint(eager=True)`` (an eager count, then a second
    computation to write) the input is computed exactly once. ``rows_per_file`` bounds
    the rows of a file: what many passes read must not come in the few tasks that wrote it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file or 0).parquet(path)
    return spark.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for intermediate tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/binscope-scratch/{name}-{uuid.uuid4().hex}"
