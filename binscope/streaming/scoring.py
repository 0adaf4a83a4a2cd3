"""Streaming form of the inference chain.

Every *apply* step (cleaning with saved types, scaling with saved statistics,
coefficient scoring, explanations) is a stateless projection, so the same
functions run on a streaming DataFrame: new Parquet files landing in a folder
are scored and written to a Parquet sink. The sink's checkpoint lives under the
cluster's shared ``spark.checkpoint.dir`` so a restarted query resumes exactly
where it stopped (file source + file sink = exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from binscope.plans.inference import score_and_explain
from binscope.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (schema is required)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def start_scoring(spark: SparkSession, source: str, schema: StructType, sink: str, key: str,
                  state: dict, coefs: dict, means: dict, intercept: float,
                  threshold: float | None = 0.5, name: str = "score_stream",
                  trigger_once: bool = False) -> StreamingQuery:
    """Score and explain every new row; append to a Parquet sink."""
    stream = read_stream(spark, source, schema)
    out = score_and_explain(stream, key, state, coefs, means, intercept, threshold)
    ckpt = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    w = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ckpt).outputMode("append").queryName(name))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
