"""Permanent deployment of a registered model, as a Structured Streaming job.

The reference deploys a model as a permanent in-warehouse function and calls it on new
rows. The Spark counterpart is a stateless streaming query: feature rows arriving as
Parquet files in a folder are scored by the registered ``PipelineModel`` and appended to a
sink folder. Progress lives in a checkpoint in the shared folder, so a restarted or
rescheduled job resumes exactly where it stopped (file source + file sink are exactly
once). No port or endpoint is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txengine.plans.registry import ModelRef
from txengine.session import scratch_path


def deploy(
    spark: SparkSession,
    ref: ModelRef,
    source_path: str,
    sink_path: str,
    schema: StructType,
    checkpoint_path: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start scoring every file that lands in ``source_path``.

    ``available_now=True`` processes what is there and stops (a scheduled batch run);
    ``False`` keeps the query running with micro-batches as files arrive.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = ref.predict(reader.parquet(source_path))
    writer = (
        scored.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path or scratch_path(spark, "stream_ckpt"))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def score_folder(spark: SparkSession, ref: ModelRef, rows: DataFrame) -> DataFrame:
    """Land ``rows`` as files, run the deployed stream over them to completion and return
    the sink as a DataFrame (used by the query registry and the tests)."""
    source, sink = scratch_path(spark, "stream_in"), scratch_path(spark, "stream_out")
    rows.write.parquet(source)
    query = deploy(spark, ref, source, sink, rows.schema)
    query.awaitTermination()
    return spark.read.parquet(sink)
