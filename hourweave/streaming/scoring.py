"""Structured Streaming scoring of independent wide windows.

Windows that arrive as files are scored as they land: the wide path is map-only
(see operators/wide.py), so the streaming query needs no state and no watermark --
each micro-batch is transformed row by row and appended to the sink.  Progress is
kept in the checkpoint location, so a restarted query resumes exactly where it
stopped (the file source and the file sink are both exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import PanelSpec
from ..operators.forecast import clip_predictions
from ..operators.preprocess import FittedParams
from ..operators.submission import blended_window_predictions


def scored_stream(stream: DataFrame, spec: PanelSpec, params: FittedParams, first_weight: float) -> DataFrame:
    p = blended_window_predictions(stream, spec, params, first_weight)
    return p.select("id", "station", clip_predictions("blend").alias("prediction"))


def score_window_files(spark: SparkSession, source_dir: str, schema: T.StructType, spec: PanelSpec,
                       params: FittedParams, first_weight: float, sink_dir: str, checkpoint_dir: str,
                       available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and with ``available_now`` run to completion) the scoring stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = scored_stream(reader.parquet(source_dir), spec, params, first_weight)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
