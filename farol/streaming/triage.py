"""The triage report is a projection around the model, so it runs on a stream unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from farol.sources.artifact import Artifact


def stream_report(artifact: Artifact, cases: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Score a streaming table and append the report as Parquet; the checkpoint makes every case appear exactly once."""
    writer = artifact.report(cases).writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
