"""Scoring of files as they land. Scoring is a projection, so it needs no stream state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortflow.plans.workflow import Scorer


def score_landing_folder(
    spark: SparkSession,
    scorer: Scorer,
    landing: str,
    columns: list[str],
    output: str,
    progress: str,
    once: bool = True,
) -> StreamingQuery:
    """Score each new headered CSV file exactly once; `progress` is the stream's own checkpoint folder."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    incoming = spark.readStream.schema(schema).option("header", True).csv(landing)
    writer = (
        scorer.score(incoming).writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", progress)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
