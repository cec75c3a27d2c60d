"""Captured text feeds: SSE captures and topic dumps, one line per row.

Batch (``read_lines``) and streaming (``read_lines_stream``) readers share
the schema ``value string``; new files dropped into a streaming directory
are picked up by the next micro-batch.  The stream's rows also carry
``received``, the time their file landed: the clock that edits stamped in the
future are held against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.parse import RECEIVED
from editpulse.schema import LINE_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINE_SCHEMA).text(path)


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LINE_SCHEMA).format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias(RECEIVED))
