"""Kafka topic as the edit feed (source) and as the ingest target (sink).

Requires the ``spark-sql-kafka-0-10`` package matching the Spark version on
the classpath; without it ``load()`` / ``start()`` fail at once.  The
builders below only assemble options, so they are testable anywhere.
Producer settings pass through as ``kafka.*`` options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.config import DEFAULT_STARTING_OFFSETS
from editpulse.functions.parse import RECEIVED, to_wire_json

# Producer defaults of the ingest step.
PRODUCER_DEFAULTS = {
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "gzip",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.acks": "1",
}


def source_options(servers: str, topic: str, starting_offsets: str = DEFAULT_STARTING_OFFSETS,
                   **extra: str) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = DEFAULT_STARTING_OFFSETS, **extra: str) -> DataFrame:
    """Streaming messages as text lines (column ``value``), with the topic's own
    timestamp (``received``)."""
    raw = spark.readStream.format("kafka").options(
        **source_options(servers, topic, starting_offsets, **extra)
    ).load()
    return messages(raw)


def messages(records: DataFrame) -> DataFrame:
    """``value`` as text and ``received`` of a topic's records."""
    return records.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias(RECEIVED))


def sink_options(servers: str, topic: str, checkpoint: str, **producer: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    opts.update(PRODUCER_DEFAULTS)
    opts.update({k if k.startswith("kafka.") else f"kafka.{k}": str(v) for k, v in producer.items()})
    return opts


def publishable(edits: DataFrame) -> DataFrame:
    """The ``value`` column to publish: the message as it came (``raw``, from
    ``parse_edits(keep_raw=True)``) with all its fields, or, without it, the
    parsed fields as JSON."""
    if "raw" in edits.columns:
        return edits.select(F.col("raw").alias("value"))
    return to_wire_json(edits)


def kafka_sink(edits: DataFrame, servers: str, topic: str, checkpoint: str, options=None, **producer: str):
    """Publish edits as JSON messages (no key), streaming, on the trigger of
    ``options`` (``JobOptions``; default: as fast as batches end)."""
    writer = publishable(edits).writeStream.format("kafka").options(**sink_options(servers, topic, checkpoint, **producer))
    if options is not None:
        writer = writer.trigger(availableNow=True) if options.trigger is None else writer.trigger(processingTime=options.trigger)
    return writer.start()
