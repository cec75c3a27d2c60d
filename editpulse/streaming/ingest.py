"""The ingest job: captured feed -> allow-lists -> whole messages -> topic.

    python -m editpulse.streaming.ingest --input DIR --checkpoint DIR \\
        (--output DIR | --kafka-servers H:P --topic T) [--sse] \\
        [--namespaces 0,1 | --all-namespaces] [--wikis enwiki,dewiki] \\
        [--trigger "30 seconds" | --available-now]

What leaves is the ``value`` column of a topic: the message as it came, fields
outside the parsed schema included.  It is written to a Kafka topic, or, as text
lines, to a topic dump that ``sources.text`` reads back.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from editpulse.config import JobOptions
from editpulse.functions.parse import namespace_filter, parse_edits, sse_frames, wiki_filter
from editpulse.operators.counters import observe_counters
from editpulse.sources.kafka import kafka_sink, publishable
from editpulse.sources.text import read_lines_stream
from editpulse.streaming.job import run_all, trigger


def accepted_messages(lines: DataFrame, options: JobOptions, observe: bool = False) -> DataFrame:
    """Messages of a feed that pass the allow-lists, parsed and whole (``raw``).

    Works on batch and streaming DataFrames.  Text that is no JSON, and messages
    without a namespace where one is asked for, do not pass."""
    messages = sse_frames(lines) if options.sse_framed else lines
    edits = parse_edits(messages, keep_raw=True)
    if observe:
        edits = observe_counters(edits, "ingest", options.namespaces)
    return wiki_filter(namespace_filter(edits, options.namespaces), options.wikis)


def start_ingest_job(lines: DataFrame, options: JobOptions, checkpoint: str, path: str | None = None,
                     servers: str | None = None, topic: str | None = None, **producer: str) -> StreamingQuery:
    """Publish a feed's accepted messages to a topic dump (``path``) or a Kafka topic."""
    if not lines.isStreaming:
        raise ValueError("start_ingest_job needs a streaming DataFrame")
    if (path is None) == (servers is None):
        raise ValueError("give exactly one of path or servers")
    edits = accepted_messages(lines, options, observe=True)
    if servers is not None:
        return kafka_sink(edits, servers, topic, checkpoint, options=options, **producer)
    writer = publishable(edits).writeStream.outputMode("append").format("text")
    return trigger(writer.option("path", path).option("checkpointLocation", checkpoint), options).start()


def main(argv=None) -> None:
    logging.basicConfig(level=logging.INFO)
    p = argparse.ArgumentParser(prog="editpulse.streaming.ingest")
    p.add_argument("--input", required=True, help="directory of captured lines (file stream)")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--output", help="directory of the topic dump")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic", default="wiki_changes")
    p.add_argument("--sse", action="store_true", help="input lines carry SSE framing")
    p.add_argument("--namespaces", default="0")
    p.add_argument("--all-namespaces", action="store_true")
    p.add_argument("--wikis", default="")
    p.add_argument("--trigger", default="30 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-files-per-trigger", type=int)
    a = p.parse_args(argv)
    if bool(a.output) == bool(a.kafka_servers):
        p.error("give exactly one of --output or --kafka-servers")
    options = JobOptions(
        trigger=None if a.available_now else a.trigger, sse_framed=a.sse,
        namespaces=None if a.all_namespaces else tuple(int(x) for x in a.namespaces.split(",") if x),
        wikis=tuple(w for w in a.wikis.split(",") if w), max_files_per_trigger=a.max_files_per_trigger)
    spark = SparkSession.builder.appName("editpulse-ingest").getOrCreate()
    lines = read_lines_stream(spark, a.input, a.max_files_per_trigger)
    run_all(spark, [start_ingest_job(lines, options, a.checkpoint, a.output, a.kafka_servers, a.topic if a.kafka_servers else None)])


if __name__ == "__main__":
    main()
