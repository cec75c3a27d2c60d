"""Run the edit-count job from the command line.

    python -m editpulse.streaming --input DIR --output DIR --checkpoint DIR \\
        [--kafka-servers H:P --topic T] [--window "1 minute"] [--slide ...] \\
        [--watermark "2 minutes"] [--trigger "30 seconds" | --available-now] \\
        [--mode update|append] [--namespaces 0,1 | --all-namespaces] \\
        [--wikis enwiki,dewiki] [--sse] [--table user_edit_counts] \\
        [--state-store rocksdb] [--state-partitions N] [--no-idle-batches] \\
        [--max-future-skew "1 hour" | --any-time] [--rejects DIR] \\
        [--max-offsets-per-trigger N] [--min-partitions N]

Uses the session it is submitted with (``spark-submit`` settings apply).
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from editpulse.config import DEFAULT_MAX_FUTURE_SKEW, DEFAULT_STARTING_OFFSETS, JobOptions, WindowSpec
from editpulse.schema import COUNT_TABLES
from editpulse.sources.kafka import kafka_source
from editpulse.sources.text import read_lines_stream
from editpulse.streaming.job import run_all, start_counts_job, start_rejects_job, start_split_job, stream_session
from editpulse.streaming.monitor import IngestLogListener


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="editpulse.streaming")
    p.add_argument("--input", help="directory of captured lines (file stream)")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic", default="wiki_changes")
    p.add_argument("--starting-offsets", default=DEFAULT_STARTING_OFFSETS)
    p.add_argument("--output", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--table", default="user_edit_counts", choices=sorted(COUNT_TABLES))
    p.add_argument("--window", default="1 minute")
    p.add_argument("--slide")
    p.add_argument("--watermark", default="2 minutes")
    p.add_argument("--trigger", default="30 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--mode", default="update", choices=["update", "append"])
    p.add_argument("--namespaces", default="0")
    p.add_argument("--all-namespaces", action="store_true")
    p.add_argument("--wikis", default="")
    p.add_argument("--sse", action="store_true", help="input lines carry SSE framing")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--state-store", choices=["default", "rocksdb"], default="default")
    p.add_argument("--state-partitions", type=int,
                   help="state-store partitions (fixed for the checkpoint's lifetime)")
    p.add_argument("--no-idle-batches", action="store_true",
                   help="update mode: skip micro-batches that would only evict state")
    p.add_argument("--max-future-skew", default=DEFAULT_MAX_FUTURE_SKEW,
                   help="reject edits stamped further ahead of the time their message was taken in")
    p.add_argument("--any-time", action="store_true", help="accept edits stamped at any time")
    p.add_argument("--rejects", help="directory for rejected messages (append mode: read apart, checkpoint <checkpoint>-rejects)")
    p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: bound of one micro-batch")
    p.add_argument("--min-partitions", type=int, help="Kafka: split hot topic partitions over so many tasks")
    a = p.parse_args(argv)
    if bool(a.input) == bool(a.kafka_servers):
        p.error("give exactly one of --input or --kafka-servers")
    return a


def options_from(a: argparse.Namespace) -> JobOptions:
    return JobOptions(
        window=WindowSpec(a.window, a.slide),
        watermark=a.watermark,
        trigger=None if a.available_now else a.trigger,
        output_mode=a.mode,
        namespaces=None if a.all_namespaces else tuple(int(x) for x in a.namespaces.split(",") if x),
        wikis=tuple(w for w in a.wikis.split(",") if w),
        sse_framed=a.sse,
        max_files_per_trigger=a.max_files_per_trigger,
        idle_batches=not a.no_idle_batches,
        state_partitions=a.state_partitions,
        state_store=None if a.state_store == "default" else a.state_store,
        max_future_skew=None if a.any_time else a.max_future_skew,
    )


def kafka_limits(a: argparse.Namespace) -> dict[str, str]:
    limits = {"maxOffsetsPerTrigger": a.max_offsets_per_trigger, "minPartitions": a.min_partitions}
    return {k: str(v) for k, v in limits.items() if v is not None}


def main(argv=None) -> None:
    logging.basicConfig(level=logging.INFO)
    a = parse_args(argv)
    options = options_from(a)
    spark = SparkSession.builder.appName("editpulse-counts").getOrCreate()
    session = stream_session(spark, options)

    def lines():
        if a.input:
            return read_lines_stream(session, a.input, a.max_files_per_trigger)
        return kafka_source(session, a.kafka_servers, a.topic, a.starting_offsets, **kafka_limits(a))

    listener = IngestLogListener()
    session.streams.addListener(listener)
    try:
        if a.rejects and a.mode == "update":
            queries = [start_split_job(lines(), options, a.output, a.rejects, a.checkpoint, a.table)]
        else:
            queries = [start_counts_job(lines(), options, a.output, a.checkpoint, a.table)]
            if a.rejects:
                queries.append(start_rejects_job(lines(), options, a.rejects, f"{a.checkpoint.rstrip('/')}-rejects", a.table))
        run_all(session, queries)
    finally:
        session.streams.removeListener(listener)


if __name__ == "__main__":
    main()
