"""The streaming edit-count job: source -> parse -> filter -> windowed count
-> sink.

The transformation (``edit_counts``) is the same function the batch queries
use; this module only adds the watermark, the trigger, the checkpoint and
the sink.  Two sinks:

* ``update`` mode into a versioned upsert table (what a keyed table needs
  when running totals are re-emitted), via ``foreachBatch``;
* ``append`` mode into a Parquet file sink: each window is written once,
  after the watermark passes its end (exactly-once through the sink log).

``start_split_job`` has two outputs and one reader: each message of a
micro-batch is classified once, what can be counted goes through the stateful
count into the versioned table, and the rest, whole and with its reason, into the
rejects table, from one ``foreachBatch``.

Continuous processing cannot run a stateful aggregate and is rejected.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editpulse.config import JobOptions, duration_seconds
from editpulse.functions.parse import (
    classify,
    namespace_filter,
    parse_edits,
    sse_frames,
    wiki_filter,
    without_future_time,
)
from editpulse.operators.counters import observe_counters
from editpulse.operators.windowed import count_table
from editpulse.sinks.versioned import VERSIONS, VersionedUpsert, glob_paths, path_exists, utc_date, write_rejects, write_version
from editpulse.sources.text import read_lines_stream  # noqa: F401  (re-export)

log = logging.getLogger(__name__)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, options: JobOptions) -> SparkSession:
    """Session to build the streaming job in, carrying the job's settings.

    A stateful query keeps ``spark.sql.shuffle.partitions`` for the life of
    its checkpoint: it is the number of state-store partitions of every
    micro-batch.  That, the state store and whether idle (no-data) batches run,
    are set on a copy of the caller's session (with its settings), which is
    left untouched.  Build the source from the returned session.
    """
    if options.state_partitions is None and options.idle_batches and options.state_store is None:
        return spark
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    if options.state_store == "rocksdb":
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if options.state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(int(options.state_partitions)))
    if not options.idle_batches:
        session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return session


def edit_counts(lines: DataFrame, options: JobOptions, table: str = "user_edit_counts",
                observe: bool = False) -> DataFrame:
    """Lines -> windowed counts for ``table`` under ``options``.

    Works on batch and streaming DataFrames; the watermark only matters to
    streaming ones.
    """
    edits = _parsed(lines, options, keep_raw=observe)
    if observe:
        edits = observe_counters(edits, "ingest", options.namespaces, table)
    return _counted(edits, options, table)


def _counted(edits: DataFrame, options: JobOptions, table: str) -> DataFrame:
    edits = wiki_filter(namespace_filter(edits, options.namespaces), options.wikis)
    return count_table(edits, table, options.window, options.watermark)


def _parsed(lines: DataFrame, options: JobOptions, keep_raw: bool) -> DataFrame:
    messages = sse_frames(lines) if options.sse_framed else lines
    skew = None if options.max_future_skew is None else duration_seconds(options.max_future_skew)
    return without_future_time(parse_edits(messages, keep_raw=keep_raw), skew)


def rejects(lines: DataFrame, options: JobOptions, table: str = "user_edit_counts") -> DataFrame:
    """Messages that cannot be counted into ``table``, whole, with the reason
    (before the allow-lists: a rejected message may lack what they look at)."""
    return _rejected(classify(_parsed(lines, options, keep_raw=True), table))


def _rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")


def counts_and_rejects(lines: DataFrame, options: JobOptions, table: str = "user_edit_counts") -> DataFrame:
    """Both outputs of one reader as one DataFrame: rows of counts (``raw`` and
    ``reject_reason`` are NULL), and rejected messages (all else is NULL).

    Both sides hang on the same classified messages of the same source, so that
    a micro-batch has the same messages, the same clock and one decision for
    each on both; the decision is part of the plan and a replay repeats it."""
    edits = observe_counters(_parsed(lines, options, keep_raw=True), "ingest", options.namespaces, table)
    return _counted(edits.where(F.col("reject_reason").isNull()), options, table).unionByName(_rejected(edits), allowMissingColumns=True)


class SplitBatch:
    """``foreachBatch`` callback: counts to version ``i`` of the versioned table,
    rejected messages to part ``i`` of the rejects table.  Both are overwritten
    as a whole, so a replayed batch changes neither.  The batch is kept while it is
    written twice, so the stateful count runs once."""

    def __init__(self, path: str, rejects_path: str):
        self.upsert, self.rejects_path = VersionedUpsert(path), rejects_path
        self.last_metrics: dict | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            counts = batch.where(F.col("window_start").isNotNull()).drop("raw", "reject_reason")
            self.upsert(counts, batch_id)
            rejected = batch.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")
            self.last_metrics = {**self.upsert.last_metrics, "rejected": write_rejects(rejected, self.rejects_path, batch_id)}
        finally:
            batch.unpersist()


def start_split_job(lines: DataFrame, options: JobOptions, output_path: str, rejects_path: str, checkpoint: str,
                    table: str = "user_edit_counts", query_name: str | None = None) -> StreamingQuery:
    """Start the update-mode job with both outputs from one reader."""
    if not lines.isStreaming:
        raise ValueError("start_split_job needs a streaming DataFrame")
    if options.output_mode != "update":
        raise ValueError("one reader for counts and rejects needs update mode")
    _refuse_stale_table(lines.sparkSession, output_path, checkpoint)
    both = counts_and_rejects(lines, options, table)
    writer = both.writeStream.outputMode("update").foreachBatch(SplitBatch(output_path, rejects_path)).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return trigger(writer, options).start()


def _refuse_stale_table(spark: SparkSession, output_path: str, checkpoint: str) -> None:
    """A new checkpoint counts batches from 0 again: the versions that a table has from an
    earlier checkpoint would be taken for newer than the new ones."""
    held = glob_paths(spark, f"{output_path.rstrip('/')}/{VERSIONS}/batch_id=*/window_date=*")
    if held and not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{output_path} holds versions of another checkpoint than the new one {checkpoint}: compact it or take a new table")


def start_rejects_job(lines: DataFrame, options: JobOptions, output_path: str, checkpoint: str,
                      table: str = "user_edit_counts") -> StreamingQuery:
    """Append the rejected messages of a stream to a Parquet table, on a reader and a
    checkpoint of its own beside ``start_counts_job`` (append mode; in update mode
    ``start_split_job`` needs one reader only).  The messages' own clock makes both
    readers decide alike."""
    writer = rejects(lines, options, table).writeStream.outputMode("append").format("parquet")
    return trigger(writer.option("path", output_path).option("checkpointLocation", checkpoint), options).start()


def trigger(writer, options: JobOptions):
    """``writer`` with the job's trigger."""
    if options.trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=options.trigger)


def start_counts_job(
    lines: DataFrame,
    options: JobOptions,
    output_path: str,
    checkpoint: str,
    table: str = "user_edit_counts",
    query_name: str | None = None,
    observe: bool = True,
) -> StreamingQuery:
    """Start the job; returns the running query."""
    if not lines.isStreaming:
        raise ValueError("start_counts_job needs a streaming DataFrame")
    counts = edit_counts(lines, options, table, observe=observe)
    if options.output_mode == "update":
        _refuse_stale_table(lines.sparkSession, output_path, checkpoint)
        writer = counts.writeStream.outputMode("update").foreachBatch(VersionedUpsert(output_path))
    else:
        stored = counts.withColumn("created_at", F.current_timestamp()).withColumn(
            "window_date", utc_date(F.col("window_start"))
        )
        writer = (
            stored.writeStream.outputMode("append")
            .format("parquet")
            .partitionBy("window_date")
            .option("path", output_path)
        )
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return trigger(writer, options).start()


def run_all(spark: SparkSession, queries: list[StreamingQuery], poll_sec: float = 1.0) -> None:
    """Wait until all ``queries`` have ended; when one fails, stop the others and
    raise its error.

    Waits on whichever query of the session ends first, so a query that dies beside
    others that never end is seen at once."""
    running = list(queries)
    try:
        while running:
            for query in running:
                if query.exception() is not None:
                    raise RuntimeError(f"streaming query {query.name or query.id} failed: {query.exception()}")
            running = [q for q in running if q.isActive]
            if running:
                try:
                    spark.streams.awaitAnyTermination(poll_sec)
                except Exception as error:  # of any query of the session: ours are asked above
                    if all(q.isActive and q.exception() is None for q in running):
                        log.warning("another streaming query of this session failed: %s", error)
                spark.streams.resetTerminated()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def run_to_end(query: StreamingQuery, timeout_sec: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish (or the timeout)."""
    if timeout_sec is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_sec)
    if query.isActive:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query
