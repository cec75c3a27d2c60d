"""Driver registry: one Spark query per built operator, plus its DuckDB SQL.

Every query reads the driver's ``events`` table (through the mapping in
``editpulse.sources.testdata``) and runs over all of it; the time-relative
queries use a fixed ``as_of`` after the end of the data instead of
``NOW()``.  Timestamps leave as TIMESTAMP_NTZ holding the UTC wall clock,
which is what DuckDB's naive TIMESTAMP holds.

Windows: 1 hour for the user tables (1 minute and 1 day variants too),
1 day for pages, 1 hour sliding by 30 minutes for the sliding variant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.config import JobOptions, WindowSpec
from editpulse.functions.parse import (
    WIRE_FIELDS,
    namespace_filter,
    parse_edits,
    rejected_edits,
    sse_frames,
    to_wire_json,
    valid_edits,
    wiki_filter,
)
from editpulse.functions.time import (
    epoch_seconds,
    first_event_second,
    minutes_before,
    start_of_day,
    utc_wallclock,
)
from editpulse.maintenance import closed_through
from editpulse.maintenance import run as run_maintenance
from editpulse.operators import counters
from editpulse.operators.windowed import count_table
from editpulse.plans import dashboard as dash
from editpulse.schema import CORRUPT_COL
from editpulse.session import scratch_dir
from editpulse.sinks.csv import export_csv, read_export
from editpulse.sinks.versioned import backfill
from editpulse.sources.counts import read_final, read_newest, read_versioned
from editpulse.sources.testdata import (
    FAULT_CYCLE,
    FAULTS,
    FAR_SECOND,
    NO_SECOND,
    edit_events,
    event_time_bounds,
    faulty_messages,
    feed_lines,
    sse_capture,
    sse_lines,
    wire_messages,
)
from editpulse.sources.text import read_lines
from editpulse.streaming.ingest import start_ingest_job
from editpulse.streaming.job import (
    edit_counts,
    read_lines_stream,
    run_to_end,
    start_counts_job,
    start_split_job,
    stream_session,
)
from editpulse.streaming.replay import replay_chunks, replay_parts

# Fixed values of the test harness: the clock the range queries run at
# (just after the last event of the data) and the "today" clock.
AS_OF = "2024-01-31T00:00:00"
TODAY_AS_OF = "2024-01-30T23:59:59"
RANGE_MINUTES = 240  # the widest range the dashboard offers
RETENTION_DAYS = 7
RETENTION_AS_OF = "2024-01-30T14:30:00"  # the boundary lies inside a day
TOP_PAGES_K = 5
PIPELINE_NAMESPACES = (0,)
PIPELINE_WIKIS = ("enwiki", "dewiki")

HOUR = WindowSpec("1 hour")
MINUTE = WindowSpec("1 minute")
DAY = WindowSpec("1 day")
SLIDING = WindowSpec("1 hour", "30 minutes")

Query = Callable[[SparkSession, str], DataFrame]

# Streaming harness: the events arrive in this many time-ordered chunks,
# each processed by a restart of the job on the same checkpoint.
STREAM_CHUNKS = 6
STREAM_WATERMARK = "2 minutes"
# Option of the replay's job; fixed, as it is fixed for a checkpoint's lifetime.
STREAM_STATE_PARTITIONS = 8
# A watermark longer than the data, for the replay in an order of its own.
LONG_WATERMARK = "60 days"
# The chunk the late-data query delivers last (of STREAM_CHUNKS).
LATE_CHUNK = 3


def wallclock(df: DataFrame) -> DataFrame:
    """Turn every TimestampType column into the UTC wall clock (NTZ)."""
    return df.select(
        *[
            utc_wallclock(f.name).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def counts(
    spark: SparkSession,
    sf_dir: str,
    table: str = "user_edit_counts",
    window: WindowSpec = HOUR,
    window_start_from: int | None = None,
) -> DataFrame:
    """A count table computed from the events.

    ``window_start_from`` (epoch seconds) states that only windows starting
    at or after it are needed; it is turned into an event-time range that
    reaches the Parquet scan.
    """
    since = None
    if window_start_from is not None:
        since = first_event_second(window_start_from, window.step_seconds)
    return count_table(edit_events(spark, sf_dir, since, page_fields=table != "user_edit_counts"), table, window)


def _recent(spark, sf_dir, minutes, as_of=AS_OF, table="user_edit_counts", window=HOUR):
    return counts(spark, sf_dir, table, window, minutes_before(as_of, minutes))


def _sse_parsed(spark: SparkSession, sf_dir: str, keep_raw: bool = False) -> DataFrame:
    return parse_edits(sse_frames(sse_capture(spark, sf_dir)), keep_raw=keep_raw)


def run_stream(spark: SparkSession, sf_dir: str, output_mode: str,
               n_chunks: int = STREAM_CHUNKS, progress: list | None = None,
               order: list[int] | None = None, kind: str = "user_edit_counts",
               window: WindowSpec = HOUR, sse: bool = False, by_id: bool = False) -> str:
    """Run the streaming job over the events replayed in chunks; returns the
    path of the table its sink wrote.

    Landing files, the table and the checkpoint go to a new directory under
    the shared scratch root (``spark.checkpoint.dir``).  ``progress``, when
    given, receives the progress report of every micro-batch.  ``order``
    is the delivery order of the chunks (default: time order); ``kind`` the
    count table the job maintains, over windows ``window``.  With ``sse`` the
    feed is SSE text.  With ``by_id`` a chunk is the events of one remainder of
    ``event_id``, spread over all of the time, under a watermark longer than it: most
    keys are emitted again by every chunk.
    """
    options = JobOptions(
        window=window, watermark=LONG_WATERMARK if by_id else STREAM_WATERMARK, trigger=None,
        output_mode=output_mode, namespaces=None, sse_framed=sse,
        # Update mode emits nothing in idle batches; skipping them also makes
        # each restart behave like one continuous run.
        idle_batches=output_mode == "append",
        state_partitions=STREAM_STATE_PARTITIONS,
    )
    root = scratch_dir(spark, f"stream-{output_mode}")
    landing, table, ckpt = f"{root}/landing", f"{root}/table", f"{root}/checkpoint"
    streaming = stream_session(spark, options)

    def run(_chunk: int) -> None:
        lines = read_lines_stream(streaming, f"{landing}/*")
        q = run_to_end(start_counts_job(lines, options, table, ckpt, table=kind))
        if progress is not None:
            progress.extend(q.recentProgress)

    lines = sse_lines if sse else to_wire_json
    if by_id:
        edits = edit_events(spark, sf_dir)
        replay_parts([edits.where(F.col("id").cast("bigint") % n_chunks == i) for i in range(n_chunks)], landing, run, lines)
        return table
    replay_chunks(
        lambda lo, hi: edit_events(spark, sf_dir, lo, hi),
        event_time_bounds(spark, sf_dir), landing, n_chunks, run, order, lines,
    )
    return table


def run_split_stream(spark: SparkSession, sf_dir: str, kind: str = "user_edit_counts", window: WindowSpec = HOUR,
                     n_chunks: int = STREAM_CHUNKS, progress: list | None = None) -> tuple[str, str]:
    """Replay the events, some with each fault of ``faulty_messages``, through the job with
    two outputs; returns the paths of its counts and its rejects."""
    return run_split_streams(spark, sf_dir, [(kind, window)], n_chunks, progress)[0]


def run_split_streams(spark: SparkSession, sf_dir: str, jobs: list[tuple[str, WindowSpec]], n_chunks: int = STREAM_CHUNKS,
                      progress: list | None = None) -> list[tuple[str, str]]:
    """``run_split_stream`` for several jobs ``(kind, window)`` over one feed: each chunk
    lands once, and the jobs, each with its own checkpoint and outputs, take it at the same
    time.  Returns the paths of each job's counts and rejects."""
    root = scratch_dir(spark, "stream-split")
    landing = f"{root}/landing"
    paths = [(f"{root}/{i}/table", f"{root}/{i}/rejects") for i in range(len(jobs))]
    options = [JobOptions(window=window, watermark=STREAM_WATERMARK, trigger=None, namespaces=None,
                          idle_batches=False, state_partitions=STREAM_STATE_PARTITIONS) for _, window in jobs]
    streaming = stream_session(spark, options[0])

    def run(_chunk: int) -> None:
        started = []
        try:
            for i, (kind, _) in enumerate(jobs):
                lines = read_lines_stream(streaming, f"{landing}/*")
                started.append(start_split_job(lines, options[i], *paths[i], f"{root}/{i}/checkpoint", kind))
            for q in started:
                run_to_end(q)
                if progress is not None:
                    progress.extend(q.recentProgress)
        finally:
            for q in started:
                if q.isActive:
                    q.stop()

    replay_chunks(lambda lo, hi: edit_events(spark, sf_dir, lo, hi), event_time_bounds(spark, sf_dir), landing, n_chunks, run,
                  as_lines=faulty_messages)
    return paths


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs of the user and the page table set aside, with every reason that
    a message can be rejected for."""
    jobs = [("user_edit_counts", HOUR), ("top_pages", DAY)]
    parts = []
    for (kind, _), (_, rejects) in zip(jobs, run_split_streams(spark, sf_dir, jobs)):
        parts.append(spark.read.parquet(rejects).select(F.lit(kind).alias("for_table"), "raw", "reject_reason"))
    return parts[0].unionByName(parts[1])


def stream_counts_beside_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the job with two outputs stored."""
    table, _ = run_split_stream(spark, sf_dir)
    return read_versioned(spark, table).select("window_start", "window_end", "user_name", "edit_count")


def ingested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job over the feed's SSE text in chunks: framed lines, allow-list, whole
    messages into a topic dump, read back."""
    options = JobOptions(trigger=None, namespaces=PIPELINE_NAMESPACES, sse_framed=True)
    root = scratch_dir(spark, "ingest")

    def run(_chunk: int) -> None:
        run_to_end(start_ingest_job(read_lines_stream(spark, f"{root}/landing/*"), options, f"{root}/checkpoint", f"{root}/topic"))

    replay_chunks(lambda lo, hi: edit_events(spark, sf_dir, lo, hi), event_time_bounds(spark, sf_dir), f"{root}/landing", 2, run,
                  as_lines=feed_lines)
    return read_lines(spark, f"{root}/topic")


def stream_counts(spark: SparkSession, sf_dir: str, output_mode: str,
                  n_chunks: int = STREAM_CHUNKS, progress: list | None = None) -> DataFrame:
    """Run the streaming job (``run_stream``) and return a batch read of
    what its sink holds."""
    table = run_stream(spark, sf_dir, output_mode, n_chunks, progress)
    read = read_versioned if output_mode == "update" else read_final
    return read(spark, table).select("window_start", "window_end", "user_name", "edit_count")


def stream_namespace_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job maintaining the namespace table (the documented custom
    aggregation: edits per window and namespace, same watermark), update
    mode into the versioned table, read back."""
    table = run_stream(spark, sf_dir, "update", kind="namespace_edit_counts")
    return read_versioned(spark, table, "namespace_edit_counts").select(
        "window_start", "window_end", "namespace", "edit_count")


def stream_top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job maintaining the page table over 1-day windows, then the
    most edited pages per window over what it stored."""
    table = run_stream(spark, sf_dir, "update", kind="top_pages", window=DAY)
    return dash.top_pages(read_versioned(spark, table, "top_pages"), TOP_PAGES_K)


def late_chunk_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update-mode job when chunk ``LATE_CHUNK`` arrives last, two
    batches after the chunks that follow it in event time.  By then the
    watermark (the latest event time seen, less 2 minutes) is days past
    every window of that chunk, so the job drops all of its rows: the table
    holds the counts of the other chunks only (in the hour the late chunk
    shares with the next one, only the next chunk's edits are counted)."""
    order = [i for i in range(STREAM_CHUNKS) if i != LATE_CHUNK] + [LATE_CHUNK]
    table = run_stream(spark, sf_dir, "update", order=order)
    return read_versioned(spark, table).select("window_start", "window_end", "user_name", "edit_count")


def compacted_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update-mode job's table after the maintenance job compacted the
    closed days (all but the last two days of the data at ``AS_OF``): the
    read then takes compacted days straight and only the open days through
    the latest-version aggregate."""
    table = run_stream(spark, sf_dir, "update")
    run_maintenance(spark, table, compact_through=closed_through(AS_OF), as_of=AS_OF)
    return read_versioned(spark, table).select("window_start", "window_end", "user_name", "edit_count")


def stored_counts(spark: SparkSession, sf_dir: str, since_epoch: int | None = None) -> DataFrame:
    """Backfill the hourly user table into storage, then read it back.

    The deployment shape: the dashboard reads a stored table, not the raw
    feed.  The read prunes ``window_date`` directories and pushes the
    ``window_start`` range into the Parquet scan.
    """
    path = scratch_dir(spark, "stored-user-edit-counts")
    backfill(counts(spark, sf_dir, "user_edit_counts", HOUR), path)
    return read_versioned(spark, path, "user_edit_counts", since_epoch=since_epoch)


def stored_newest(spark: SparkSession, sf_dir: str, enough: Callable[[DataFrame], bool]) -> DataFrame:
    """The newest days of the backfilled table that hold ``enough``."""
    path = scratch_dir(spark, "stored-newest")
    backfill(counts(spark, sf_dir, "user_edit_counts", HOUR), path)
    return read_newest(spark, path, enough)


def retained_stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored hourly table after the retention job at ``RETENTION_AS_OF``, inside
    a day: expired days are deleted from storage, and the boundary day is
    written again without its expired rows.  The read filters nothing."""
    path = scratch_dir(spark, "stored-retention")
    backfill(counts(spark, sf_dir, "user_edit_counts", HOUR), path)
    run_maintenance(spark, path, retention_days=RETENTION_DAYS, as_of=RETENTION_AS_OF)
    return read_versioned(spark, path).select("window_start", "window_end", "user_name", "edit_count")


def exported_recent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's CSV download of Q1, written to the shared scratch
    folder by the executors and read back with its schema."""
    q1 = wallclock(dash.recent_user_edit_counts(_recent(spark, sf_dir, RANGE_MINUTES), AS_OF, RANGE_MINUTES))
    path = export_csv(q1, scratch_dir(spark, "export"))
    return read_export(spark, path, q1.schema)


def _wiki_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire messages that carry the optional ``wiki`` field."""
    return to_wire_json(edit_events(spark, sf_dir), WIRE_FIELDS + ["wiki"])


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # --- sources and parsing -------------------------------------------
    q["sse_frames"] = lambda s, d: sse_frames(sse_capture(s, d))
    q["edits_parse"] = lambda s, d: wallclock(
        parse_edits(wire_messages(s, d)).select(
            "id", "title", "user", "type", "namespace", "timestamp", "event_time"
        )
    )
    q["edits_valid"] = lambda s, d: wallclock(
        valid_edits(_sse_parsed(s, d)).select("id", "user", "namespace", "event_time")
    )
    q["edits_rejected"] = lambda s, d: rejected_edits(_sse_parsed(s, d)).select(
        "id", "user", "reject_reason", CORRUPT_COL
    )
    q["namespace_filter"] = lambda s, d: namespace_filter(
        edit_events(s, d), PIPELINE_NAMESPACES
    ).select("id", "title", "namespace")
    q["wiki_filter"] = lambda s, d: wiki_filter(parse_edits(_wiki_wire(s, d)), PIPELINE_WIKIS).select(
        "id", "user", "wiki"
    )
    q["ingest_counters"] = lambda s, d: counters.ingest_counters(
        _sse_parsed(s, d, keep_raw=True), PIPELINE_NAMESPACES
    )

    # --- count tables ----------------------------------------------------
    q["user_edit_counts"] = lambda s, d: wallclock(counts(s, d, "user_edit_counts", HOUR))
    q["user_edit_counts_1min"] = lambda s, d: wallclock(counts(s, d, "user_edit_counts", MINUTE))
    q["user_edit_counts_1day"] = lambda s, d: wallclock(counts(s, d, "user_edit_counts", DAY))
    q["user_edit_counts_sliding"] = lambda s, d: wallclock(counts(s, d, "user_edit_counts", SLIDING))
    q["namespace_edit_counts"] = lambda s, d: wallclock(counts(s, d, "namespace_edit_counts", HOUR))
    q["page_edit_counts"] = lambda s, d: wallclock(counts(s, d, "top_pages", DAY))
    q["pipeline_user_edit_counts"] = lambda s, d: wallclock(
        count_table(namespace_filter(_sse_parsed(s, d), PIPELINE_NAMESPACES), "user_edit_counts", HOUR)
    )
    # the job's default configuration: 1-minute windows, namespace 0
    q["pipeline_user_edit_counts_1min"] = lambda s, d: wallclock(
        count_table(namespace_filter(_sse_parsed(s, d), PIPELINE_NAMESPACES), "user_edit_counts", MINUTE)
    )

    # the job's transformation with both allow-lists, run as a batch query
    q["pipeline_wiki_user_edit_counts"] = lambda s, d: wallclock(edit_counts(
        _wiki_wire(s, d),
        JobOptions(window=HOUR, trigger=None, namespaces=PIPELINE_NAMESPACES, wikis=PIPELINE_WIKIS),
    ))

    # --- streaming job (update mode + upsert; append mode) ----------------
    q["stream_user_edit_counts_latest"] = lambda s, d: wallclock(stream_counts(s, d, "update"))
    q["stream_user_edit_counts_final"] = lambda s, d: wallclock(stream_counts(s, d, "append"))
    q["stream_user_edit_counts_compacted"] = lambda s, d: wallclock(compacted_stream_counts(s, d))
    q["stream_namespace_edit_counts_latest"] = lambda s, d: wallclock(stream_namespace_counts(s, d))
    q["stream_top_pages"] = lambda s, d: wallclock(stream_top_pages(s, d))
    q["stream_user_edit_counts_late_chunk"] = lambda s, d: wallclock(late_chunk_stream_counts(s, d))

    q["stream_user_edit_counts_sse"] = lambda s, d: wallclock(read_versioned(
        s, run_stream(s, d, "update", n_chunks=2, sse=True)).select("window_start", "window_end", "user_name", "edit_count"))
    q["stream_user_edit_counts_reemitted"] = lambda s, d: wallclock(read_versioned(
        s, run_stream(s, d, "update", n_chunks=3, by_id=True)).select("window_start", "window_end", "user_name", "edit_count"))
    q["stream_rejected_edits"] = stream_rejected
    q["stream_counts_beside_rejects"] = lambda s, d: wallclock(stream_counts_beside_rejects(s, d))
    q["ingest_wire"] = ingested_messages

    # --- stored table (backfill + latest-version read) -------------------
    q["stored_user_edit_counts"] = lambda s, d: wallclock(
        stored_counts(s, d).select("window_start", "window_end", "user_name", "edit_count")
    )
    q["stored_statistics"] = lambda s, d: dash.statistics(
        stored_counts(s, d, minutes_before(AS_OF, 60)), AS_OF
    )
    q["stored_edit_timeline"] = lambda s, d: wallclock(dash.edit_timeline(
        stored_counts(s, d, minutes_before(AS_OF, RANGE_MINUTES)), AS_OF, RANGE_MINUTES
    ))
    q["stored_recent_windows"] = lambda s, d: wallclock(dash.recent_windows(stored_newest(
        s, d, lambda rows: rows.select("window_start").distinct().limit(10).count() == 10)))
    q["stored_latest_aggregations"] = lambda s, d: wallclock(dash.latest_aggregations(stored_newest(
        s, d, lambda rows: rows.limit(20).count() == 20)))
    q["stored_retention"] = lambda s, d: wallclock(retained_stored_counts(s, d))
    q["export_csv"] = exported_recent_counts
    q["stored_top_users"] = lambda s, d: dash.top_users(
        stored_counts(s, d, minutes_before(AS_OF, RANGE_MINUTES)), AS_OF, RANGE_MINUTES, 20
    )

    # --- dashboard queries and views -------------------------------------
    q["recent_user_edit_counts"] = lambda s, d: wallclock(
        dash.recent_user_edit_counts(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES)
    )
    q["top_users"] = lambda s, d: dash.top_users(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES, 20)
    q["edit_timeline"] = lambda s, d: wallclock(
        dash.edit_timeline(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES)
    )
    q["edit_timeline_desc"] = lambda s, d: wallclock(
        dash.edit_timeline(_recent(s, d, 60), AS_OF, 60, descending=True)
    )
    q["activity_timeline"] = lambda s, d: wallclock(
        dash.edit_timeline(_recent(s, d, 60), AS_OF, 60, value_name="edits")
    )
    q["statistics"] = lambda s, d: dash.statistics(_recent(s, d, 60), AS_OF)
    q["recent_windows"] = lambda s, d: wallclock(dash.recent_windows(counts(s, d)))
    q["high_volume_editors"] = lambda s, d: wallclock(
        dash.high_volume_editors(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES)
    )
    q["recent_user_activity"] = lambda s, d: wallclock(
        dash.recent_user_activity(_recent(s, d, 24 * 60), AS_OF)
    )
    q["top_contributors_hourly"] = lambda s, d: dash.top_contributors_hourly(_recent(s, d, 60), AS_OF)
    q["total_edits_last_hour"] = lambda s, d: dash.total_edits(_recent(s, d, 60), AS_OF, 60)
    q["top_contributors_today"] = lambda s, d: dash.top_contributors_today(
        counts(s, d, "user_edit_counts", HOUR, start_of_day(TODAY_AS_OF)), TODAY_AS_OF
    )
    q["latest_aggregations"] = lambda s, d: wallclock(dash.latest_aggregations(counts(s, d)))
    q["latest_aggregations_sample"] = lambda s, d: wallclock(
        dash.latest_aggregations(counts(s, d), dash.SAMPLE_LIMIT, dash.SAMPLE_COLUMNS)
    )
    q["row_count"] = lambda s, d: dash.row_count(counts(s, d))
    q["top_pages"] = lambda s, d: wallclock(dash.top_pages(counts(s, d, "top_pages", DAY), TOP_PAGES_K))
    # rows in their order, numbered: a wrong order is a wrong number
    q["ordered_edit_timeline_desc"] = lambda s, d: wallclock(dash.numbered(
        dash.edit_timeline(_recent(s, d, 24 * 60), AS_OF, 24 * 60, descending=True)))
    q["ordered_edit_timeline"] = lambda s, d: wallclock(dash.numbered(
        dash.edit_timeline(_recent(s, d, 24 * 60), AS_OF, 24 * 60)))
    q["ordered_recent_user_edit_counts"] = lambda s, d: wallclock(dash.numbered(
        dash.recent_user_edit_counts(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES)))
    q["ordered_recent_user_activity"] = lambda s, d: wallclock(dash.numbered(
        dash.recent_user_activity(_recent(s, d, 24 * 60), AS_OF)))
    q["ordered_top_users"] = lambda s, d: dash.numbered(
        dash.top_users(_recent(s, d, RANGE_MINUTES), AS_OF, RANGE_MINUTES, 20))
    q["retention_keep"] = lambda s, d: wallclock(
        dash.retention_keep(_recent(s, d, RETENTION_DAYS * 24 * 60), AS_OF, RETENTION_DAYS)
    )
    return q


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

_EDITS = """edits AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         'Page_' || CAST(k AS VARCHAR) AS title,
         'user_' || CAST(user_id AS VARCHAR) AS "user",
         event_type AS type,
         k % 4 AS namespace,
         ['enwiki', 'dewiki', 'frwiki'][user_id % 3 + 1] AS wiki,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS "timestamp",
         date_trunc('second', ts) AS event_time
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
)"""

_WIRE = """wire AS (
  SELECT *, CAST(to_json({'id': id, 'title': title, 'user': "user", 'type': type,
                          'namespace': namespace, 'timestamp': "timestamp"}) AS VARCHAR) AS clean_json,
         CAST(to_json({'id': id, 'title': title, 'user': "user", 'type': type,
                       'namespace': namespace, 'timestamp': CAST("timestamp" AS VARCHAR)}) AS VARCHAR) AS drift_json
  FROM edits
)"""


def _sql_ts(value) -> str:
    import datetime as dt

    t = dt.datetime.fromtimestamp(epoch_seconds(value), dt.timezone.utc).replace(tzinfo=None)
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _counts_cte(name: str, key_expr: str, key: str, window: WindowSpec, where: str = "") -> str:
    if window.slide is None:
        dur = window.duration
        return f"""{name} AS (
  SELECT time_bucket(INTERVAL '{dur}', event_time) AS window_start,
         time_bucket(INTERVAL '{dur}', event_time) + INTERVAL '{dur}' AS window_end,
         {key_expr} AS {key}, count(*) AS edit_count
  FROM edits {where}
  GROUP BY 1, 2, 3
)"""
    n = window.seconds // window.step_seconds
    return f"""{name} AS (
  SELECT b - s * INTERVAL '{window.slide}' AS window_start,
         b - s * INTERVAL '{window.slide}' + INTERVAL '{window.duration}' AS window_end,
         {key_expr} AS {key}, count(*) AS edit_count
  FROM (SELECT *, time_bucket(INTERVAL '{window.slide}', event_time) AS b FROM edits {where}) x,
       range({n}) r(s)
  GROUP BY 1, 2, 3
)"""


def _uec(window: WindowSpec = HOUR, where: str = "") -> str:
    return _counts_cte("uec", '"user"', "user_name", window, where)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _since(minutes: int, as_of=AS_OF) -> str:
    return f"window_start >= {_sql_ts(AS_OF if as_of is None else as_of)} - INTERVAL '{minutes} minutes'"


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    W = _with(_EDITS)
    WU = _with(_EDITS, _uec())
    ok_time = "type <> 'error'"  # the drifted SSE frames lose their time

    o["sse_frames"] = _with(_EDITS, _WIRE) + (
        "SELECT CASE WHEN type = 'error' THEN drift_json ELSE clean_json END AS value FROM wire"
    )
    o["edits_parse"] = W + (
        'SELECT id, title, "user", type, namespace, "timestamp", event_time FROM edits'
    )
    o["edits_valid"] = W + f'SELECT id, "user", namespace, event_time FROM edits WHERE {ok_time}'
    o["edits_rejected"] = _with(_EDITS, _WIRE) + (
        "SELECT id, \"user\", 'null_timestamp' AS reject_reason, drift_json AS _corrupt_record "
        "FROM wire WHERE type = 'error'"
    )
    o["namespace_filter"] = W + "SELECT id, title, namespace FROM edits WHERE namespace IN (0)"
    o["wiki_filter"] = _with(_EDITS) + (
        "SELECT id, \"user\", wiki FROM edits WHERE wiki IN ('enwiki', 'dewiki')"
    )
    o["ingest_counters"] = W + (
        "SELECT count(*) AS events_seen, count(*) FILTER (WHERE namespace IN (0)) AS events_sent FROM edits"
    )

    o["user_edit_counts"] = WU + "SELECT * FROM uec"
    o["user_edit_counts_1min"] = _with(_EDITS, _uec(MINUTE)) + "SELECT * FROM uec"
    o["user_edit_counts_1day"] = _with(_EDITS, _uec(DAY)) + "SELECT * FROM uec"
    o["user_edit_counts_sliding"] = _with(_EDITS, _uec(SLIDING)) + "SELECT * FROM uec"
    o["namespace_edit_counts"] = _with(
        _EDITS, _counts_cte("nec", "namespace", "namespace", HOUR)
    ) + "SELECT * FROM nec"
    o["page_edit_counts"] = _with(
        _EDITS, _counts_cte("pec", "title", "page_title", DAY)
    ) + "SELECT * FROM pec"
    o["pipeline_user_edit_counts"] = _with(
        _EDITS, _uec(HOUR, f"WHERE namespace IN (0) AND {ok_time}")
    ) + "SELECT * FROM uec"
    o["pipeline_user_edit_counts_1min"] = _with(
        _EDITS, _uec(MINUTE, f"WHERE namespace IN (0) AND {ok_time}")
    ) + "SELECT * FROM uec"

    o["pipeline_wiki_user_edit_counts"] = _with(
        _EDITS, _uec(HOUR, "WHERE namespace IN (0) AND wiki IN ('enwiki', 'dewiki')")
    ) + "SELECT * FROM uec"

    o["stream_user_edit_counts_latest"] = WU + "SELECT * FROM uec"
    o["stream_user_edit_counts_compacted"] = WU + "SELECT * FROM uec"
    o["stream_namespace_edit_counts_latest"] = o["namespace_edit_counts"]
    # chunk edges as in the replay: lo + i * ceil((hi - lo + 1) / n)
    o["stream_user_edit_counts_late_chunk"] = _with(
        _EDITS,
        "bounds AS (SELECT min(\"timestamp\") AS lo, "
        f"CAST(ceil((max(\"timestamp\") - min(\"timestamp\") + 1) / {STREAM_CHUNKS}) AS BIGINT) AS step "
        "FROM edits)",
        "on_time AS (SELECT e.* FROM edits e, bounds b WHERE NOT (\"timestamp\" >= "
        f"b.lo + {LATE_CHUNK} * b.step AND \"timestamp\" < b.lo + {LATE_CHUNK + 1} * b.step))",
        _counts_cte("uec", '"user"', "user_name", HOUR).replace("FROM edits", "FROM on_time"),
    ) + "SELECT * FROM uec"
    o["stream_user_edit_counts_sse"] = _with(_EDITS, _uec(HOUR, f"WHERE {ok_time}")) + "SELECT * FROM uec"
    o["stream_user_edit_counts_reemitted"] = WU + "SELECT * FROM uec"
    fault = lambda name: str(FAULTS.index(name))
    faulty = f"""faulty AS (
  SELECT *, CASE f WHEN {fault("cut off")} THEN 'cut off: ' || id ELSE CAST(to_json({{'id': id, 'title': shown_title, 'user': shown_user, 'type': type,
     'namespace': namespace, 'timestamp': CASE f WHEN {fault("timestamp overflows")} THEN {NO_SECOND} WHEN {fault("timestamp in the year 3000")} THEN {FAR_SECOND}
       WHEN {fault("no timestamp")} THEN NULL ELSE "timestamp" END}}) AS VARCHAR) END AS plain,
     CAST(to_json({{'id': id, 'title': title, 'user': "user", 'type': type, 'namespace': namespace, 'timestamp': CAST("timestamp" AS VARCHAR)}}) AS VARCHAR) AS drift
  FROM (SELECT *, CASE f WHEN {fault("no title")} THEN NULL WHEN {fault("title too long")} THEN repeat('t', 501) ELSE title END AS shown_title,
    CASE f WHEN {fault("no user")} THEN NULL WHEN {fault("user too long")} THEN repeat('u', 256) ELSE "user" END AS shown_user
    FROM (SELECT *, CAST(id AS BIGINT) % {FAULT_CYCLE} AS f FROM edits))
)"""
    early = f"""WHEN {fault("cut off")} THEN 'not_json' WHEN {fault("no timestamp")} THEN 'null_timestamp' WHEN {fault("timestamp as text")} THEN 'null_timestamp'
  WHEN {fault("timestamp overflows")} THEN 'timestamp_out_of_range' WHEN {fault("timestamp in the year 3000")} THEN 'timestamp_in_future'"""
    message = f"CASE f WHEN {fault('timestamp as text')} THEN drift ELSE plain END AS raw"
    o["stream_rejected_edits"] = _with(_EDITS, faulty) + f"""
SELECT * FROM (SELECT 'user_edit_counts' AS for_table, {message}, CASE f {early} WHEN {fault("no user")} THEN 'null_user' WHEN {fault("user too long")} THEN 'user_too_long' END AS reject_reason FROM faulty
  UNION ALL SELECT 'top_pages', {message}, CASE f {early} WHEN {fault("no title")} THEN 'null_title' WHEN {fault("title too long")} THEN 'title_too_long' END FROM faulty)
WHERE reject_reason IS NOT NULL"""
    counted = f'WHERE CAST(id AS BIGINT) % {FAULT_CYCLE} NOT IN ({", ".join(map(fault, FAULTS[:FAULTS.index("no title")]))})'
    o["stream_counts_beside_rejects"] = _with(_EDITS, _uec(HOUR, counted)) + "SELECT * FROM uec"
    o["ingest_wire"] = W + """SELECT CAST(to_json({'id': id, 'title': title, 'user': "user", 'type': type, 'namespace': namespace, 'timestamp': "timestamp", 'wiki': wiki,
  'bot': CAST(id AS BIGINT) % 2 = 0, 'meta': {'id': 'evt-' || id, 'domain': 'example'}}) AS VARCHAR) AS value FROM edits WHERE namespace IN (0)"""
    o["stream_user_edit_counts_final"] = WU + (
        "SELECT * FROM uec WHERE window_end <= "
        f"(SELECT max(event_time) FROM edits) - INTERVAL '{STREAM_WATERMARK}'"
    )

    o["stored_user_edit_counts"] = WU + "SELECT * FROM uec"
    o["stored_retention"] = WU + (
        "SELECT * FROM uec "
        f"WHERE window_start >= {_sql_ts(RETENTION_AS_OF)} - INTERVAL '{RETENTION_DAYS} days'"
    )

    r = RANGE_MINUTES

    def numbered(columns: str, order: str, rows: str) -> str:
        return WU + f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position, {columns} FROM ({rows})"

    timeline = f"SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(24 * 60)} GROUP BY window_start"
    o["ordered_edit_timeline_desc"] = numbered("window_start, total_edits", "window_start DESC", timeline)
    o["ordered_edit_timeline"] = numbered("window_start, total_edits", "window_start", timeline)
    o["ordered_recent_user_edit_counts"] = numbered(
        "window_start, window_end, user_name, edit_count", "window_start DESC, edit_count DESC, user_name", f"SELECT * FROM uec WHERE {_since(r)}")
    o["ordered_recent_user_activity"] = numbered(
        "window_start, user_name, edit_count", "window_start DESC, user_name", f"SELECT * FROM uec WHERE {_since(24 * 60)}")
    o["ordered_top_users"] = numbered(
        "user_name, total_edits", "total_edits DESC, user_name",
        f"SELECT user_name, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(r)} GROUP BY user_name ORDER BY total_edits DESC, user_name LIMIT 20")
    o["stored_top_users"] = WU + (
        f"SELECT user_name, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(r)} "
        "GROUP BY user_name ORDER BY total_edits DESC, user_name LIMIT 20"
    )
    o["recent_user_edit_counts"] = WU + (
        f"SELECT window_start, window_end, user_name, edit_count FROM uec WHERE {_since(r)} "
        "ORDER BY window_start DESC, edit_count DESC, user_name"
    )
    o["export_csv"] = o["recent_user_edit_counts"]
    o["top_users"] = WU + (
        f"SELECT user_name, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(r)} "
        "GROUP BY user_name ORDER BY total_edits DESC, user_name LIMIT 20"
    )
    o["edit_timeline"] = WU + (
        f"SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(r)} "
        "GROUP BY window_start ORDER BY window_start"
    )
    o["edit_timeline_desc"] = WU + (
        f"SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(60)} "
        "GROUP BY window_start ORDER BY window_start DESC"
    )
    o["activity_timeline"] = WU + (
        f"SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS edits FROM uec WHERE {_since(60)} "
        "GROUP BY window_start ORDER BY window_start"
    )
    o["statistics"] = WU + (
        "SELECT count(DISTINCT user_name) AS unique_users, CAST(sum(edit_count) AS BIGINT) AS total_edits, "
        "avg(edit_count) AS avg_edits_per_window, max(edit_count) AS max_edits_single_window "
        f"FROM uec WHERE {_since(60)}"
    )
    o["recent_windows"] = WU + (
        "SELECT DISTINCT window_start, window_end FROM uec ORDER BY window_start DESC LIMIT 10"
    )
    o["high_volume_editors"] = WU + (
        f"SELECT user_name, edit_count, window_start FROM uec WHERE {_since(r)} "
        "ORDER BY edit_count DESC, window_start DESC, user_name LIMIT 10"
    )
    o["recent_user_activity"] = WU + (
        f"SELECT window_start, user_name, edit_count FROM uec WHERE {_since(24 * 60)} "
        "ORDER BY window_start DESC, user_name"
    )
    o["top_contributors_hourly"] = WU + (
        f"SELECT user_name, CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(60)} "
        "GROUP BY user_name ORDER BY total_edits DESC, user_name LIMIT 50"
    )
    o["total_edits_last_hour"] = WU + (
        f"SELECT CAST(sum(edit_count) AS BIGINT) AS total_edits FROM uec WHERE {_since(60)}"
    )
    o["top_contributors_today"] = WU + (
        "SELECT user_name, CAST(sum(edit_count) AS BIGINT) AS total FROM uec "
        f"WHERE window_start >= date_trunc('day', {_sql_ts(TODAY_AS_OF)}) "
        "GROUP BY user_name ORDER BY total DESC, user_name LIMIT 10"
    )
    o["latest_aggregations"] = WU + (
        "SELECT window_start, window_end, user_name, edit_count FROM uec "
        "ORDER BY window_start DESC, user_name LIMIT 20"
    )
    o["latest_aggregations_sample"] = WU + (
        "SELECT window_start, user_name, edit_count FROM uec "
        "ORDER BY window_start DESC, user_name LIMIT 10"
    )
    o["row_count"] = WU + "SELECT count(*) AS row_count FROM uec"
    o["top_pages"] = _with(_EDITS, _counts_cte("pec", "title", "page_title", DAY)) + (
        "SELECT window_start, window_end, page_title, edit_count, CAST(page_rank AS INTEGER) AS page_rank "
        "FROM (SELECT *, row_number() OVER (PARTITION BY window_start "
        "ORDER BY edit_count DESC, page_title) AS page_rank FROM pec) t "
        f"WHERE page_rank <= {TOP_PAGES_K}"
    )
    o["stream_top_pages"] = o["top_pages"]
    o["stored_recent_windows"] = o["recent_windows"]
    o["stored_latest_aggregations"] = o["latest_aggregations"]
    o["stored_statistics"] = o["statistics"]
    o["stored_edit_timeline"] = o["edit_timeline"]
    o["retention_keep"] = WU + (
        "SELECT window_start, window_end, user_name, edit_count FROM uec "
        f"WHERE window_start >= {_sql_ts(AS_OF)} - INTERVAL '{RETENTION_DAYS} days'"
    )
    return o


def queries() -> dict[str, Query]:
    return _queries()


def oracle_sql() -> dict[str, str]:
    return _oracle()
