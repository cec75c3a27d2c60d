"""Streaming job tests: per-batch emissions, late data, restart, replay."""

import json
import os
import time

from pyspark.sql import functions as F

from collected import rows
from editpulse.config import JobOptions, WindowSpec
from editpulse.sources.counts import read_final, read_versioned
from editpulse.streaming.job import read_lines_stream, run_to_end, start_counts_job
from editpulse.sinks.versioned import write_version

B = 1700000040

# Fixed test script (1-minute window, 2-minute watermark, one file per batch).
SCRIPT = [
    [("a", B + 1), ("b", B + 2)],
    [("a", B + 30)],
    [("c", B + 300)],
    [("a", B + 40), ("c", B + 301)],
    [("a", B + 41), ("c", B + 302)],
]

# In-order script: nothing is behind the watermark; key (0, a) is re-emitted
# in three consecutive batches.
IN_ORDER = [
    [("a", B + 1), ("b", B + 2)],
    [("a", B + 30)],
    [("a", B + 50), ("c", B + 70)],
    [("c", B + 100), ("a", B + 130)],
    [("b", B + 200)],
]

OPTS = JobOptions(window=WindowSpec("1 minute"), watermark="2 minutes", trigger=None,
                  namespaces=None, max_files_per_trigger=1)


def _local(path):
    return path.replace("file://", "").replace("file:", "")


def land(directory, files, start_index=0):
    os.makedirs(_local(directory), exist_ok=True)
    base = time.time() - 1000
    for i, events in enumerate(files, start=start_index):
        p = os.path.join(_local(directory), f"f{i:03d}.json")
        with open(p, "w") as fh:
            for j, (u, s) in enumerate(events):
                fh.write(json.dumps({"id": f"{i}-{j}", "title": "P", "user": u, "type": "edit",
                                     "namespace": 0, "timestamp": s}) + "\n")
        os.utime(p, (base + i, base + i))


def run(spark, landing, table, ckpt, mode="update", max_files=1):
    opts = JobOptions(window=OPTS.window, watermark=OPTS.watermark, trigger=None,
                      namespaces=None, output_mode=mode)
    q = start_counts_job(read_lines_stream(spark, landing, max_files), opts, table, ckpt)
    run_to_end(q)
    return q


def raw_versions(spark, table):
    df = spark.read.parquet(f"{table}/versions")
    return rows(df.select(F.col("batch_id"),
                          (F.unix_seconds("window_start") - B).alias("off"),
                          "user_name", "edit_count"))


def test_update_mode_per_batch_and_late_drop(spark, scratch):
    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, SCRIPT)
    q = run(spark, landing, table, ckpt)
    from editpulse.sinks.versioned import glob_paths
    # the trailing no-data batch left no empty version behind
    assert len(glob_paths(spark, f"{table}/versions/batch_id=*")) == 5
    assert raw_versions(spark, table) == [
        (0, 0, "a", 1), (0, 0, "b", 1), (1, 0, "a", 2), (2, 300, "c", 1),
        (3, 0, "a", 3), (3, 300, "c", 2), (4, 300, "c", 3)]
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    latest = read_versioned(spark, table)
    assert rows(latest.select((F.unix_seconds("window_start") - B).alias("o"), "user_name",
                              "edit_count")) == [(0, "a", 3), (0, "b", 1), (300, "c", 3)]


def test_observed_ingest_counters(spark, scratch):
    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, SCRIPT[:2])
    q = run(spark, landing, table, ckpt)
    seen = [p["observedMetrics"]["ingest"] for p in q.recentProgress
            if p.get("observedMetrics", {}).get("ingest")]
    assert sum(int(m["events_seen"]) for m in seen) == 3
    assert sum(int(m["events_sent"]) for m in seen) == 3


def test_append_mode_emits_closed_windows_once(spark, scratch):
    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, SCRIPT)
    run(spark, landing, table, ckpt, mode="append")
    out = read_final(spark, table)
    assert rows(out.select((F.unix_seconds("window_start") - B).alias("o"), "user_name",
                           "edit_count")) == [(0, "a", 3), (0, "b", 1)]


def test_restart_equals_single_run(spark, scratch):
    """With no late rows, stop + restart on the checkpoint equals one run,
    and the latest view equals the batch aggregate."""
    one = (f"{scratch}/in1", f"{scratch}/t1", f"{scratch}/ck1")
    two = (f"{scratch}/in2", f"{scratch}/t2", f"{scratch}/ck2")
    land(one[0], IN_ORDER)
    run(spark, *one)
    land(two[0], IN_ORDER[:3])
    run(spark, *two)
    land(two[0], IN_ORDER[3:], start_index=3)
    run(spark, *two)
    latest = lambda t: rows(read_versioned(spark, t).drop("created_at"))
    assert latest(one[1]) == latest(two[1])
    versions = spark.read.parquet(f"{one[1]}/versions").where("user_name = 'a' AND unix_seconds(window_start) = %d" % B)
    assert sorted(r.edit_count for r in versions.collect()) == [1, 2, 3]
    # the same transformation over a batch read of the same files
    from editpulse.sources.text import read_lines
    from editpulse.streaming.job import edit_counts
    batch = edit_counts(read_lines(spark, one[0]), OPTS, observe=True)
    assert latest(one[1]) == rows(batch)


def test_restart_drops_rows_behind_the_watermark(spark, scratch):
    """A finished availableNow run advances the watermark with a trailing
    no-data batch: after a restart, a row behind it is dropped, although a
    continuous run (whose late-row filter lags one batch) accepted it."""
    two = (f"{scratch}/in2", f"{scratch}/t2", f"{scratch}/ck2")
    land(two[0], SCRIPT[:3])
    run(spark, *two)
    land(two[0], SCRIPT[3:], start_index=3)
    q = run(spark, *two)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 2
    got = read_versioned(spark, two[1]).where("user_name = 'a'").first()
    assert got.edit_count == 2


def test_replayed_batch_changes_nothing(spark, scratch):
    table = f"{scratch}/t"
    df = spark.createDataFrame(
        [(B, B + 60, "a", 2)], "s long, e long, user_name string, edit_count long"
    ).select(F.timestamp_seconds("s").alias("window_start"),
             F.timestamp_seconds("e").alias("window_end"), "user_name", "edit_count")
    write_version(df, table, 7)
    write_version(df, table, 7)
    assert spark.read.parquet(f"{table}/versions").count() == 1
    assert read_versioned(spark, table).count() == 1


def test_out_of_order_input_breaks_equality(spark, scratch):
    """Negative control: late files lose rows to the watermark."""
    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    shuffled = [SCRIPT[2], SCRIPT[4], SCRIPT[0], SCRIPT[1], SCRIPT[3]]
    land(landing, shuffled)
    q = run(spark, landing, table, ckpt)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped > 0
    total = read_versioned(spark, table).agg(F.sum("edit_count")).first()[0]
    assert total < sum(len(f) for f in SCRIPT)


def test_compaction_keeps_the_view_and_folds_versions(spark, scratch):
    import datetime as dt

    from editpulse.sinks.versioned import compact, glob_paths

    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, IN_ORDER)
    run(spark, landing, table, ckpt)
    before = rows(read_versioned(spark, table).drop("created_at"))
    day = dt.datetime.fromtimestamp(B, dt.timezone.utc).date()
    assert compact(spark, table, day) == [day]
    # folded versions stay for readers already open; the next run deletes them
    assert len(glob_paths(spark, f"{table}/versions/*/window_date=*")) == len(glob_paths(spark, f"{table}/versions/*/window_date=*/_folded")) > 0
    assert compact(spark, table, day) == []
    assert glob_paths(spark, f"{table}/versions/*/window_date=*") == []
    assert len(glob_paths(spark, f"{table}/versions/batch_id=*")) <= 1
    assert rows(read_versioned(spark, table).drop("created_at")) == before
    assert spark.read.parquet(f"{table}/compacted").count() == len(before)
    # a later version of a compacted key still wins; compacting again folds it
    extra = read_versioned(spark, table).where("user_name = 'a'").limit(1).select(
        "window_start", "window_end", "user_name", (F.col("edit_count") + 10).alias("edit_count"))
    write_version(extra.checkpoint(), table, 99)
    got = read_versioned(spark, table).where("user_name = 'a'").agg(F.max("edit_count")).first()[0]
    assert got >= 13
    assert compact(spark, table, day) == [day]
    assert rows(read_versioned(spark, table).drop("created_at")) != before
    assert spark.read.parquet(f"{table}/compacted").count() == len(before)


def test_cli_runs_available_now(spark, scratch):
    from editpulse.streaming.__main__ import main, options_from, parse_args

    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, IN_ORDER)
    args = ["--input", landing, "--output", table, "--checkpoint", ckpt, "--available-now",
            "--state-partitions", "4", "--no-idle-batches",
            "--all-namespaces", "--window", "1 minute"]
    assert options_from(parse_args(args)).trigger is None
    main(args)
    assert read_versioned(spark, table).agg(F.sum("edit_count")).first()[0] == 8


def test_continuous_trigger_rejected():
    import pytest

    with pytest.raises(ValueError):
        JobOptions(trigger="continuous 1 second")


def test_namespace_and_page_tables_stream(spark, scratch):
    landing = f"{scratch}/in"
    land(landing, IN_ORDER)
    for table, key in (("namespace_edit_counts", "namespace"), ("top_pages", "page_title")):
        out, ckpt = f"{scratch}/{table}", f"{scratch}/ck-{table}"
        opts = JobOptions(window=WindowSpec("1 hour"), watermark="2 minutes", trigger=None,
                          namespaces=None)
        run_to_end(start_counts_job(read_lines_stream(spark, landing, 1), opts, out, ckpt, table))
        got = rows(read_versioned(spark, out, table).select(key, "edit_count"))
        assert got == [(0 if key == "namespace" else "P", 8)]


def test_ingest_log_listener(spark, scratch):
    from editpulse.streaming.monitor import IngestLogListener

    landing, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    land(landing, IN_ORDER)
    listener = IngestLogListener(every=3)
    spark.streams.addListener(listener)
    try:
        run(spark, landing, table, ckpt)
        deadline = time.time() + 20
        while listener.sent < 8 and time.time() < deadline:
            time.sleep(0.2)  # progress events are delivered asynchronously
    finally:
        spark.streams.removeListener(listener)
    assert (listener.seen, listener.sent) == (8, 8)
    assert listener.lines and listener.lines[0].startswith("seen=")


def test_without_idle_batches_restart_equals_continuous_run(spark, scratch):
    """Skipping idle batches keeps update-mode output and makes a restart
    behave like one continuous run, late rows included."""
    from editpulse.streaming.job import stream_session

    opts = JobOptions(window=WindowSpec("1 minute"), watermark="2 minutes", trigger=None,
                      namespaces=None, idle_batches=False)
    session = stream_session(spark, opts)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"

    def go(landing, table, ckpt):
        run_to_end(start_counts_job(read_lines_stream(session, landing, 1), opts, table, ckpt))

    one = (f"{scratch}/in1", f"{scratch}/t1", f"{scratch}/ck1")
    two = (f"{scratch}/in2", f"{scratch}/t2", f"{scratch}/ck2")
    land(one[0], SCRIPT)
    go(*one)
    assert raw_versions(spark, one[1]) == [
        (0, 0, "a", 1), (0, 0, "b", 1), (1, 0, "a", 2), (2, 300, "c", 1),
        (3, 0, "a", 3), (3, 300, "c", 2), (4, 300, "c", 3)]
    land(two[0], SCRIPT[:3])
    go(*two)
    land(two[0], SCRIPT[3:], start_index=3)
    go(*two)
    latest = lambda t: rows(read_versioned(spark, t).drop("created_at"))
    assert latest(one[1]) == latest(two[1])


def test_append_mode_needs_idle_batches():
    import pytest

    with pytest.raises(ValueError):
        JobOptions(output_mode="append", idle_batches=False)


def test_late_chunk_is_dropped_by_the_watermark(spark):
    """Replay of the driver's events with one chunk delivered last: the job
    drops rows of it (metric) and the table holds no row of its hours that
    no other chunk touches."""
    from editpulse.plans import registry
    from editpulse.sources.testdata import edit_events, event_time_bounds
    from editpulse.streaming.replay import chunk_edges

    sf = "/root/testdata/sf0.001"
    late = registry.LATE_CHUNK
    order = [i for i in range(registry.STREAM_CHUNKS) if i != late] + [late]
    progress = []
    table = registry.run_stream(spark, sf, "update", progress=progress, order=order)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in progress for op in p.get("stateOperators", []))
    assert dropped > 0
    lo, hi = chunk_edges(*event_time_bounds(spark, sf), registry.STREAM_CHUNKS)[late:late + 2]
    late_hours = {r[0] for r in edit_events(spark, sf, lo, hi)
                  .select(F.date_trunc("hour", "event_time")).distinct().collect()}
    other_hours = {r[0] for r in edit_events(spark, sf).where(
        (F.unix_timestamp("event_time") < lo) | (F.unix_timestamp("event_time") >= hi))
        .select(F.date_trunc("hour", "event_time")).distinct().collect()}
    stored = {r[0] for r in read_versioned(spark, table).select("window_start").distinct().collect()}
    assert late_hours - other_hours
    assert not (stored & (late_hours - other_hours))


def test_registry_compaction_folds_closed_days(spark):
    """The compacted-stream query's table: closed days live only in
    ``compacted/``, open days still in ``versions/``, and the read equals
    the batch counts."""
    import datetime as dt

    from editpulse.maintenance import closed_through
    from editpulse.maintenance import run as run_maintenance
    from editpulse.plans import registry
    from editpulse.sinks.versioned import COMPACTED, VERSIONS, day_of, glob_paths

    sf = "/root/testdata/sf0.001"
    table = registry.run_stream(spark, sf, "update")
    through = closed_through(registry.AS_OF)
    for _ in range(2):  # the second run deletes what the first has folded
        run_maintenance(spark, table, compact_through=through, as_of=registry.AS_OF)
    version_days = {day_of(p) for p in glob_paths(spark, f"{table}/{VERSIONS}/batch_id=*/window_date=*")}
    compacted_days = {day_of(p) for p in glob_paths(spark, f"{table}/{COMPACTED}/window_date=*")}
    assert compacted_days and max(compacted_days) <= through
    assert version_days and min(version_days) > through
    assert through == dt.date(2024, 1, 29)
    got = read_versioned(spark, table).select("window_start", "user_name", "edit_count")
    want = registry.counts(spark, sf).select("window_start", "user_name", "edit_count")
    assert rows(got) == rows(want)
