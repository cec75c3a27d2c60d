"""Messages that must not stop or silence the job, and storage that must not
lose rows."""

import datetime as dt

import pytest
from collected import rows
from pyspark.sql import functions as F

from editpulse import session as sessions
from editpulse.config import JobOptions, WindowSpec
from editpulse.functions.parse import namespace_filter, parse_edits, rejected_edits, wiki_filter
from editpulse.operators.retention import drop_expired_rows
from editpulse.sinks import versioned
from editpulse.sources.counts import read_newest, read_versioned
from editpulse.sources.kafka import publishable
from editpulse.sources.text import read_lines_stream
from editpulse.streaming.job import run_to_end, start_counts_job, start_rejects_job, stream_session

B = 1_700_000_040
MESSAGE = '{"id":"%s","title":"T","user":%s,"type":"edit","namespace":0,"timestamp":%s,"wiki":"enwiki","extra":7}'
BAD = {
    MESSAGE % ("o", '"a"', 9223372036854775807): "timestamp_out_of_range",
    MESSAGE % ("m", '"a"', B * 100): "timestamp_in_future",
    MESSAGE % ("s", '"a"', f'"{B}"'): "null_timestamp",
    MESSAGE % ("u", "null", B): "null_user",
    MESSAGE % ("l", '"' + "x" * 256 + '"', B): "user_too_long",
    "not json": "not_json",
}


def test_bad_messages_are_counted_and_kept_and_stop_nothing(spark, scratch):
    landing = f"{scratch}/in"
    options = JobOptions(window=WindowSpec("1 minute"), trigger=None, max_future_skew="1 hour", max_files_per_trigger=1, idle_batches=False)
    streaming = stream_session(spark, options)
    total, reported = 0, []
    for i, batch in enumerate([list(BAD), [MESSAGE % (k, '"b"', B + 60 * k) for k in range(3)]]):
        spark.createDataFrame([(m,) for m in batch], "value string").coalesce(1).write.mode("append").text(landing)
        q = run_to_end(start_counts_job(read_lines_stream(streaming, landing), options, f"{scratch}/t", f"{scratch}/ck"))
        reported += [p["observedMetrics"]["ingest"] for p in q.recentProgress if p.get("numInputRows")]
        total += len(batch)
        run_to_end(start_rejects_job(read_lines_stream(streaming, landing), options, f"{scratch}/bad", f"{scratch}/ck-bad"))
    stored = rows(read_versioned(spark, f"{scratch}/t"), "user_name", "edit_count")
    assert stored == [("b", 1)] * 3
    assert dict(rows(spark.read.parquet(f"{scratch}/bad"), "raw", "reject_reason")) == BAD
    assert sum(r["messages"] for r in reported) == total == sum(r["rejected"] for r in reported) + 3


def test_the_running_query_has_the_job_settings(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "77m")
    try:
        s = stream_session(spark, JobOptions(state_store="rocksdb", state_partitions=3))
        assert s.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
        assert s.conf.get("spark.sql.shuffle.partitions") == "3" and s.conf.get("spark.sql.files.maxPartitionBytes") == "77m"
        assert spark.conf.get("spark.sql.shuffle.partitions") != "3"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_published_messages_keep_all_fields(spark):
    sent = MESSAGE % ("1", '"a"', B)
    edits = namespace_filter(parse_edits(spark.createDataFrame([(sent,)], "value string"), keep_raw=True), [0])
    out = publishable(edits)
    assert rows(out) == [(sent,)] and wiki_filter(parse_edits(out), ["enwiki"]).count() == 1


def test_reasons_without_a_corrupt_column(spark):
    edits = parse_edits(spark.createDataFrame([(m,) for m in BAD], "value string")).drop("_corrupt_record")
    assert rejected_edits(edits).count() == 5  # the one in milliseconds is a time, if a late one


def counts_of(spark, seconds):
    return spark.createDataFrame([(s, f"u{i}", 1) for i, s in enumerate(seconds)], "s long, user_name string, edit_count long").select(
        F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds(F.col("s") + 60).alias("window_end"), "user_name", "edit_count")


def test_retention_removes_the_rows_of_the_boundary_day(spark, scratch):
    day = B - B % 86400
    table = f"{scratch}/t"
    versioned.write_version(counts_of(spark, [day, day + 3600, day + 7200, day + 86400]), table, 0)
    assert drop_expired_rows(spark, table, day + 3600 + 86400, 1)
    assert rows(read_versioned(spark, table), "user_name") == [("u1",), ("u2",), ("u3",)]
    assert drop_expired_rows(spark, table, day + 86399 + 86400, 1)
    assert rows(read_versioned(spark, table), "user_name") == [("u3",)]


def test_an_emptied_table_reads_as_empty(spark, scratch):
    table = f"{scratch}/t"
    versioned.write_version(counts_of(spark, [B]), table, 0)
    for p in versioned.glob_paths(spark, f"{table}/versions/*/window_date=*"):
        versioned.delete_path(spark, p)
    assert read_versioned(spark, table).count() == 0


def test_compaction_loses_nothing_if_staged_rows_are_gone(spark, scratch, monkeypatch):
    table = f"{scratch}/t"
    versioned.write_version(counts_of(spark, [B, B + 60, B + 120]), table, 0)
    day = dt.datetime.fromtimestamp(B, dt.timezone.utc).date()
    reader = read_versioned(spark, table)
    write = spark.createDataFrame([], "x int").write.__class__.parquet

    def lossy(self, path, *a, **k):
        write(self, path, *a, **k)
        if "_staging" in path:
            for p in versioned.glob_paths(spark, f"{path}/part-*"):
                versioned.delete_path(spark, p)

    with monkeypatch.context() as m:
        m.setattr(spark.createDataFrame([], "x int").write.__class__, "parquet", lossy)
        with pytest.raises(RuntimeError):
            versioned.compact(spark, table, day)
    assert read_versioned(spark, table).count() == 3
    assert versioned.compact(spark, table, day) == [day]
    assert reader.count() == 3  # opened before the compaction


def test_no_local_scratch_folder_off_a_local_master(monkeypatch):
    class Cluster:
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    monkeypatch.setattr(sessions, "_configured_checkpoint_dir", lambda s: None)
    with pytest.raises(ValueError):
        sessions.checkpoint_root(Cluster())


def test_newest_days_are_read_until_they_hold_enough(spark, scratch):
    day, table, asked = B - B % 86400, f"{scratch}/t", []
    versioned.write_version(counts_of(spark, [day - 86400 * k for k in range(6)] + [day + 60]), table, 0)

    def enough(rows):
        asked.append(rows.count())
        return asked[-1] >= 3

    got = read_newest(spark, table, enough)
    assert asked == [2, 3] and "window_date" in got._jdf.queryExecution().toString() and got.count() == 3
    assert read_newest(spark, table, lambda rows: False).count() == 7
