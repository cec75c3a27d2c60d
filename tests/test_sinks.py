import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from collected import rows
from editpulse.operators.retention import cutoff_day, drop_expired_days, expired_partitions
from editpulse.sinks.csv import export_csv, read_export
from editpulse.sinks.jdbc import jdbc_options, write_jdbc
from editpulse.sinks.versioned import write_version
from editpulse.sources import kafka
from editpulse.sources.counts import read_versioned
from editpulse.sources.jdbc import read_jdbc

B = 1700000040

SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("edit_count", T.LongType()),
])


def test_csv_round_trip_quotes_commas_newlines_empty(spark, scratch):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    data = [(ts, 'quote " here', 1), (ts, "comma, here", 2), (ts, "new\nline", 3),
            (ts, "", 4), (ts, None, 5)]
    df = spark.createDataFrame(data, SCHEMA)
    path = export_csv(df, f"{scratch}/csv")
    back = read_export(spark, path, SCHEMA)
    assert rows(back, "edit_count", "user_name") == rows(df, "edit_count", "user_name")
    text = "".join(open(p).read() for p in sorted(
        __import__("glob").glob(path.replace("file:", "") + "/part-*.csv")))
    assert "window_start,user_name,edit_count" in text
    assert "2024-01-02 03:04:05" in text


def test_jdbc_write_and_pushdown_on_embedded_derby(spark):
    url = "jdbc:derby:memory:editpulse_test;create=true"
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), "a", 3), (dt.datetime(2024, 1, 2, 0, 0), "b", 1)], SCHEMA)
    write_jdbc(df, url, "USER_EDIT_COUNTS", mode="overwrite", num_partitions=1,
               driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = read_jdbc(spark, url, "USER_EDIT_COUNTS", driver="org.apache.derby.jdbc.EmbeddedDriver")
    recent = back.where(F.col("window_start") >= F.lit(dt.datetime(2024, 1, 2)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "window_start" in plan.split("PushedFilters")[1]
    assert [r.user_name for r in recent.collect()] == ["b"]


def test_jdbc_options():
    o = jdbc_options("jdbc:x", "t", user="u", password="p", driver="D")
    assert o == {"url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "user": "u",
                 "password": "p", "driver": "D"}


def test_kafka_options():
    s = kafka.source_options("b:9092", "wiki_changes")
    assert s == {"kafka.bootstrap.servers": "b:9092", "subscribe": "wiki_changes",
                 "startingOffsets": "latest"}
    k = kafka.sink_options("b:9092", "wiki_changes", "/ck", acks="all")
    assert k["kafka.acks"] == "all" and k["kafka.compression.type"] == "gzip"
    assert k["topic"] == "wiki_changes" and k["checkpointLocation"] == "/ck"


def test_retention_drops_whole_expired_days(spark, scratch):
    table = f"{scratch}/t"
    day = 86400
    secs = [B - 10 * day, B - 9 * day, B - 1 * day, B]
    df = spark.createDataFrame([(s, s + 60, f"u{i}", 1) for i, s in enumerate(secs)],
                               "s long, e long, user_name string, edit_count long").select(
        F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds("e").alias("window_end"),
        "user_name", "edit_count")
    write_version(df, table, 0)
    write_version(df.where("user_name = 'u3'"), table, 1)
    as_of = B + 60
    assert cutoff_day(as_of, 7) == dt.datetime.fromtimestamp(B - 7 * day, dt.timezone.utc).date()
    assert len(expired_partitions(spark, table, as_of, 7)) == 2
    gone = drop_expired_days(spark, table, as_of, 7)
    assert len(gone) == 2
    assert sorted(r.user_name for r in read_versioned(spark, table).collect()) == ["u2", "u3"]


def test_maintenance_run_compacts_and_drops(spark, scratch):
    from editpulse import maintenance

    table = f"{scratch}/t"
    day = 86400
    secs = [B - 10 * day, B - 3 * day, B]
    df = spark.createDataFrame([(s, s + 60, f"u{i}", 1) for i, s in enumerate(secs)],
                               "s long, e long, user_name string, edit_count long").select(
        F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds("e").alias("window_end"),
        "user_name", "edit_count")
    write_version(df, table, 0)
    as_of = B + 60
    report = maintenance.run(spark, table, compact_through=maintenance.closed_through(as_of),
                             retention_days=7, as_of=as_of)
    assert len(report["dropped"]) == 1 and len(report["compacted"]) == 1
    assert sorted(r.user_name for r in read_versioned(spark, table).collect()) == ["u1", "u2"]


def test_backfill_loses_to_stream_versions(spark, scratch):
    from editpulse.sinks.versioned import backfill

    table = f"{scratch}/t"
    df = spark.createDataFrame([(B, B + 60, "a", 1)], "s long, e long, user_name string, edit_count long").select(
        F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds("e").alias("window_end"),
        "user_name", "edit_count")
    backfill(df, table)
    assert read_versioned(spark, table).first().edit_count == 1
    write_version(df.withColumn("edit_count", F.lit(5).cast("bigint")), table, 0)
    assert read_versioned(spark, table).first().edit_count == 5
