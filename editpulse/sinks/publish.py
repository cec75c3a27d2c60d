"""Publish closed windows of a stored count table to a keyed database table.

The streaming job keeps its counts in storage; a database behind a dashboard is
filled from there by a batch step.  It takes windows that the stream's own
watermark has closed (no later edit can change them), leaves out keys that the
database has, and appends the rest, a day at a time.  What the database has is
asked of the database itself, so a step that died half-way, or is run
twice, publishes nothing twice; one publisher runs at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.time import ts_literal
from editpulse.schema import COUNT_TABLES
from editpulse.sinks.jdbc import write_jdbc
from editpulse.sinks.versioned import glob_paths, utc_date
from editpulse.sources.counts import read_versioned
from editpulse.sources.jdbc import read_jdbc_whole

log = logging.getLogger(__name__)


def stream_watermark(spark: SparkSession, checkpoint: str) -> int | None:
    """The watermark (whole epoch seconds, rounded down) that the last finished batch of a
    job ran with, from its checkpoint; None before one is known."""
    root = checkpoint.rstrip("/")
    done = [int(n) for n in (p.rsplit("/", 1)[1] for p in glob_paths(spark, f"{root}/commits/*")) if n.isdigit()]
    if not done:
        return None
    # An offset file: a version line, a line of metadata, a line a source.
    lines = [r[0] for r in spark.read.text(f"{root}/offsets/{max(done)}").collect()]
    for line in lines:
        if line.startswith("{") and "batchWatermarkMs" in line:
            return int(json.loads(line)["batchWatermarkMs"]) // 1000 or None
    return None


def closed_windows(counts: DataFrame, watermark: int) -> DataFrame:
    """Rows whose window ended at or before ``watermark`` (epoch seconds)."""
    return counts.where(F.col("window_end") <= ts_literal(watermark))


def unpublished(counts: DataFrame, published: DataFrame, table: str = "user_edit_counts") -> DataFrame:
    """Rows whose (window, key) ``published`` lacks."""
    _, key, _ = COUNT_TABLES[table]
    return counts.join(published.select("window_start", key), ["window_start", key], "left_anti").select(*counts.columns)


def publish_closed(spark: SparkSession, path: str, checkpoint: str, url: str, target: str, table: str = "user_edit_counts",
                   since_epoch: int | None = None, num_partitions: int | None = None, **kwargs) -> dict[dt.date, int]:
    """Publish the closed windows of the versioned table at ``path``; rows sent, by day.

    ``since_epoch`` bounds the days looked at (e.g. the start of the last day
    published); without it all days are compared."""
    watermark = stream_watermark(spark, checkpoint)
    if watermark is None:
        return {}
    _, key, _ = COUNT_TABLES[table]
    rows = read_versioned(spark, path, table, since_epoch=since_epoch)
    closed = closed_windows(rows, watermark).select("window_start", "window_end", key, "edit_count", "created_at")
    days = sorted(r[0] for r in closed.select(utc_date(F.col("window_start"))).distinct().collect())  # a row a day
    held = read_jdbc_whole(spark, url, target, **kwargs)
    sent = {}
    for day in days:
        of_day = utc_date(F.col("window_start")) == F.lit(day)
        begin = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())
        # Ranges on the column itself reach the database.
        there = held.where((F.col("window_start") >= ts_literal(begin)) & (F.col("window_start") < ts_literal(begin + 86400)))
        new = unpublished(closed.where(of_day), there, table).persist()
        try:
            sent[day] = new.count()
            if sent[day]:
                write_jdbc(new, url, target, num_partitions=num_partitions, **kwargs)
        finally:
            new.unpersist()
        log.info("%s: %s rows of %s published", target, sent[day], day)
    return sent
