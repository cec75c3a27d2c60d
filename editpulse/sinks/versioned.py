"""Versioned upsert table for update-mode output (one current row per key).

An update-mode micro-batch carries the new running total of every key it
changed.  Batch ``i`` is written to its own partition
``versions/batch_id=i`` (overwritten as a whole, so replaying a batch after
a failure changes nothing), sub-partitioned by ``window_date`` so that
time-range reads prune directories.  Readers take the row with the highest
``batch_id`` per key (``editpulse.sources.counts``).

Compaction keeps reads from growing with the number of batches: for days
the watermark has closed, the current rows are written once to
``compacted/window_date=<d>`` (carrying the ``batch_id`` they came from) and
the folded versions are marked, and deleted by the next run.

Layout::

    <path>/versions/batch_id=<i>/window_date=<yyyy-mm-dd>/part-*.parquet
    <path>/compacted/window_date=<yyyy-mm-dd>/part-*.parquet
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

VERSIONS = "versions"
COMPACTED = "compacted"
# Empty file in a version partition whose rows a compaction has folded.
FOLDED = "_folded"
# Folder of an append-only table with its retention cutoffs (empty files).
RETENTION = "_retention"


def utc_date(col):
    """UTC calendar day of an instant (independent of the session zone)."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(col) / F.lit(86400)).cast("int"))


def with_storage_columns(counts: DataFrame) -> DataFrame:
    """Add ``window_date`` (UTC day of the window start) and ``created_at``."""
    return counts.withColumn("window_date", utc_date(F.col("window_start"))).withColumn(
        "created_at", F.current_timestamp()
    )


def version_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/batch_id={int(batch_id)}"


def write_version(batch: DataFrame, path: str, batch_id: int) -> dict:
    """Write one micro-batch as version ``batch_id``; returns row metrics.

    The row count comes from an observed metric of the write itself: no
    second job over the batch.
    """
    obs = Observation(f"batch_{batch_id}")
    rows = with_storage_columns(batch).observe(obs, F.count(F.lit(1)).alias("rows"))
    # static: a replayed batch replaces its whole version, whatever the session says
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("window_date").parquet(
        version_path(path, batch_id))
    metrics = obs.get
    log.info("batch %s: wrote %s rows", batch_id, metrics.get("rows"))
    return metrics


def write_rejects(batch: DataFrame, path: str, batch_id: int) -> int:
    """Write one micro-batch's rejected messages as part ``batch_id`` of the
    rejects table, in place of what a failed run left there; returns their number."""
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    obs = Observation(f"rejects_{batch_id}")
    batch.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
    n = int(obs.get["rows"] or 0)
    if not n:
        delete_path(batch.sparkSession, target)
    return n


class VersionedUpsert:
    """``foreachBatch`` callback writing each batch as a new version."""

    def __init__(self, path: str):
        self.path = path
        self.last_metrics: dict | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.last_metrics = write_version(batch, self.path, batch_id)
        if not self.last_metrics.get("rows"):
            # A no-data batch (the watermark moved, nothing changed): do not
            # leave an empty version directory behind.
            delete_path(batch.sparkSession, version_path(self.path, batch_id))


# Version id of rows written by a batch backfill: lower than any stream
# batch, so the stream's rows win where both exist.
BACKFILL_BATCH_ID = -1


def backfill(counts: DataFrame, path: str) -> None:
    """Write batch-computed count rows straight into the compacted area.

    For history that no stream will touch again (closed days).  Only the
    day partitions present in ``counts`` are replaced (dynamic partition
    overwrite), so a backfill of some days leaves the others alone.  The
    rebalance hint lets AQE size the files of each day: a hot day is split
    over several tasks, small days are merged, instead of one file per task
    and day (or one task per day with a plain repartition).
    """
    (
        with_storage_columns(counts)
        .withColumn("batch_id", F.lit(BACKFILL_BATCH_ID).cast("bigint"))
        .hint("rebalance", "window_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date")
        .parquet(f"{path.rstrip('/')}/{COMPACTED}")
    )


# ---------------------------------------------------------------------------
# file-system helpers (metadata operations through the Hadoop API)
# ---------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hp = _fs(spark, path)
    return bool(fs.exists(hp))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, hp = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(hp) or []))


def create_empty(spark: SparkSession, path: str) -> None:
    fs, hp = _fs(spark, path)
    fs.create(hp).close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hp = _fs(spark, path)
    fs.delete(hp, True)


def day_of(partition_path: str) -> dt.date | None:
    name = partition_path.rstrip("/").rsplit("/", 1)[-1]
    if not name.startswith("window_date="):
        return None
    try:
        return dt.date.fromisoformat(name.split("=", 1)[1])
    except ValueError:
        return None


def compact(spark: SparkSession, path: str, through_day: dt.date, table: str = "user_edit_counts") -> list[dt.date]:
    """Fold all versions of days ``<= through_day`` into ``compacted/``.

    Only call it for days no open window can still change (the stream's
    watermark is past their end).  The current rows of those days (earlier
    compactions included) replace their partitions of ``compacted/``
    (``replace_days``).  The folded version partitions are only marked; the
    next run deletes them, so a reader opened before this one still finds its
    files.  A crash between the steps leaves duplicates that the latest-version
    read removes, and re-running is safe.  Returns the compacted days.
    """
    from editpulse.sources.counts import read_versioned

    drop_folded(spark, path)
    parts = glob_paths(spark, f"{path.rstrip('/')}/{VERSIONS}/batch_id=*/window_date=*")
    days = sorted({d for d in (day_of(p) for p in parts) if d is not None and d <= through_day})
    if not days:
        return []
    replace_days(spark, path, read_versioned(spark, path, table, days=days, with_batch_id=True))
    for p in parts:
        if day_of(p) in days:
            create_empty(spark, f"{p}/{FOLDED}")
    return days


def replace_days(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Replace the compacted partitions of the days in ``rows`` (with ``batch_id``).

    The rows are staged on the table's own file system first, which cuts their
    lineage to the files they replace.  The staged rows and those written back
    are counted by the writes themselves; unless the counts agree an error is
    raised and the caller deletes nothing."""
    rows = rows.withColumn("window_date", utc_date(F.col("window_start")))
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    staged, written = Observation("staged"), Observation("written")
    rows.hint("rebalance", "window_date").observe(staged, F.count(F.lit(1)).alias("n")).write.parquet(staging)
    n = staged.get["n"]
    back = spark.read.schema(rows.schema).parquet(staging)
    if back.count() != n:
        raise RuntimeError(f"{staging}: {n} rows were staged, but not all can be read back; nothing was replaced")
    (
        back.observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date")
        .parquet(f"{path.rstrip('/')}/{COMPACTED}")
    )
    if written.get["n"] != n:
        raise RuntimeError(f"{path}: {n} rows were staged, {written.get['n']} written")
    delete_path(spark, staging)


def drop_folded(spark: SparkSession, path: str) -> list[str]:
    """Delete the version partitions that an earlier compaction folded (readers
    opened before it have had until now to finish)."""
    markers = glob_paths(spark, f"{path.rstrip('/')}/{VERSIONS}/batch_id=*/window_date=*/{FOLDED}")
    gone = [m.rsplit("/", 1)[0] for m in markers]
    for p in gone:
        delete_path(spark, p)
    _drop_empty_versions(spark, path)
    return gone


def _drop_empty_versions(spark: SparkSession, path: str) -> None:
    """Delete version directories without day partitions, except the newest
    (it may be the batch being written right now)."""
    batches = glob_paths(spark, f"{path.rstrip('/')}/{VERSIONS}/batch_id=*")
    ids = []
    for b in batches:
        try:
            ids.append((int(b.rsplit("=", 1)[1]), b))
        except ValueError:
            continue
    if not ids:
        return
    newest = max(i for i, _ in ids)
    for i, b in ids:
        if i < newest and not glob_paths(spark, f"{b}/window_date=*"):
            delete_path(spark, b)
