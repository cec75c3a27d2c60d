"""Retention of stored count tables.

Row semantics (delete rows whose window starts before ``as_of - days``) are
``editpulse.plans.dashboard.retention_keep``.  Storage: the versioned
table is partitioned by ``window_date``, so whole expired days are removed
by deleting their directories in both the ``versions/`` and ``compacted/``
areas (a metadata operation through the Hadoop FileSystem API, valid on any
cluster file system).  Of the boundary day, the rows that are left are written
again (``drop_expired_rows``).

An append-only table (the append-mode stream's file sink) is another case: the
sink's log names every file that was committed, a running job goes on
appending to it, and files must not be written again behind its back.  Its retention
stores the cutoff beside the log and deletes the folders of days that lie
before it whole (``drop_expired_final``); ``read_final`` takes the cutoff
as a bound, which drops the boundary day's expired rows and keeps Spark from
looking for the deleted files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from pyspark.sql import functions as F

from editpulse.functions.time import epoch_seconds, ts_literal
from editpulse.sinks.versioned import COMPACTED, RETENTION, VERSIONS, create_empty, day_of, delete_path, glob_paths, replace_days


def cutoff_day(as_of, days: int) -> dt.date:
    """First day that still holds retained rows."""
    cutoff = epoch_seconds(as_of) - int(days) * 86400
    return dt.datetime.fromtimestamp(cutoff, dt.timezone.utc).date()


def expired_partitions(spark: SparkSession, path: str, as_of, days: int,
                       pattern: str = "*/window_date=*") -> list[str]:
    """Partition directories of whole days before the cutoff day."""
    keep_from = cutoff_day(as_of, days)
    out = []
    for p in glob_paths(spark, f"{path.rstrip('/')}/{pattern}") + glob_paths(
        spark, f"{path.rstrip('/')}/{VERSIONS}/{pattern}"
    ):
        name = p.rstrip("/").rsplit("/", 1)[-1]
        if not name.startswith("window_date="):
            continue
        try:
            day = dt.date.fromisoformat(name.split("=", 1)[1])
        except ValueError:
            continue
        if day < keep_from:
            out.append(p)
    return sorted(set(out))


def drop_expired_days(spark: SparkSession, path: str, as_of, days: int,
                      pattern: str = "*/window_date=*") -> list[str]:
    """Delete expired day partitions; returns what was deleted."""
    gone = expired_partitions(spark, path, as_of, days, pattern)
    for p in gone:
        delete_path(spark, p)
    return gone


def drop_expired_rows(spark: SparkSession, path: str, as_of, days: int, table: str = "user_edit_counts") -> bool:
    """Write the boundary day of a versioned table again without its expired rows.

    Its version partitions hold running totals of the rows that went too, so
    they are folded and deleted with them.  True if the day was there."""
    from editpulse.sources.counts import read_versioned

    cutoff = epoch_seconds(as_of) - int(days) * 86400
    day = cutoff_day(as_of, days)
    parts = [p for area in (f"{VERSIONS}/*", COMPACTED) for p in glob_paths(spark, f"{path.rstrip('/')}/{area}/window_date=*") if day_of(p) == day]
    if not parts or cutoff % 86400 == 0:
        return False
    rows = read_versioned(spark, path, table, days=[day], with_batch_id=True).where(F.col("window_start") >= ts_literal(cutoff))
    if rows.isEmpty():
        gone = parts
    else:
        replace_days(spark, path, rows)
        gone = [p for p in parts if f"/{VERSIONS}/" in p]
    for p in gone:
        delete_path(spark, p)
    return True


def drop_expired_final(spark: SparkSession, path: str, as_of, days: int) -> list[str]:
    """Retention of an append-only table; returns the day folders deleted.

    The cutoff is stored first: readers opened after it never ask for the files
    that go.  An older cutoff changes nothing."""
    cutoff = epoch_seconds(as_of) - int(days) * 86400
    create_empty(spark, f"{path.rstrip('/')}/{RETENTION}/kept_from={cutoff}")
    first = cutoff_day(as_of, days)
    gone = [p for p in glob_paths(spark, f"{path.rstrip('/')}/window_date=*") if (day_of(p) or first) < first]
    for p in gone:
        delete_path(spark, p)
    return gone
