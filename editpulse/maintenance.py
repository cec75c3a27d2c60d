"""Table maintenance: compaction and retention of a versioned count table.

    python -m editpulse.maintenance --table PATH [--compact-through YYYY-MM-DD |
        --compact-closed-days [--checkpoint DIR]] [--retention-days N] [--as-of ISO] [--final]

``--compact-closed-days`` compacts every day that the stream's watermark has
closed: with ``--checkpoint DIR`` the one that the job's last finished batch ran with;
without it, days that ended at least one day before ``as_of`` (default: now),
which is right only while the stream lags less.  Retention deletes
whole expired days; ``--final`` says that the table is an append-mode stream's.
Meant to run on a schedule beside the streaming job.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from editpulse.functions.time import epoch_seconds
from editpulse.operators.retention import drop_expired_days, drop_expired_final, drop_expired_rows
from editpulse.schema import COUNT_TABLES
from editpulse.sinks.publish import stream_watermark
from editpulse.sinks.versioned import compact

log = logging.getLogger(__name__)


def closed_through(as_of) -> dt.date:
    """Last day that ended at least a full day before ``as_of``."""
    day = dt.datetime.fromtimestamp(epoch_seconds(as_of), dt.timezone.utc).date()
    return day - dt.timedelta(days=2)


def closed_by_watermark(watermark: int | None) -> dt.date | None:
    """Last day that lies before ``watermark`` (epoch seconds) whole; its windows are at
    most a day long."""
    if watermark is None:
        return None
    return dt.datetime.fromtimestamp(watermark, dt.timezone.utc).date() - dt.timedelta(days=2)


def run(spark: SparkSession, table_path: str, table: str = "user_edit_counts",
        compact_through: dt.date | None = None, retention_days: int | None = None,
        as_of=None) -> dict:
    as_of = as_of if as_of is not None else dt.datetime.now(dt.timezone.utc)
    report: dict = {}
    if retention_days is not None:
        report["dropped"] = drop_expired_days(spark, table_path, as_of, retention_days)
        report["rewritten"] = drop_expired_rows(spark, table_path, as_of, retention_days, table)
    if compact_through is not None:
        report["compacted"] = [d.isoformat() for d in compact(spark, table_path, compact_through, table)]
    return report


def main(argv=None) -> None:
    logging.basicConfig(level=logging.INFO)
    p = argparse.ArgumentParser(prog="editpulse.maintenance")
    p.add_argument("--table", required=True)
    p.add_argument("--kind", default="user_edit_counts", choices=sorted(COUNT_TABLES))
    p.add_argument("--compact-through")
    p.add_argument("--compact-closed-days", action="store_true")
    p.add_argument("--retention-days", type=int)
    p.add_argument("--as-of")
    p.add_argument("--checkpoint", help="the streaming job's checkpoint: its watermark says which days are closed")
    p.add_argument("--final", action="store_true", help="an append-mode stream's table: retention only")
    a = p.parse_args(argv)
    as_of = a.as_of or dt.datetime.now(dt.timezone.utc)
    spark = SparkSession.builder.appName("editpulse-maintenance").getOrCreate()
    if a.final:
        gone = drop_expired_final(spark, a.table, as_of, a.retention_days) if a.retention_days is not None else []
        log.info("maintenance report: %s", {"dropped": gone})
        return
    through = None
    if a.compact_through:
        through = dt.date.fromisoformat(a.compact_through)
    elif a.compact_closed_days and a.checkpoint:
        through = closed_by_watermark(stream_watermark(spark, a.checkpoint))
    elif a.compact_closed_days:
        through = closed_through(as_of)
    log.info("maintenance report: %s", run(spark, a.table, a.kind, through, a.retention_days, as_of))


if __name__ == "__main__":
    main()
