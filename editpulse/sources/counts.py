"""Read stored count tables.

``read_versioned`` is the read side of ``editpulse.sinks.versioned``: the
current row per key is the one with the highest ``batch_id`` over the
``versions/`` and ``compacted/`` areas.  Only the folders of the days asked for are
handed to Spark (below the area's ``basePath``), so no other day's files are listed;
a lower bound on ``window_start`` is pushed to the Parquet scan as well.
``read_final`` reads an append-only table (one row per key by construction),
less what its retention has taken off.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.functions.time import epoch_seconds, ts_literal
from editpulse.operators.latest import latest_version
from editpulse.schema import COUNT_TABLES, count_table_schema
from editpulse.sinks.versioned import COMPACTED, FOLDED, RETENTION, VERSIONS, day_of, glob_paths, path_exists


def _stored_schema(table: str, batch_id: bool) -> T.StructType:
    fields = list(count_table_schema(table).fields) + [
        T.StructField("created_at", T.TimestampType(), True),
    ]
    if batch_id:
        fields.append(T.StructField("batch_id", T.LongType(), True))
    fields.append(T.StructField("window_date", T.DateType(), True))
    return T.StructType(fields)


def _since(df: DataFrame, since_epoch: int | None) -> DataFrame:
    if since_epoch is None:
        return df
    return df.where(F.col("window_date") >= F.lit(_day(since_epoch))).where(F.col("window_start") >= ts_literal(since_epoch))


def _day(epoch) -> dt.date:
    return dt.datetime.fromtimestamp(epoch_seconds(epoch), dt.timezone.utc).date()


def _day_folders(spark: SparkSession, pattern: str, since_epoch: int | None, days: Sequence[dt.date] | None) -> dict[str, dt.date]:
    """The day folders of one area that a read needs, with their days."""
    first = None if since_epoch is None else _day(since_epoch)
    found = {p: day_of(p) for p in glob_paths(spark, f"{pattern}/window_date=*")}
    return {p: d for p, d in found.items() if d is not None and (first is None or d >= first) and (days is None or d in days)}


def read_versioned(
    spark: SparkSession,
    path: str,
    table: str = "user_edit_counts",
    since_epoch: int | None = None,
    days: Sequence[dt.date] | None = None,
    with_batch_id: bool = False,
) -> DataFrame:
    """Current rows of a versioned count table (optionally only some days).

    Days that have no partition under ``versions/`` hold one row per key in
    ``compacted/`` by construction: they are read as they are, with no
    aggregate and no shuffle.  Only days that still have versions (recent,
    not yet compacted) go through the latest-version aggregate, over both
    areas.  Which days those are comes from the directory listing.
    """
    _, key, _ = COUNT_TABLES[table]
    schema = _stored_schema(table, True)
    root = path.rstrip("/")
    if not (path_exists(spark, f"{root}/{VERSIONS}") or path_exists(spark, f"{root}/{COMPACTED}")):
        raise FileNotFoundError(f"no count table at {path}")
    cols = ["window_start", "window_end", key, "edit_count", "created_at"] + (
        ["batch_id"] if with_batch_id else [])
    batches = f"{root}/{VERSIONS}/batch_id=*"
    folded = {p.rsplit("/", 1)[0] for p in glob_paths(spark, f"{batches}/window_date=*/{FOLDED}")}
    versions = {p: d for p, d in _day_folders(spark, batches, since_epoch, days).items() if p not in folded}
    compacted = _day_folders(spark, f"{root}/{COMPACTED}", since_epoch, days)
    open_days = set(versions.values())

    def read(area: str, folders: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).option("basePath", f"{root}/{area}").parquet(*folders)
        return _since(rows, since_epoch)

    parts = []
    closed = [p for p, d in compacted.items() if d not in open_days]
    if closed:
        parts.append(read(COMPACTED, closed).select(*cols))
    if versions:
        mixed = read(VERSIONS, list(versions))
        before = [p for p, d in compacted.items() if d in open_days]
        if before:
            mixed = mixed.unionByName(read(COMPACTED, before))
        values = ["window_end", "edit_count", "created_at"] + (["batch_id"] if with_batch_id else [])
        parts.append(latest_version(mixed, ["window_start", key], "batch_id", values).select(*cols))
    if not parts:  # every day expired, or none in the range
        return spark.createDataFrame([], schema).select(*cols)
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out


def read_newest(spark: SparkSession, path: str, enough: Callable[[DataFrame], bool],
                table: str = "user_edit_counts") -> DataFrame:
    """The newest days of a versioned table, as many as ``enough`` asks for.

    For queries that want the first rows by descending window start: days are
    added from the newest on, doubling, until ``enough`` of what they hold, so
    the answer is that of the whole table but older days are never opened."""
    root = path.rstrip("/")
    days = sorted({d for area in (f"{VERSIONS}/batch_id=*", COMPACTED)
                   for d in (day_of(p) for p in glob_paths(spark, f"{root}/{area}/window_date=*")) if d}, reverse=True)
    k = 1
    while True:
        rows = read_versioned(spark, path, table, days=days[:k])
        if k >= len(days) or enough(rows):
            return rows
        k *= 2


def read_final(
    spark: SparkSession, path: str, table: str = "user_edit_counts", since_epoch: int | None = None
) -> DataFrame:
    """Rows of an append-only (finalised) count table that its retention has left.

    Spark lists the table from the file sink's log.  The cutoff that
    ``operators.retention.drop_expired_final`` has stored is a filter on the day
    partitions, so files of expired days, still in the log, are not looked for."""
    _, key, _ = COUNT_TABLES[table]
    raw = spark.read.schema(_stored_schema(table, False)).parquet(path)
    kept_from = retained_from(spark, path)
    since = [epoch_seconds(e) for e in (kept_from, since_epoch) if e is not None]
    return _since(raw, max(since) if since else None).select("window_start", "window_end", key, "edit_count")


def retained_from(spark: SparkSession, path: str) -> int | None:
    """The latest retention cutoff (epoch seconds) of an append-only table."""
    marks = [p.rsplit("=", 1)[1] for p in glob_paths(spark, f"{path.rstrip('/')}/{RETENTION}/kept_from=*")]
    return max(map(int, marks), default=None)
