"""The dashboard queries and stored views, over a count-table DataFrame.

``NOW()`` becomes the ``as_of`` argument (a datetime, ISO string or epoch
seconds; naive = UTC).  Ranges compare the window *start*, inclusive, and
are unbounded above.  Every ORDER BY ... LIMIT gets a total order: ties on
the reference's sort keys are broken by the name, then the time.

Inputs have the count-table columns ``window_start``, ``window_end``, the
key (``user_name`` / ``page_title`` / ``namespace``) and ``edit_count``.
Results are lazy; collecting is the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.time import minutes_before, start_of_day, ts_literal
from editpulse.operators.topk import top_k, top_k_per_group

# The dashboard's defaults and choices.
TIME_RANGE_CHOICES = (15, 30, 60, 120, 240)
DEFAULT_MINUTES = 60
TOP_N_MIN, TOP_N_MAX, TOP_N_STEP, TOP_N_DEFAULT = 5, 50, 5, 20
STATISTICS_MINUTES = 60
RECENT_WINDOWS_LIMIT = 10
HIGH_VOLUME_LIMIT = 10
RECENT_ACTIVITY_HOURS = 24
HOURLY_TOP_LIMIT = 50
TODAY_TOP_LIMIT = 10
LATEST_LIMIT = 20


def in_range(counts: DataFrame, since_epoch: int) -> DataFrame:
    """Rows whose window starts at or after ``since_epoch``."""
    return counts.where(F.col("window_start") >= ts_literal(since_epoch))


def last_minutes(counts: DataFrame, as_of, minutes: int) -> DataFrame:
    if minutes < 0:
        raise ValueError("minutes must be >= 0")
    return in_range(counts, minutes_before(as_of, minutes))


def numbered(ordered: DataFrame) -> DataFrame:
    """The rows with their ``position`` (from 1) in the order they come in.

    For a display's few rows: the positions are given in one task.  They follow the
    row order of the input itself, so they state it rather than sort again."""
    rows = ordered.withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_at"))
    return rows.select(position.alias("position"), *ordered.columns)


def recent_user_edit_counts(counts: DataFrame, as_of, minutes: int = DEFAULT_MINUTES, ordered: bool = True,
                            with_created_at: bool = False) -> DataFrame:
    """All (window, user) rows of the last ``minutes``.

    ``with_created_at`` adds the stored insert time (a stored table has it;
    it is not deterministic, so it is off by default).
    """
    cols = ["window_start", "window_end", "user_name", "edit_count"]
    if with_created_at:
        cols.append("created_at")
    df = last_minutes(counts, as_of, minutes).select(*cols)
    if ordered:
        df = df.orderBy(F.desc("window_start"), F.desc("edit_count"), F.asc("user_name"))
    return df


def _user_totals(df: DataFrame, alias: str) -> DataFrame:
    return df.groupBy("user_name").agg(F.sum("edit_count").alias(alias))


def top_users(counts: DataFrame, as_of, minutes: int = DEFAULT_MINUTES, limit: int = TOP_N_DEFAULT) -> DataFrame:
    """Editors with the most edits in the last ``minutes``."""
    totals = _user_totals(last_minutes(counts, as_of, minutes), "total_edits")
    return top_k(totals, limit, [F.desc("total_edits"), F.asc("user_name")])


def edit_timeline(counts: DataFrame, as_of, minutes: int = DEFAULT_MINUTES, descending: bool = False,
                  value_name: str = "total_edits") -> DataFrame:
    """Total edits per window over the last ``minutes`` (column ``value_name``)."""
    df = last_minutes(counts, as_of, minutes).groupBy("window_start").agg(
        F.sum("edit_count").alias(value_name)
    )
    order = F.desc("window_start") if descending else F.asc("window_start")
    return df.orderBy(order)


def statistics(counts: DataFrame, as_of, minutes: int = STATISTICS_MINUTES) -> DataFrame:
    """One row of summary statistics; an empty range gives 0 and NULLs.

    ``avg_edits_per_window`` averages over (window, user) rows.
    """
    return last_minutes(counts, as_of, minutes).agg(
        F.count_distinct("user_name").alias("unique_users"),
        F.sum("edit_count").alias("total_edits"),
        F.avg("edit_count").alias("avg_edits_per_window"),
        F.max("edit_count").alias("max_edits_single_window"),
    )


def recent_windows(counts: DataFrame, limit: int = RECENT_WINDOWS_LIMIT) -> DataFrame:
    """The most recent distinct windows."""
    windows = counts.select("window_start", "window_end").distinct()
    return top_k(windows, limit, [F.desc("window_start")])


def high_volume_editors(counts: DataFrame, as_of, minutes: int = DEFAULT_MINUTES, limit: int = HIGH_VOLUME_LIMIT) -> DataFrame:
    """Largest single-window counts of the last ``minutes``.

    Ties keep the most recent window first, then the name.
    """
    rows = last_minutes(counts, as_of, minutes)
    best = top_k(rows, limit, [F.desc("edit_count"), F.desc("window_start"), F.asc("user_name")])
    return best.select("user_name", "edit_count", "window_start")


def recent_user_activity(counts: DataFrame, as_of, hours: int = RECENT_ACTIVITY_HOURS, ordered: bool = True) -> DataFrame:
    """The stored 24-hour activity view."""
    df = last_minutes(counts, as_of, hours * 60).select("window_start", "user_name", "edit_count")
    if ordered:
        df = df.orderBy(F.desc("window_start"), F.asc("user_name"))
    return df


def top_contributors_hourly(counts: DataFrame, as_of, limit: int = HOURLY_TOP_LIMIT) -> DataFrame:
    """The stored top-contributors view: last hour, top 50."""
    totals = _user_totals(last_minutes(counts, as_of, 60), "total_edits")
    return top_k(totals, limit, [F.desc("total_edits"), F.asc("user_name")])


def total_edits(counts: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Total edits of the last ``minutes`` (NULL when none)."""
    return last_minutes(counts, as_of, minutes).agg(F.sum("edit_count").alias("total_edits"))


def top_contributors_today(counts: DataFrame, as_of, limit: int = TODAY_TOP_LIMIT) -> DataFrame:
    """Top contributors since midnight (UTC) of ``as_of``'s day."""
    totals = _user_totals(in_range(counts, start_of_day(as_of)), "total")
    return top_k(totals, limit, [F.desc("total"), F.asc("user_name")])


LATEST_COLUMNS = ("window_start", "window_end", "user_name", "edit_count")
SAMPLE_COLUMNS = ("window_start", "user_name", "edit_count")
SAMPLE_LIMIT = 10


def latest_aggregations(counts: DataFrame, limit: int = LATEST_LIMIT,
                        columns=LATEST_COLUMNS) -> DataFrame:
    """The most recent count rows (the smoke check uses 10 rows, 3 columns)."""
    rows = counts.select(*columns)
    return top_k(rows, limit, [F.desc("window_start"), F.asc("user_name")])


def row_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("row_count"))


def top_pages(page_counts: DataFrame, k: int = 5) -> DataFrame:
    """Most edited pages per window: rank ``1..k`` by count, then title."""
    ranked = top_k_per_group(
        page_counts, ["window_start"], [F.desc("edit_count"), F.asc("page_title")], k, "page_rank"
    )
    return ranked.select("window_start", "window_end", "page_title", "edit_count", "page_rank")


def retention_keep(counts: DataFrame, as_of, days: int) -> DataFrame:
    """Rows a ``days``-day retention keeps (window start within the period)."""
    if days < 0:
        raise ValueError("days must be >= 0")
    return last_minutes(counts, as_of, days * 24 * 60)
