"""Edit counts per event-time window and key (the count tables).

``count(*)`` grouped by ``(window, key)`` plans as a partial hash aggregate
before the shuffle and a final one after it, so a hot key (one user holding
a third of all edits) reaches the reducers as one pre-counted row per map
task and window, never as its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.config import WindowSpec
from editpulse.functions.parse import valid_edits
from editpulse.schema import COUNT_TABLES, EVENT_TIME


def windowed_counts(
    edits: DataFrame,
    key: str,
    key_alias: str,
    window: WindowSpec = WindowSpec(),
    watermark: str | None = None,
) -> DataFrame:
    """``(window_start, window_end, key_alias, edit_count)`` per window and key.

    Tumbling windows when ``window.slide`` is None, sliding otherwise; both
    half-open ``[start, end)`` and epoch aligned.  With ``watermark`` the
    aggregate is a bounded-state streaming aggregate.
    """
    df = edits
    if watermark is not None:
        df = df.withWatermark(EVENT_TIME, watermark)
    if window.slide is None:
        w = F.window(F.col(EVENT_TIME), window.duration)
    else:
        w = F.window(F.col(EVENT_TIME), window.duration, window.slide)
    return df.groupBy(w.alias("window"), F.col(key).alias(key_alias)).agg(
        F.count(F.lit(1)).alias("edit_count")
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(key_alias),
        F.col("edit_count"),
    )


def count_table(
    edits: DataFrame,
    table: str,
    window: WindowSpec = WindowSpec(),
    watermark: str | None = None,
    validate: bool = True,
) -> DataFrame:
    """One of the count tables (``user_edit_counts``, ``namespace_edit_counts``,
    ``top_pages``) from parsed edits.  Rows that would break the table's
    NOT NULL / length constraints are left out (see ``rejected_edits``)."""
    src, key, _ = COUNT_TABLES[table]
    df = valid_edits(edits, table) if validate else edits
    return windowed_counts(df, src, key, window, watermark)


def user_edit_counts(edits: DataFrame, window: WindowSpec = WindowSpec(), watermark: str | None = None) -> DataFrame:
    return count_table(edits, "user_edit_counts", window, watermark)


def namespace_edit_counts(edits: DataFrame, window: WindowSpec = WindowSpec(), watermark: str | None = None) -> DataFrame:
    return count_table(edits, "namespace_edit_counts", window, watermark)


def page_edit_counts(edits: DataFrame, window: WindowSpec = WindowSpec(), watermark: str | None = None) -> DataFrame:
    return count_table(edits, "top_pages", window, watermark)
