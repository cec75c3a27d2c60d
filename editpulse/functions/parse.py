"""Parsing, validation and filtering of edit events.

Input is a DataFrame with a string column of JSON messages (Kafka ``value``,
a replayed topic, or the payload of SSE ``data:`` lines).  Output is the
edit model of ``editpulse.schema`` plus ``event_time``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.schema import (
    COUNT_TABLES,
    CORRUPT_COL,
    EDIT_PARSE_SCHEMA,
    EVENT_TIME,
)

# Fixed value: prefix of an SSE payload line (with the space).
SSE_DATA_PREFIX = "data: "

# The seconds of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799

WIRE_FIELDS = ["id", "title", "user", "type", "namespace", "timestamp"]

# When the feed took a message in (a topic's own timestamp, a landed file's time);
# readers add it, batch inputs may lack it.
RECEIVED = "received"


def sse_frames(lines: DataFrame, col: str = "value") -> DataFrame:
    """Payloads of SSE ``data:`` lines; all other lines are ignored.

    Each ``data:`` line is one complete event; comments, ``event:``,
    ``id:`` and blank lines are dropped.
    """
    c = F.col(col)
    return lines.where(c.startswith(SSE_DATA_PREFIX)).select(
        F.expr(f"substring(`{col}`, {len(SSE_DATA_PREFIX) + 1})").alias("value"),
        *([RECEIVED] if RECEIVED in lines.columns else []),
    )


def parse_edits(messages: DataFrame, col: str = "value", keep_raw: bool = False) -> DataFrame:
    """Parse JSON messages into the edit model.

    PERMISSIVE parsing: a field of the wrong type becomes NULL and a message
    that is not JSON becomes an all-NULL row; in both cases the message text
    is kept in ``_corrupt_record``.  ``event_time`` is the Unix-seconds
    ``timestamp`` as a TimestampType.  A ``received`` column is kept.
    """
    parsed = F.from_json(
        F.col(col),
        EDIT_PARSE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL},
    )
    cols, kept = [parsed.alias("_e")], []
    if keep_raw:
        cols.append(F.col(col).alias("raw"))
        kept.append("raw")
    if RECEIVED in messages.columns:
        cols.append(F.col(RECEIVED))
        kept.append(RECEIVED)
    # The parse is a generator (one output row per message), so filters on
    # parsed fields stay above it.  As a plain projection, the optimizer
    # would push each filter below it and substitute ``from_json`` into the
    # condition, parsing every message once per filter and again for the
    # output.
    out = messages.select(F.inline(F.array(F.struct(*cols)))).select(
        *[F.col(f"_e.{f.name}").alias(f.name) for f in EDIT_PARSE_SCHEMA.fields],
        *kept,
    )
    return with_event_time(out)


def _in_range() -> Column:
    return F.col("timestamp").between(FIRST_SECOND, LAST_SECOND)


def with_event_time(edits: DataFrame) -> DataFrame:
    """Add ``event_time`` from Unix seconds (session-zone independent).

    Seconds outside the years 1 to 9999 (an overflow, or another unit) give a
    NULL time, which is rejected with a reason, instead of an error that would
    stop the job."""
    return edits.withColumn(EVENT_TIME, F.when(_in_range(), F.timestamp_seconds(F.col("timestamp"))))


def without_future_time(edits: DataFrame, max_skew_seconds: int | None, now: Column | None = None) -> DataFrame:
    """Take the ``event_time`` of edits more than ``max_skew_seconds`` ahead of
    ``now``, so that they are rejected with a reason and cannot move the watermark
    past all other edits.  None keeps all.

    The default clock is the message's own: when the feed took it in
    (``received``).  Every reader of a message, and every replay of it, then
    decides alike.  Only rows without that column are held against the current
    time."""
    if max_skew_seconds is None:
        return edits
    if now is None:
        now = F.col(RECEIVED) if RECEIVED in edits.columns else F.current_timestamp()
    latest = F.unix_seconds(now) + F.lit(int(max_skew_seconds))
    return edits.withColumn(EVENT_TIME, F.when(F.col("timestamp") <= latest, F.col(EVENT_TIME)))


def is_json_object(col: str = "value") -> Column:
    """True when the message text is a JSON object (the ingest "seen" test).

    Independent of the edit schema: a message with a wrongly typed field is
    still a parsed message.
    """
    return F.json_object_keys(F.col(col)).isNotNull()


def reject_reason(table: str = "user_edit_counts") -> Column:
    """Why a parsed edit cannot be stored in ``table`` (NULL when it can).

    The stored key columns are NOT NULL with a length limit, and an event
    without a time cannot be placed in a window.
    """
    src, _, max_len = COUNT_TABLES[table]
    key = F.col(src)
    no_time = F.col(EVENT_TIME).isNull()
    reason = (
        F.when(no_time & F.col("timestamp").isNull(), F.lit("null_timestamp"))
        .when(no_time & ~_in_range(), F.lit("timestamp_out_of_range"))
        .when(no_time, F.lit("timestamp_in_future"))
        .when(key.isNull(), F.lit(f"null_{src}"))
    )
    if max_len is not None:
        reason = reason.when(F.char_length(key) > max_len, F.lit(f"{src}_too_long"))
    return reason


def reject_reasons(table: str = "user_edit_counts") -> list[str]:
    """Every reason that ``classify`` can give for ``table``."""
    src, _, max_len = COUNT_TABLES[table]
    reasons = ["not_json", "null_timestamp", "timestamp_out_of_range", "timestamp_in_future", f"null_{src}"]
    return reasons + ([f"{src}_too_long"] if max_len is not None else [])


def classify(edits: DataFrame, table: str = "user_edit_counts") -> DataFrame:
    """Add ``reject_reason`` for ``table`` (``not_json`` for text that is no object)."""
    reason = reject_reason(table)
    if CORRUPT_COL in edits.columns:
        text = F.col(CORRUPT_COL)
        reason = F.when(text.isNotNull() & ~is_json_object(CORRUPT_COL), F.lit("not_json")).otherwise(reason)
    return edits.withColumn("reject_reason", reason)


def valid_edits(edits: DataFrame, table: str = "user_edit_counts") -> DataFrame:
    """Edits that can be counted into ``table``."""
    return edits.where(reject_reason(table).isNull())


def rejected_edits(edits: DataFrame, table: str = "user_edit_counts") -> DataFrame:
    """Edits set aside for ``table``, with the reason."""
    return classify(edits, table).where(F.col("reject_reason").isNotNull())


def namespace_filter(edits: DataFrame, namespaces: Iterable[int] | None) -> DataFrame:
    """Keep edits whose namespace is in the allow-list (None keeps all).

    A missing namespace is NULL and never matches.
    """
    if namespaces is None:
        return edits
    return edits.where(F.col("namespace").isin([int(n) for n in namespaces]))


def wiki_filter(edits: DataFrame, wikis: Iterable[str] | None) -> DataFrame:
    """Keep edits of the listed wikis; an empty list keeps all."""
    wikis = list(wikis or [])
    if not wikis:
        return edits
    return edits.where(F.col("wiki").isin(wikis))


def to_wire_json(edits: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Serialise edits back to one JSON message per row (column ``value``)."""
    fields = fields or WIRE_FIELDS
    return edits.select(F.to_json(F.struct(*fields)).alias("value"))

