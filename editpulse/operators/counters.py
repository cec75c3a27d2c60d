"""Ingest counters: messages seen (parsed as JSON objects) and sent
(passed the namespace allow-list).

Batch: one global aggregate of two ``count_if``s (partial per task, one
final row).  Streaming: the same expressions through ``DataFrame.observe``,
reported in each micro-batch's progress without an extra job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions.parse import classify, is_json_object, reject_reasons
from editpulse.schema import CORRUPT_COL


def _seen() -> Column:
    """The message parsed as a JSON object.

    A clean typed parse (no corrupt record) settles it without more work;
    only messages flagged corrupt are re-checked, to tell a wrongly typed
    field (still a parsed message) from text that is not JSON.  ``CASE`` is
    lazy, so the second parse runs on flagged rows only.
    """
    return (
        F.when(F.col(CORRUPT_COL).isNull(), F.col("raw").isNotNull())
        .otherwise(is_json_object("raw"))
    )


def _sent(namespaces: Iterable[int] | None) -> Column:
    ok = _seen()
    if namespaces is None:
        return ok
    return ok & F.coalesce(F.col("namespace").isin([int(n) for n in namespaces]), F.lit(False))


def counter_columns(namespaces: Iterable[int] | None) -> list[Column]:
    """Aggregate columns over parsed messages (``parse_edits(keep_raw=True)``)."""
    namespaces = None if namespaces is None else list(namespaces)
    return [
        F.count_if(_seen()).alias("events_seen"),
        F.count_if(_sent(namespaces)).alias("events_sent"),
    ]


def ingest_counters(parsed: DataFrame, namespaces: Iterable[int] | None = (0,)) -> DataFrame:
    """One row ``(events_seen, events_sent)``."""
    return parsed.agg(*counter_columns(namespaces))


def observe_counters(parsed: DataFrame, name: str = "ingest", namespaces: Iterable[int] | None = (0,),
                     table: str = "user_edit_counts") -> DataFrame:
    """``parsed``, classified for ``table``, with the counters attached as observed
    metrics: messages, those seen and sent, and those rejected, by the reason that
    the rejects table states."""
    if "reject_reason" not in parsed.columns:
        parsed = classify(parsed, table)
    reason = F.col("reject_reason")
    return parsed.observe(
        name, *counter_columns(namespaces), F.count(F.lit(1)).alias("messages"), F.count(reason).alias("rejected"),
        *[F.count_if(reason == r).alias(f"rejected_{r}") for r in reject_reasons(table)],
    )
