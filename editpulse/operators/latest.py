"""Latest version per key: the read side of the versioned upsert table.

An update-mode stream emits the running total of a key again whenever it
changes, so a stored key can have several versions; the one with the
highest batch id is current.  This is a single aggregate, no self-join:
one ``max_by(value, version)`` per value column.  Each has a fixed-width
buffer, so Spark plans a hash aggregate with a partial (map-side) step;
a hot key reaches the shuffle as one row per map task.  (``max_by`` over a
struct of the values would force a sort-based aggregate.)

The per-column picks come from the same row because a key has at most one
row per version (a micro-batch emits a key once; a repeated compaction
writes identical rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], version_col: str, values: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the ``values`` of the highest ``version_col``."""
    version = F.col(version_col)
    aggs = [
        (F.max(version) if v == version_col else F.max_by(F.col(v), version)).alias(v)
        for v in values
    ]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *values)
