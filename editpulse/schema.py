"""Schemas of the edit model and of the count tables.

Nothing is inferred anywhere in the package: every reader passes one of
these schemas explicitly.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column holding the raw text of a record that did not parse cleanly.
CORRUPT_COL = "_corrupt_record"

# Wire schema of one edit event (JSON message body).  ``timestamp`` is Unix
# seconds.  ``wiki`` is optional on the wire; it is only used by the wiki
# allow-list filter and is NULL when absent.
EDIT_FIELDS = [
    ("id", T.StringType()),
    ("title", T.StringType()),
    ("user", T.StringType()),
    ("type", T.StringType()),
    ("namespace", T.LongType()),
    ("timestamp", T.LongType()),
    ("wiki", T.StringType()),
]

EDIT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EDIT_FIELDS])

# Parse schema: the wire schema plus the corrupt-record column that
# ``from_json`` fills in PERMISSIVE mode.
EDIT_PARSE_SCHEMA = T.StructType(
    EDIT_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)]
)

# Name of the event-time column added by the parser (TimestampType, UTC).
EVENT_TIME = "event_time"

# Column-length limits of the count tables (VARCHAR sizes of
# the stored key columns).
MAX_USER_NAME_LEN = 255
MAX_PAGE_TITLE_LEN = 500

# Count-table layouts: (key column in the edit model, key column in the
# table, maximum key length or None).
COUNT_TABLES = {
    "user_edit_counts": ("user", "user_name", MAX_USER_NAME_LEN),
    "namespace_edit_counts": ("namespace", "namespace", None),
    "top_pages": ("title", "page_title", MAX_PAGE_TITLE_LEN),
}

# Schema of the SSE capture / topic replay input: one text line per row.
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


def count_table_schema(table: str) -> T.StructType:
    """Schema of a stored count table (without storage-only columns)."""
    _, key, _ = COUNT_TABLES[table]
    key_type = T.LongType() if key == "namespace" else T.StringType()
    return T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), False),
            T.StructField("window_end", T.TimestampType(), False),
            T.StructField(key, key_type, False),
            T.StructField("edit_count", T.LongType(), False),
        ]
    )
