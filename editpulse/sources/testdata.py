"""The driver's Parquet tables as edit-stream input.

The ``events`` table stands in for the edit feed.  One event becomes one
edit:

* ``id``        = ``event_id`` as text
* ``title``     = ``'Page_' || k`` with ``k`` the integer ``props.k``
* ``user``      = ``'user_' || user_id``
* ``type``      = ``event_type``
* ``namespace`` = ``k % 4``
* ``timestamp`` = whole Unix seconds of ``ts`` (``ts`` is a UTC wall clock)
* ``wiki``      = one of ``TEST_WIKIS`` per user, ``TEST_WIKIS[user_id % 3]``
  (the data has no wiki column; every user edits one wiki)

``wire_messages`` serialises these edits to JSON text (what a topic holds)
and ``sse_capture`` wraps them in SSE framing, so that the real parser runs
on derived input.  In the SSE capture the ``error``-type events carry their
``timestamp`` as a JSON string, the kind of schema drift the parser must
set aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.parse import WIRE_FIELDS, with_event_time
from editpulse.functions.time import ntz_literal

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed value: event type whose SSE frames carry a string-typed timestamp.
DRIFT_EVENT_TYPE = "error"

# Wiki names the test map assigns to users (by user_id % 3).
TEST_WIKIS = ("enwiki", "dewiki", "frwiki")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _wiki_of(user_id: Column) -> Column:
    wikis = F.array(*[F.lit(w) for w in TEST_WIKIS])
    return F.element_at(wikis, (F.pmod(user_id, F.lit(len(TEST_WIKIS))) + 1).cast("int"))


def _page_key() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def _events(spark: SparkSession, sf_dir: str, since_epoch: int | None,
            until_epoch: int | None = None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    # Plain ranges on the stored column: they reach the Parquet scan as
    # pushed filters (row-group / partition skipping at scale).
    if since_epoch is not None:
        ev = ev.where(F.col("ts") >= ntz_literal(since_epoch))
    if until_epoch is not None:
        ev = ev.where(F.col("ts") < ntz_literal(until_epoch))
    return ev


def event_time_bounds(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """(first, last) whole event second of ``events``: one aggregate row."""
    row = read_table(spark, sf_dir, "events").agg(
        F.unix_timestamp(F.min("ts")).alias("lo"), F.unix_timestamp(F.max("ts")).alias("hi")
    ).first()
    return int(row["lo"]), int(row["hi"])


def edit_events(spark: SparkSession, sf_dir: str, since_epoch: int | None = None,
                until_epoch: int | None = None, page_fields: bool = True) -> DataFrame:
    """Typed edits (the parser's output for clean input) from ``events``.

    The page key is read out of the JSON text by a generator, once a row: as a
    plain projection it would be copied into the title, the namespace and each
    filter on them.  ``page_fields=False`` leaves title and namespace
    out, and with them the JSON text.

    ``since_epoch`` / ``until_epoch`` restrict to events in
    ``[since, until)`` (whole seconds); callers use them to push a
    window-start range, or a replay chunk, down to the scan.
    """
    ev = _events(spark, sf_dir, since_epoch, until_epoch)
    if page_fields:
        ev = ev.select("event_id", "user_id", "event_type", "ts", F.inline(F.array(F.struct(_page_key().alias("k")))))
    k = F.col("k")
    edits = ev.select(
        F.col("event_id").cast("string").alias("id"),
        *([F.concat(F.lit("Page_"), k.cast("string")).alias("title")] if page_fields else []),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        F.col("event_type").alias("type"),
        *([(k % 4).alias("namespace")] if page_fields else []),
        F.unix_timestamp(F.col("ts")).alias("timestamp"),
        _wiki_of(F.col("user_id")).alias("wiki"),
    )
    return with_event_time(edits)


def wire_messages(spark: SparkSession, sf_dir: str, since_epoch: int | None = None) -> DataFrame:
    """One JSON message per event, column ``value`` (a replayed topic)."""
    edits = edit_events(spark, sf_dir, since_epoch)
    return edits.select(F.to_json(F.struct(*WIRE_FIELDS)).alias("value"))


# What is wrong with the messages of ``faulty_messages``, by
# ``event_id % FAULT_CYCLE``; all others are clean.
FAULT_CYCLE = 20
FAULTS = ("cut off", "no timestamp", "timestamp as text", "timestamp overflows", "timestamp in the year 3000",
          "no user", "user too long", "no title", "title too long")
FAR_SECOND, NO_SECOND = 32503680000, 9223372036854775807


def faulty_messages(edits: DataFrame) -> DataFrame:
    """Wire messages of ``edits``, of which some have each fault a feed can show."""
    fault = F.pmod(F.col("id").cast("bigint"), F.lit(FAULT_CYCLE))
    is_ = lambda name: fault == FAULTS.index(name)
    stamp = (
        F.when(is_("timestamp overflows"), F.lit(NO_SECOND)).when(is_("timestamp in the year 3000"), F.lit(FAR_SECOND))
        .when(~is_("no timestamp"), F.col("timestamp"))
    )
    user = F.when(is_("user too long"), F.repeat(F.lit("u"), 256)).when(~is_("no user"), F.col("user"))
    title = F.when(is_("title too long"), F.repeat(F.lit("t"), 501)).when(~is_("no title"), F.col("title"))
    shown = {"timestamp": stamp, "user": user, "title": title}
    message = lambda fields: F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    clean = message([shown.get(f, F.col(f)).alias(f) for f in WIRE_FIELDS])
    drift = message([F.col(f).cast("string").alias(f) if f == "timestamp" else F.col(f) for f in WIRE_FIELDS])
    cut = F.concat(F.lit("cut off: "), F.col("id"))
    return edits.select(F.when(is_("cut off"), cut).when(is_("timestamp as text"), drift).otherwise(clean).alias("value"))


def feed_lines(edits: DataFrame) -> DataFrame:
    """SSE text of messages with more fields than the parser knows (``wiki``,
    ``bot`` and a nested ``meta``)."""
    bot = (F.col("id").cast("bigint") % 2 == 0).alias("bot")
    meta = F.struct(F.concat(F.lit("evt-"), F.col("id")).alias("id"), F.lit("example").alias("domain")).alias("meta")
    payload = F.to_json(F.struct(*WIRE_FIELDS, "wiki", bot, meta))
    return edits.select(F.explode(F.array(F.lit(":ok"), F.concat(F.lit("id: "), F.col("id")), F.concat(F.lit("data: "), payload), F.lit(""))).alias("value"))


def sse_lines(edits: DataFrame) -> DataFrame:
    """SSE text of edits, the drifted ones of ``sse_capture`` included."""
    return _framed(edits)


def sse_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SSE text lines, four per event: ``event:``, ``id:``, ``data:``, blank."""
    return _framed(edit_events(spark, sf_dir))


def _framed(edits: DataFrame) -> DataFrame:
    drift = F.col("type") == F.lit(DRIFT_EVENT_TYPE)
    clean = F.to_json(F.struct(*WIRE_FIELDS))
    drifted = F.to_json(
        F.struct(
            *[
                F.col(f).cast("string").alias(f) if f == "timestamp" else F.col(f)
                for f in WIRE_FIELDS
            ]
        )
    )
    payload = F.when(drift, drifted).otherwise(clean)
    lines = F.array(
        F.lit("event: message"),
        F.concat(F.lit("id: "), F.col("id")),
        F.concat(F.lit("data: "), payload),
        F.lit(""),
    )
    return edits.select(F.explode(lines).alias("value"))
