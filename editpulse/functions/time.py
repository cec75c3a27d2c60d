"""Event-time helpers.

All time arithmetic is done on epoch seconds so that results do not
depend on the session time zone.  ``as_of`` replaces the ``NOW()`` /
``CURRENT_DATE`` of the stored dashboard queries: every time-relative
query takes it as an argument, which makes results reproducible.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def epoch_seconds(value: dt.datetime | str | int | float) -> int:
    """Whole epoch seconds of a point in time; naive values are UTC."""
    if isinstance(value, (int, float)):
        return int(value)
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return calendar.timegm(value.timetuple())


def ts_literal(value) -> Column:
    """A TimestampType literal for ``value`` (naive = UTC)."""
    return F.timestamp_seconds(F.lit(epoch_seconds(value)))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal holding the UTC wall clock of ``value``."""
    return _epoch_ntz() + F.make_dt_interval(secs=F.lit(epoch_seconds(value)))


def utc_wallclock(col: Column | str) -> Column:
    """TIMESTAMP_NTZ with the UTC wall clock of an instant column.

    The instant's epoch microseconds added to the NTZ epoch: pure
    arithmetic, so it does not depend on the session time zone, unlike
    ``cast(... as timestamp_ntz)``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def minutes_before(as_of, minutes: int) -> int:
    """Epoch seconds of ``as_of - minutes``."""
    return epoch_seconds(as_of) - int(minutes) * 60


def start_of_day(as_of) -> int:
    """Epoch seconds of midnight (UTC) of the day containing ``as_of``."""
    secs = epoch_seconds(as_of)
    return secs - secs % 86400


def first_event_second(window_start_bound: int, step_seconds: int) -> int:
    """Smallest event time whose windows can start at or after the bound.

    Windows are epoch-aligned on their step: an event at ``t`` belongs to
    windows starting at most ``floor(t / step) * step``.  So
    ``window_start >= bound`` for some window of the event iff
    ``t >= ceil(bound / step) * step``.  This turns a predicate on the
    computed window into a range on the raw event time that a columnar
    scan can use.
    """
    step = int(step_seconds)
    return -(-int(window_start_bound) // step) * step
