"""Typed job options, validated when they are built.

Only settings that change what is computed are options; network,
container and logging settings of a deployment are not modelled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Defaults of the edit-count job.
DEFAULT_WINDOW = "1 minute"
DEFAULT_WATERMARK = "2 minutes"
DEFAULT_TRIGGER = "30 seconds"
DEFAULT_NAMESPACES = (0,)
DEFAULT_STARTING_OFFSETS = "latest"
DEFAULT_JDBC_BATCH_SIZE = 1000
DEFAULT_RETENTION_DAYS = 30
DEFAULT_MAX_FUTURE_SKEW = "1 hour"

OUTPUT_MODES = ("update", "append")

_UNITS = {
    "second": 1,
    "seconds": 1,
    "minute": 60,
    "minutes": 60,
    "hour": 3600,
    "hours": 3600,
    "day": 86400,
    "days": 86400,
    "week": 7 * 86400,
    "weeks": 7 * 86400,
}
_DURATION = re.compile(r"^\s*(\d+)\s+([a-zA-Z]+)\s*$")


def duration_seconds(text: str) -> int:
    """Whole seconds of a duration such as ``'1 minute'`` or ``'2 hours'``."""
    m = _DURATION.match(text or "")
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a duration: {text!r}")
    secs = int(m.group(1)) * _UNITS[m.group(2).lower()]
    if secs <= 0:
        raise ValueError(f"duration must be positive: {text!r}")
    return secs


@dataclass(frozen=True)
class WindowSpec:
    """Event-time window: tumbling when ``slide`` is None."""

    duration: str = DEFAULT_WINDOW
    slide: str | None = None

    def __post_init__(self):
        d = duration_seconds(self.duration)
        if self.slide is not None:
            s = duration_seconds(self.slide)
            if s > d:
                raise ValueError("slide must not exceed the window duration")

    @property
    def seconds(self) -> int:
        return duration_seconds(self.duration)

    @property
    def step_seconds(self) -> int:
        return duration_seconds(self.slide) if self.slide else self.seconds


@dataclass(frozen=True)
class JobOptions:
    """Options of the streaming edit-count job."""

    window: WindowSpec = field(default_factory=WindowSpec)
    watermark: str = DEFAULT_WATERMARK
    trigger: str | None = DEFAULT_TRIGGER  # None => availableNow
    output_mode: str = "update"
    namespaces: tuple[int, ...] | None = DEFAULT_NAMESPACES  # None => all
    wikis: tuple[str, ...] = ()  # empty => all
    sse_framed: bool = False  # input lines carry SSE framing
    max_files_per_trigger: int | None = None
    # Run micro-batches without new data when the watermark moved (Spark's
    # default).  In update mode they only evict state and emit nothing.
    idle_batches: bool = True
    state_partitions: int | None = None  # None => the session's shuffle partitions
    state_store: str | None = None  # None => the session's provider; "rocksdb"
    # Edits stamped further ahead of the time their message was taken in are
    # rejected before they can move the watermark.  None accepts any time.
    max_future_skew: str | None = DEFAULT_MAX_FUTURE_SKEW

    def __post_init__(self):
        duration_seconds(self.watermark)
        if self.trigger is not None:
            if self.trigger.strip().lower().startswith("continuous"):
                # Continuous processing has no stateful aggregates.
                raise ValueError("continuous trigger cannot run the windowed count")
            duration_seconds(self.trigger)
        if self.output_mode not in OUTPUT_MODES:
            raise ValueError(f"output_mode must be one of {OUTPUT_MODES}")
        if self.namespaces is not None and not all(
            isinstance(n, int) for n in self.namespaces
        ):
            raise ValueError("namespaces must be integers")
        if self.max_files_per_trigger is not None and self.max_files_per_trigger < 1:
            raise ValueError("max_files_per_trigger must be >= 1")
        if not self.idle_batches and self.output_mode == "append":
            # Append mode emits a window in the batch after the watermark
            # passes it; without idle batches the last windows never leave.
            raise ValueError("append mode needs idle batches")
        if self.state_store not in (None, "rocksdb"):
            raise ValueError("state_store must be None or 'rocksdb'")
        if self.max_future_skew is not None:
            duration_seconds(self.max_future_skew)
        if self.state_partitions is not None and self.state_partitions < 1:
            raise ValueError("state_partitions must be >= 1")
