"""Progress logging for the edit-count job.

``IngestLogListener`` reads the observed ingest counters of each finished
micro-batch (``observedMetrics['ingest']``) and logs the running totals
every time the sent count passes another multiple of ``every``, plus the
rows dropped by the watermark.  It runs on the driver from progress
events; it adds no job.
"""

from __future__ import annotations

import logging
from collections import deque

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

# Fixed value: log period of the ingest counters (sent events).
LOG_EVERY = 100
# Log lines kept for inspection.
KEPT_LINES = 100


class IngestLogListener(StreamingQueryListener):
    def __init__(self, every: int = LOG_EVERY, metric: str = "ingest"):
        self.every = int(every)
        self.metric = metric
        self.seen = 0
        self.sent = 0
        self.dropped = 0
        self.rejected = 0
        self.lines: deque[str] = deque(maxlen=KEPT_LINES)

    def onQueryStarted(self, event):  # noqa: N802 - Spark callback name
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        row = (p.observedMetrics or {}).get(self.metric)
        before = self.sent // self.every
        if row is not None:
            self.seen += int(row["events_seen"] or 0)
            self.sent += int(row["events_sent"] or 0)
            self.rejected += int(row.asDict().get("rejected") or 0)
        for op in p.stateOperators or []:
            self.dropped += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
        if self.sent // self.every > before:
            line = f"seen={self.seen} sent={self.sent} rejected={self.rejected} late={self.dropped}"
            self.lines.append(line)
            log.info(line)
