"""Replay a table of edits as a stream that arrives in time-ordered chunks.

The driver's tables are static; to exercise micro-batches, state and the
upsert sink, the edits are cut into ``n_chunks`` consecutive event-time
ranges.  For each chunk: Spark writes its JSON messages as new text files
into the landing directory, then the job runs with ``availableNow`` on the
same checkpoint and picks up exactly the new files, as a restarted job
would.  Batch boundaries therefore follow the chunks, independent of file
modification times or file counts; every chunk is written in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from editpulse.functions.parse import to_wire_json

# edits_between(lo, hi) -> edits with event second in [lo, hi)
EditsBetween = Callable[[int, int], DataFrame]


def chunk_edges(lo: int, hi: int, n_chunks: int) -> list[int]:
    """``n_chunks + 1`` second boundaries covering ``[lo, hi]``."""
    if n_chunks < 1:
        raise ValueError("n_chunks must be >= 1")
    span = hi - lo + 1
    step = -(-span // n_chunks)
    return [lo + i * step for i in range(n_chunks)] + [hi + 1]


def land_chunk(edits: DataFrame, landing: str, i: int, as_lines: Callable[[DataFrame], DataFrame] = to_wire_json) -> str:
    """Write one chunk's text lines (JSON messages) as new files; returns the directory."""
    path = f"{landing.rstrip('/')}/c{i:05d}"
    as_lines(edits).write.mode("overwrite").text(path)
    return path


def replay_parts(parts: Sequence[DataFrame], landing: str, run_job: Callable[[int], None],
                 as_lines: Callable[[DataFrame], DataFrame] = to_wire_json) -> int:
    """Land each part, in whatever order of event time its edits are, then run the job."""
    for i, edits in enumerate(parts):
        land_chunk(edits, landing, i, as_lines)
        run_job(i)
    return len(parts)


def replay_chunks(
    edits_between: EditsBetween,
    bounds: tuple[int, int],
    landing: str,
    n_chunks: int,
    run_job: Callable[[int], None],
    order: Sequence[int] | None = None,
    as_lines: Callable[[DataFrame], DataFrame] = to_wire_json,
) -> int:
    """Land chunk ``i`` (event seconds ``[edge_i, edge_i+1)``), then ``run_job(i)``.

    ``order`` is the delivery order of the chunks (default: time order); a
    chunk delivered after later ones arrives late.  ``edits_between``
    should push its range to the scan so that each chunk reads only its
    own part of the input.
    """
    edges = chunk_edges(bounds[0], bounds[1], n_chunks)
    order = list(range(n_chunks)) if order is None else list(order)
    if sorted(order) != list(range(n_chunks)):
        raise ValueError("order must deliver every chunk exactly once")
    for landed, i in enumerate(order):
        land_chunk(edits_between(edges[i], edges[i + 1]), landing, landed, as_lines)
        run_job(i)
    return n_chunks
