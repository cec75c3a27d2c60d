"""Shared helpers of the training-data operators.

Row identity: operators that compare documents identify a row by
``(id, h)``: ``id`` is ``doc_id`` (rows with a null one get ids from the top
of the range by their text, so they come after all others), ``h`` is
``xxhash64`` of the text (a null text is empty).  Rows that share a ``doc_id`` with different texts are
ordered by ``h``; rows equal in both are one document that is returned as
often as it was given.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.session import scratch_dir

MAX_ID = (1 << 63) - 1
#: Text bytes handled at once inside a task (a single longer text is handled whole).
SLICE_BYTES = 1 << 20

U = np.uint64
MIX1, MIX2, MIX3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xFF51AFD7ED558CCD)
#: Odd base of the polynomial hashes (invertible modulo 2**64) and its inverse.
BASE = U(0x5851F42D4C957F2D)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def keyed(docs: DataFrame, rest: bool = False) -> DataFrame:
    """``(doc_id, id, h, text)`` of the documents; other columns are left out or,
    with ``rest``, kept together with ``doc_id`` in a struct of that name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id, h = F.col("doc_id").cast("bigint"), F.xxhash64(text)
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(MAX_ID) - h.bitwiseAND(F.lit((1 << 42) - 1))).alias("id"),
                       h.alias("h"), text.alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")] if rest else []))


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions the caller has sized for the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def _held(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cleaned_shuffles(spark: SparkSession):
    """Within it, a finished write frees the shuffle files it was made from."""
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession, size: int = 4 << 20):
    """Within it, a write hands its Arrow functions about ``size`` bytes at once
    (a single longer row goes whole), not up to a partition of 10000 rows."""
    return _held(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def staged_small(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``staged`` within ``small_batches``: the caller's write of a result would hand
    its Arrow functions whole partitions."""
    with small_batches(spark):
        return staged(spark, df, purpose)


def staged(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage: write to the shared folder named by
    ``spark.checkpoint.dir`` and read back."""
    path = scratch_dir(spark, purpose)
    with cleaned_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(function):
    """An Arrow function whose task, when it ends, gives back what Arrow holds
    beyond need: the worker may wait idle while its executor needs the memory."""
    def whole(batches):
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return whole


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, from 0) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)):
        col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if col.null_count:
        return buffers(col.cast(pa.large_binary()).fill_null(b""))
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (at least one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def overlapping_words(data: np.ndarray, pad: int = 16) -> np.ndarray:
    """The 8 bytes from every position on, as little-endian integers (zero padded)."""
    whole = np.concatenate([data, np.zeros(pad + 8, np.uint8)])
    return np.ndarray((len(data) + pad,), "<u8", whole.data, strides=(1,))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    x = x ^ (x >> U(33))
    x = x * MIX3
    x ^= x >> U(29)
    x *= MIX1
    return x ^ (x >> U(32))


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (block prefixes and suffixes)."""
    if w == 1:
        return a.copy()
    n = len(a) - w + 1
    if n <= 0:
        return a[:0]
    blocks = -(-len(a) // w)
    full = np.full(blocks * w, np.iinfo(a.dtype).max, a.dtype)
    full[:len(a)] = a
    grid = full.reshape(blocks, w)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1:w - 1 + n])


def powers(base, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` values), one after another."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, counts)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` in concatenated texts
    (none crosses a text's end), and the index of each text's first word."""
    ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = ink[cut]
    ends[cut - 1] = ink[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``, by a polynomial's prefix sums."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U(1)) * powers(BASE, len(data)), out=sums[1:])
    inv = powers(BASE_INV, len(data) + 1)
    return mixed((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64) * MIX2)


def grams(tokens: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every ``k`` consecutive token hashes."""
    n = max(0, len(tokens) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= BASE
        out += tokens[j:j + n]
    return mixed(out)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary value: count, then dtype, length and bytes of each."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (ord(a.dtype.char), len(a))], np.int64)
    return b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])


def unpack(blob: bytes) -> list[np.ndarray]:
    k = int(np.frombuffer(blob, np.int64, 1)[0])
    head = np.frombuffer(blob, np.int64, 1 + 2 * k)[1:]
    at, out = 8 * (1 + 2 * k), []
    for i in range(k):
        kind, n = np.dtype(chr(head[2 * i])), int(head[2 * i + 1])
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * kind.itemsize
    return out


def dealt(bucket: np.ndarray, n_buckets: int, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The rows of ``arrays`` packed by bucket: ``(bucket, blob)`` for each that has any."""
    order = np.argsort(bucket.astype(np.int32), kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    arrays = [a[order] for a in arrays]
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), pack(*(a[edges[b]:edges[b + 1]] for a in arrays))


def by_key(batches: Iterator[pa.RecordBatch], key: str = "bucket") -> Iterator[tuple[object, list[dict]]]:
    """Rows of sorted batches, gathered by the value of ``key``."""
    last, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != last:
                yield last, rows
                rows = []
            last = row[key]
            rows.append(row)
    if rows:
        yield last, rows


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest unsigned type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def joined(rows: list[dict], field: str = "blob") -> list[np.ndarray]:
    """Packed arrays of several rows, concatenated."""
    return [np.concatenate(x) for x in zip(*(unpack(r[field]) for r in rows))]
