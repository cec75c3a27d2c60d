"""Exact top-k inner products over a bit-sliced index (operator 3).

Each component becomes ``floor(scale * x)``, less the least value of its
dimension in a block of rows; its quantised bits (the upper ones) are stored as
*slices*, one bitmap of rows for each dimension and bit.  A query's scores over
a block are the sum of its weights times the slices: bitmaps of one weight are
added three at a time by bitwise carry-save adders, until every weight has one
bitmap, the slices of the score.  Walking them from the most significant
downward finds the k-th best quantised score with counts of set bits; the
dropped lower bits bound how far the true score can be, and the rows inside
that margin are resolved by exact integer inner products.

Queries travel to the rows: the blocks are dealt into parts, the query blocks
are copied to every part (as numbers, without slices), and a task passes them
over the blocks it holds and keeps the k best of its part.  With more tasks than
blocks, the query blocks are dealt into shares too, and a part is copied to each
share.  There is no join, so no side's size is guessed and none is broadcast.

Defined results: a null vector, or one with a null, NaN or infinite component,
takes no part, nor does a null ``vec_id``; shorter vectors count as padded with
zeros; of several vectors under one ``vec_id`` the least (as an array) is
taken; ties go to the smaller ``vec_id``; with fewer than k other rows all are
returned.  Components must stay under 2**40 / scale, so that scores are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import common as C

SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 256
#: Most index blocks of a part: a task holds one part at a time.
HELD_BLOCKS = 8
#: Lowest bits of a component that the slices leave to the exact step.
DROPPED_BITS = 2


def _matrix(rows: list[np.ndarray], dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest signed type that holds them."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def build(vectors: np.ndarray, dropped: int) -> np.ndarray:
    """The slices ``(dimension, bit, word of 64 rows)`` of what is above each
    dimension's least value, without the ``dropped`` lowest bits."""
    least = vectors.min(axis=0)
    above = (vectors - least).astype(np.uint64) >> np.uint64(dropped)
    bits = max(1, int(above.max()).bit_length())
    words = -(-len(vectors) // 64)
    flags = np.zeros((vectors.shape[1], bits, words * 64), np.uint8)
    for b in range(bits):
        flags[:, b, :len(vectors)] = (above.T >> np.uint64(b)) & np.uint64(1)
    return np.packbits(flags, axis=2, bitorder="little").view(np.uint64)


def add_slices(slices: np.ndarray, weights: np.ndarray, valid: np.ndarray) -> list[np.ndarray]:
    """Slices of ``sum(weights * attribute)`` up to a constant, least significant
    first; a negative weight adds its size times the complement."""
    bits = slices.shape[1]
    size = np.abs(weights)
    columns: dict[int, list[np.ndarray]] = {}
    for t in range(int(size.max()).bit_length() if len(size) else 0):
        has = (size >> t) & 1 == 1
        plus, minus = has & (weights > 0), has & (weights < 0)
        for b in range(bits):
            columns.setdefault(t + b, []).append(np.concatenate([slices[plus, b], ~slices[minus, b] & valid]))
    out, at = [], 0
    while columns:
        stack = columns.pop(at, None)
        if stack is None:
            out.append(np.zeros_like(valid))
        else:
            stack = np.concatenate(stack)
            while len(stack) > 1:
                k = len(stack) // 3 * 3
                a, b, c = (stack[i:k:3] for i in range(3)) if k else (stack[:1], stack[1:2], np.zeros((1, len(valid)), np.uint64))
                rest = stack[k:] if k else stack[:0]
                half = a ^ b
                columns.setdefault(at + 1, []).append((a & b) | (c & half))
                stack = np.concatenate([half ^ c, rest])
            out.append(stack[0] if len(stack) else np.zeros_like(valid))
        at += 1
    return out


def kth_best(score: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest number in the slices among ``rows`` (k at most their count)."""
    value, open_ = 0, rows
    for b in range(len(score) - 1, -1, -1):
        high = open_ & score[b]
        n = int(np.bitwise_count(high).sum())
        if n >= k:
            open_, value = high, value | 1 << b
        else:
            k, open_ = k - n, open_ & ~score[b]
    return value


def at_least(score: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows whose number is ``value`` or more."""
    if value <= 0:
        return rows
    if value >> len(score):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for b in range(len(score) - 1, -1, -1):
        if value >> b & 1:
            equal = equal & score[b]
        else:
            above, equal = above | (equal & score[b]), equal & ~score[b]
    return above | equal


def numbers(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


def top(slices, vectors, valid, ids, query, query_id, k, dropped):
    """The k best rows of a block for one query: ``(vec_id, score)``."""
    rows = valid.copy()
    own = np.searchsorted(ids, query_id)
    if own < len(ids) and ids[own] == query_id:
        rows[own // 64] &= ~np.uint64(1 << int(own % 64))
    n = int(np.bitwise_count(rows).sum())
    if n > k:
        score = add_slices(slices, query, valid)
        if score:
            # A row's true sum is its quantised one, times 2**dropped, and up
            # to this much more or, for complemented weights, less.
            spread = int(np.abs(query).sum()) * ((1 << dropped) - 1) >> dropped
            rows = at_least(score, rows, kth_best(score, rows, k) - spread - 1)
    at = numbers(rows, len(ids))
    exact = vectors[at].astype(np.int64) @ query
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order], exact[order]


def _blocks(scale: int, dims: int, dropped: int | None = None):
    """One row a block: ids, integer vectors and, with ``dropped``, slices."""
    schema = pa.schema([("block", pa.int64()), ("blob", pa.binary())])

    def blocks(batches):
        for block, rows in C.by_key(batches, "block"):
            rows.sort(key=lambda r: r["vec_id"])
            ids = np.array([r["vec_id"] for r in rows], np.int64)
            vectors = _matrix([np.floor(np.asarray(r["v"], np.float64) * scale).astype(np.int64) for r in rows], dims)
            slices = [] if dropped is None else [build(vectors, dropped)]
            yield C.table(schema, [block], [C.pack(ids, *(x for a in slices for x in (np.array(a.shape), a.ravel())), _narrow(vectors).ravel())])

    return blocks


def _search(k: int, dims: int, dropped: int):
    """The ``k`` best rows of a part for each query: of every cell the index
    blocks (``q`` -1) come first, then the query blocks."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def held(blob):
        ids, shape, slices, vectors = C.unpack(blob)
        slices = slices.reshape(shape)
        valid = np.packbits(np.arange(slices.shape[2] * 64) < len(ids), bitorder="little").view(np.uint64)
        return slices, vectors.reshape(len(ids), dims), valid, ids

    def search(batches):
        last, part = None, []
        for batch in batches:
            for cell, q, blob in zip(batch["cell"].to_pylist(), batch["q"].to_pylist(), batch["blob"]):
                if cell != last:
                    last, part = cell, []
                if q < 0:
                    part.append(held(blob.as_py()))
                    continue
                query_ids, weights = C.unpack(blob.as_py())
                best = [(query_ids[:0], query_ids[:0], query_ids[:0])]
                for query_id, query in zip(query_ids.tolist(), weights.reshape(-1, dims).astype(np.int64)):
                    found, score = (np.concatenate(x) for x in zip((query_ids[:0], query_ids[:0]), *(top(*block, query, query_id, k, dropped) for block in part)))
                    order = np.lexsort((found, -score))[:k]
                    best.append((np.full(len(order), query_id), found[order], score[order]))
                yield C.table(schema, *(np.concatenate(x) for x in zip(*best)))

    return search


def _grid(n: int, n_blocks: int, n_queries: int) -> tuple[int, int]:
    """Parts of the index and shares of the query blocks, about ``n`` pairs of
    them, or more if a part would pass ``HELD_BLOCKS``."""
    parts = max(min(n, n_blocks), -(-n_blocks // HELD_BLOCKS))
    return parts, min(n_queries, -(-n // parts))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE, dropped: int = DROPPED_BITS,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best rows.

    Both inputs hold ``(vec_id bigint, v array<double>)`` from ``usable``."""
    spark, n = vectors.sparkSession, C.partitions(vectors.sparkSession)
    with C.cleaned_shuffles(spark):
        size, dims = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
        n_queries = -(-queries.count() // query_rows) or 1
    if not size:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dims = max(1, dims)
    n_blocks = -(-size // block_rows)
    parts, shares = _grid(n, n_blocks, n_queries)
    n_queries = -(-n_queries // shares) * shares
    blocked = lambda df, count: df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count))).repartition(n, "block").sortWithinPartitions("block")
    copied = lambda count: F.explode(F.expr(f"sequence(0L, {count - 1}L)"))
    index = blocked(vectors, n_blocks).mapInArrow(_blocks(scale, dims, dropped), "block bigint, blob binary")
    asked = blocked(queries, n_queries).mapInArrow(_blocks(scale, dims), "block bigint, blob binary")
    index = index.select((F.col("block") % parts).alias("part"), copied(shares).alias("share"), F.lit(-1).cast("bigint").alias("q"), "blob")
    asked = asked.select(copied(parts).alias("part"), (F.col("block") % shares).alias("share"), F.col("block").alias("q"), "blob")
    met = index.union(asked).select((F.col("part") * shares + F.col("share")).alias("cell"), "q", "blob")
    met = met.repartitionById(n, (F.col("cell") % n).cast("int")).sortWithinPartitions("cell", "q")
    best = met.mapInArrow(_search(k, dims, dropped), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part, one for each id."""
    v = F.col(vector).cast("array<double>")
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))).groupBy("vec_id").agg(F.min("v").alias("v"))


def op3_exact_top_k(spark, sf_dir: str) -> DataFrame:
    rows = usable(C.read(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where("vec_id % 50 = 0"))
