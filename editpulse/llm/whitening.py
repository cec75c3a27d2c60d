"""Embedding whitening with mixed-precision eigenvector refinement (operator 13).

Entries become whole numbers ``x = floor(64 c) + 1000000``.  The fit list holds
each distinct ``x`` vector once.  Its covariance is summed on the executors:
every task centres its rows on the whole numbers nearest to the mean before it
multiplies, so that the sums are exact integers, and the rest of the mean (less
than one half) is taken off exactly at the end.

The eigenvectors start from a float32 solver and are corrected by the
iterations of Ogita and Aishima: with ``R = I - X'X`` and ``S = X'VX`` in
extended precision, ``X += X E`` where ``E`` divides by the gaps of the
eigenvalues, which doubles the right digits each time.  Where a gap is too small
to divide by, eigenvalues form a cluster: its vectors are only made orthogonal,
and then turned by a sub-solve of ``X_c'(V - mu I)X_c``, the cluster's own small
matrix, whose entries are as small as the differences inside the cluster.

The matrix has as many rows as a vector has entries, whatever the table's
size; it is solved in one task (one thread), as numpy's linear algebra on the
driver competes with all executors of a machine.

Defined results: rows whose vector is null or holds a null, NaN or infinite
entry are dropped; a null ``vec_id`` stays null; repeated rows return as often
as given; shorter vectors (also empty ones) count as padded with zeros; entries
whose ``64 c`` is beyond 2**24 count as 2**24 of their sign.  An eigenvalue of
0 (up to rounding) cannot be whitened: ``whitened`` is null there, ``explained``
0, and ``identity_error`` is over the other components (0 if there are none).
``deviation`` is null if it exceeds 64 bits.  An empty table, or one without
usable rows, or with empty vectors only, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

SCALE = 64
SHIFT = 1_000_000
LIMIT = 1 << 24
COMPONENTS = 16
#: Rows multiplied at once.
ROWS = 4096
STEPS = 30

LD = np.longdouble


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where("v is not null").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def _quantised(batches):
    """Each row's ``x - SHIFT`` as 32-bit numbers, without zeros at the end, so that
    equal vectors are equal bytes."""
    schema = pa.schema([("vec_id", pa.int64()), ("size", pa.int32()), ("x", pa.binary())])
    for batch in batches:
        lists = batch["v"]
        flat = np.clip(np.floor(np.asarray(lists.flatten(), np.float64) * SCALE), -LIMIT, LIMIT).astype("<i4")
        edges = np.append(0, np.cumsum(np.asarray(pa.compute.list_value_length(lists), np.int64)))
        blobs = [flat[a:b].tobytes().rstrip(b"\0") for a, b in zip(edges[:-1], edges[1:])]
        blobs = [b + bytes(-len(b) % 4) for b in blobs]
        yield C.table(schema, batch["vec_id"], np.diff(edges).astype(np.int32), blobs)


def _matrix(blobs: pa.Array, d: int) -> np.ndarray:
    """``x - SHIFT`` of a batch, one row a vector of ``d`` entries."""
    data, offsets = C.buffers(blobs)
    out = np.zeros((len(blobs), d), np.int64)
    values, edges = np.frombuffer(data.tobytes(), "<i4"), offsets // 4
    size = np.diff(edges)
    out[np.repeat(np.arange(len(blobs)), size), C.ranges(np.zeros(len(size), np.int64), size)] = values
    return out


def _slices(batches, d: int):
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            yield batch.slice(i, ROWS), _matrix(batch["x"].slice(i, ROWS), d)


def _sums(d: int):
    """Per task, each dimension's number of rows and sum."""
    def sums(batches):
        n, total = 0, np.zeros(d, np.int64)
        for _, z in _slices(batches, d):
            n, total = n + len(z), total + z.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(total)], ["i", "n", "total"])

    return sums


def gram(z: np.ndarray) -> np.ndarray:
    """``z'z`` of whole numbers: exact in 64 bits, by floating-point products where
    no sum can be rounded and whole numbers else."""
    most = int(np.abs(z).max()) if z.size else 0
    if most * most * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    return z.T @ z


def _products(d: int, center: np.ndarray):
    """Per task, the rows of the sum of ``z z'``, ``z`` being ``x`` less ``center``;
    the upper and lower 32 bits apart, so that no sum leaves 64 bits."""
    schema = pa.schema([("i", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])

    def products(batches):
        high, low, any_ = np.zeros((d, d), np.int64), np.zeros((d, d), np.int64), False
        for _, z in _slices(batches, d):
            # 2**50 an entry at most, so 4096 rows stay below 2**63.
            own, any_ = gram(z - center), True
            high, low = high + (own >> 32), low + (own & 0xFFFFFFFF)
        if any_:
            yield C.table(schema, np.arange(d), list(high), list(low))

    return products


def _add_rows(batches):
    """The sum of the tasks' rows of each ``i``."""
    schema = pa.schema([("i", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])
    last, total = None, None
    for batch in batches:
        for i, high, low in zip(batch["i"].to_pylist(), batch["high"], batch["low"]):
            own = np.array([np.asarray(high.values), np.asarray(low.values)])
            if i == last:
                total = total + own
            else:
                if last is not None:
                    yield C.table(schema, [last], [total[0]], [total[1]])
                last, total = i, own
    if last is not None:
        yield C.table(schema, [last], [total[0]], [total[1]])


def clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Groups of two or more eigenvalues, in falling order, of which each is within
    ``gap`` of the next."""
    parts = np.split(np.arange(len(values)), np.flatnonzero(-np.diff(values) > gap) + 1)
    return [p for p in parts if len(p) > 1]


def refined(v: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix in extended
    precision, and the number of corrections made."""
    d, v = len(v), v.astype(LD)
    scale = max(LD(np.abs(v).max()), LD(np.finfo(np.float64).tiny))
    a = v / scale
    # Float32 eigenvectors are the start.
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x[:, ::-1].astype(LD)
    eps, eye = np.finfo(LD).eps, np.eye(d, dtype=LD)
    norm, noise = np.sqrt((a * a).sum()), 8 * d * eps
    for step in range(steps + 1):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        if step == steps or (np.abs(r).max() <= 8 * noise and np.abs(off).max() <= noise):
            break
        # What the residual cannot tell apart: the bound of Ogita and Aishima.
        delta = max(2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())), noise)
        difference = values[None, :] - values[:, None]
        close = np.abs(difference) <= delta
        x = x + x @ np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, difference))
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        for own in clusters(values, delta):
            # The sub-solve: inside the cluster only differences count.
            part, mu = x[:, own], values[own].mean()
            small = part.T @ (a @ part - mu * part)
            small = (small + small.T) / 2
            size = np.abs(small).max()
            if size > eps:  # else equal eigenvalues: any turn of them is as good
                w = np.linalg.eigh((small / size).astype(np.float64))[1][:, ::-1].astype(LD)
                w = w + w @ (np.eye(len(w), dtype=LD) - w.T @ w) / 2  # orthogonal beyond double precision
                x[:, own] = part @ w
    x = x + x @ r / 2  # what is left of R goes without touching the gaps
    values = (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order], step


def _solve(d: int, n: int, rest: list[float], k: int):
    """One row a component of the summed matrix: eigenvalue, share and vector."""
    schema = pa.schema([("component", pa.int32()), ("value", pa.float64()), ("explained", pa.float64()), ("vector", pa.list_(pa.float64()))])

    def solve(batches):
        v = np.zeros((d, d), LD)
        for batch in batches:
            for i, high, low in zip(batch["i"].to_pylist(), batch["high"], batch["low"]):
                v[i] = np.asarray(high.values).astype(LD) * LD(1 << 32) + np.asarray(low.values).astype(LD)
        mean = np.array(rest, LD)
        v = v / n - mean[:, None] * mean[None, :]
        values, x, _ = refined(v)
        trace = np.trace(v)
        real = values > trace * d * np.finfo(np.float64).eps
        x = x / np.sqrt((x * x).sum(axis=0))
        yield C.table(schema, np.arange(1, k + 1, dtype=np.int32), [float(e) if ok else 0.0 for e, ok in zip(values[:k], real)],
                      [float(e / trace) if ok else 0.0 for e, ok in zip(values[:k], real)], list(x[:, :k].T.astype(np.float64)))

    return solve


class Whitening:
    """A fitted whitening: ``n``, sums, and up to ``k`` components."""

    def __init__(self, n: int, total: np.ndarray, components: list):
        self.n, self.total, self.d = n, total, len(total)
        self.values = np.array([c["value"] for c in components])
        self.explained = [c["explained"] for c in components]
        self.vectors = np.array([c["vector"] for c in components]).reshape(len(components), self.d)

    def project(self, z: np.ndarray) -> np.ndarray:
        """Whitened rows of ``x - SHIFT``; 0 where there is nothing to whiten."""
        real = self.values > 0
        centred = (self.n * z - self.total) / self.n  # a whole number by a whole number
        return (centred @ self.vectors.T) * np.where(real, 1 / np.sqrt(np.where(real, self.values, 1)), 0)

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """``sum((n x - S)**2)`` of each row."""
        off = self.n * z - self.total
        most = int(np.abs(off).max()) if off.size else 0
        if most * most * self.d < 1 << 63:
            return (off * off).sum(axis=1).tolist()
        exact = [int(t) for t in (off.astype(object) ** 2).sum(axis=1)]
        return [t if t < 1 << 63 else None for t in exact]


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, size, x`` of ``usable`` rows."""
    return vectors.mapInArrow(_quantised, "vec_id bigint, size int, x binary")


def fit(rows: DataFrame, k: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of ``quantised`` rows and their fit list, None without any entry."""
    spark = rows.sparkSession
    n_parts = C.partitions(spark)
    # Equal vectors meet after each task has dropped its own repeats.
    distinct = C.staged(spark, rows.select("x").distinct(), "whitening-fit")
    d = rows.agg(F.max("size")).first()[0]
    if not d:
        return None
    sums = distinct.mapInArrow(_sums(d), "i bigint, n bigint, total bigint").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    sums = sorted(sums.collect(), key=lambda r: r["i"])  # a row a dimension
    n, total = sums[0]["n"], np.array([r["total"] for r in sums], np.int64)
    center = np.array([(2 * int(t) + n) // (2 * n) for t in total], np.int64)
    rest = [float(int(t) - n * int(c)) / n for t, c in zip(total, center)]
    matrix = distinct.mapInArrow(_products(d, center), "i bigint, high array<bigint>, low array<bigint>")
    matrix = matrix.repartition(min(n_parts, d), "i").sortWithinPartitions("i").mapInArrow(_add_rows, "i bigint, high array<bigint>, low array<bigint>")
    solved = matrix.coalesce(1).mapInArrow(_solve(d, n, rest, min(k, d)), "component int, value double, explained double, vector array<double>")
    return Whitening(n, total, solved.orderBy("component").collect()), distinct


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """The largest entry of the covariance of the whitened fit list, less the identity."""
    k = len(model.values)

    def products(batches):
        total, n, s = np.zeros(k), 0, np.zeros((k, k))
        for _, z in _slices(batches, model.d):
            w = model.project(z)
            total, n, s = total + w.sum(axis=0), n + len(w), s + w.T @ w
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total), pa.array(list(s))], ["i", "total", "row"])

    # Rows a component and task; summed by entry, k * k at last.
    parts = distinct.mapInArrow(products, "i bigint, total double, row array<double>").select("i", "total", F.posexplode("row").alias("j", "s"))
    cells = parts.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("total").alias("total")).collect()
    mean = {c["i"]: c["total"] / model.n for c in cells}
    return max([0.0] + [abs(c["s"] / model.n - mean[c["i"]] * mean[c["j"]] - (c["i"] == c["j"])) for c in cells
                        if model.values[c["i"]] > 0 and model.values[c["j"]] > 0])


def whiten(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Per row of ``embeddings`` and component ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    spark = rows.sparkSession
    shape = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    x = C.staged(spark, quantised(usable(rows)), "whitening-rows")
    fitted = fit(x, k)
    if fitted is None:
        return spark.createDataFrame([], shape)
    model, distinct = fitted
    error = identity_error(model, distinct)
    k = len(model.values)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def out(batches):
        for batch, z in _slices(batches, model.d):
            m = len(batch)
            at = np.repeat(np.arange(m), k)
            whitened = pa.array(model.project(z).ravel(), mask=np.tile(model.values <= 0, m))
            yield C.table(schema, batch["vec_id"].take(pa.array(at)), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n),
                          pa.array(model.deviations(z), pa.int64()).take(pa.array(at)), whitened, np.tile(model.explained, m), np.full(m * k, error))

    return x.mapInArrow(out, shape)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(C.read(spark, sf_dir, "embeddings"))
