"""Hard-negative mining over STR-packed R-trees (operator 12).

Rows are sorted by label and first coordinate over all tasks and cut into blocks
of one label; each block is an R-tree packed by sort-tile-recursion: its rows
are tiled along one coordinate after another (widest spread first), a leaf is a
tile, and every node keeps its minimum bounding box.  For a query ``q`` the box
``[lo, hi]`` bounds the inner product of whatever it holds coordinate by
coordinate: at most ``sum(max(q lo, q hi))``, at least ``sum(min(q lo, q hi))``.
A best-first queue opens the node with the highest upper bound; nodes whose
interval misses all score windows, or lies strictly below the k-th best found
in each window that it meets, are never opened.

Only queries travel: blocks of 256 of them are copied to the index blocks, dealt
out by block number, so one index block and one block of queries are in a task's
memory.  A query meets the index in rounds of 1, 8, 64, ... blocks, in an order
of its own, and takes its k-th best along as the bound of the next round; so the rows
that rounds emit grow with the logarithm of the number of blocks.

First the positives (blocks of the anchor's label, one open window), then the
negatives (blocks of other labels, a window for each positive).

Defined results: rows with a null label, ``vec_id`` or vector, or a null, NaN or infinite
component take no part; shorter vectors count as padded with zeros; scaled
components beyond 2**24 count as 2**24 of their sign, so scores are exact in 64
bits (up to 2**14 components).  Each row is a row of its own: of several rows
with one ``vec_id`` only the anchor's own one is left out for it, rows given
twice are found twice and, as anchors, mined twice.  Ties go to the smaller
``vec_id``.  An anchor without positives, or a positive without negatives in its
window (always so below a score of 0), gives no row.  Empty table: empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import common as C

SCALE = 256
LIMIT = 1 << 24
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT, HIGH_PERCENT = 80, 100
BLOCK_ROWS = 8192
LEAF_ROWS = 64
FANOUT = 16
QUERY_ROWS = 256
GROWTH = 8

#: Scores lie between these.
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def usable(rows: DataFrame, label: Column | None = None, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, v`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    label = (F.col("label") if label is None else label).cast("bigint")
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), v.alias("v"))
    return rows.where("vec_id is not null and label is not null and v is not null").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


# --- the index ----------------------------------------------------------------

def str_tiles(x: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of each leaf: tiled along coordinates of falling spread."""
    tiles = [np.arange(len(x))]
    spread = np.argsort(-(x.max(axis=0) - x.min(axis=0)), kind="stable") if len(x) else []
    left = len(spread)
    for c in spread:
        leaves = -(-max(map(len, tiles)) // leaf_rows)
        if leaves <= 1:
            break
        # As many slabs here as leave the same number for each coordinate to come.
        slabs = max(2, int(np.ceil(leaves ** (1 / left))))
        left -= 1
        cut = []
        for t in tiles:
            k = min(slabs, -(-len(t) // leaf_rows))
            cut += np.array_split(t[np.argsort(x[t, c], kind="stable")], k) if k > 1 else [t]
        tiles = cut
    return [p for t in tiles for p in np.array_split(t, -(-len(t) // leaf_rows))]


def pack_tree(x: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT):
    """``order, low, high, first, last, leaves``: rows in leaf order, and per node its
    box and children; leaves come first (children: rows), the root is the last node."""
    tiles = str_tiles(x, leaf_rows)
    order = np.concatenate(tiles)
    edges = np.append(0, np.cumsum([len(t) for t in tiles]))
    low, high = (f.reduceat(x[order], edges[:-1], axis=0) for f in (np.minimum, np.maximum))
    first, last, begin = list(edges[:-1]), list(edges[1:]), 0
    while len(low) - begin > 1:
        at = np.arange(begin, len(low), fanout)
        end = len(low)
        low, high = (np.concatenate([b, f.reduceat(b[begin:], at - begin, axis=0)]) for b, f in ((low, np.minimum), (high, np.maximum)))
        first += list(at)
        last += list(np.append(at[1:], end))
        begin = end
    return order, low, high, np.array(first), np.array(last), len(tiles)


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest signed type that holds them."""
    most = int(np.abs(a).max()) if a.size else 0
    return a.astype(np.int16 if most < 1 << 15 else np.int32)


def _integers(v, dims: int, scale: int) -> np.ndarray:
    flat = np.clip(np.floor(np.asarray(v.flatten(), np.float64) * scale), -LIMIT, LIMIT).astype(np.int64)
    size = np.asarray(pa.compute.list_value_length(v), np.int64)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), C.ranges(np.zeros(len(size), np.int64), size)] = flat
    return out


def _blocks(dims: int, scale: int, block_rows: int, leaf_rows: int):
    """Rows sorted by label: one row a block of one label."""
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("label", pa.int64()), ("blob", pa.binary())])

    def blocks(batches):
        part, seq, label, held = TaskContext.get().partitionId(), 0, None, []

        def packed():
            nonlocal seq, held
            x, ids, numbers = (np.concatenate(c) for c in zip(*held))
            order, low, high, first, last, leaves = pack_tree(x, leaf_rows)
            blob = C.pack(ids[order], numbers[order], _narrow(x[order]).ravel(), _narrow(low).ravel(), _narrow(high).ravel(), first, last, np.array([leaves]))
            seq, held = seq + 1, []
            return C.table(schema, [part], [seq - 1], [label], [blob])

        for batch in batches:
            labels = batch["label"].to_numpy()
            at = np.append(np.flatnonzero(np.append(len(labels) > 0, labels[1:] != labels[:-1])), len(labels))
            for a, b in zip(at[:-1], at[1:]):
                if held and labels[a] != label:
                    yield packed()
                label = int(labels[a])
                a, b = int(a), int(b)
                while a < b:
                    n = min(b - a, block_rows - sum(len(h[1]) for h in held))
                    own = batch.slice(a, n)
                    held.append((_integers(own["v"], dims, scale), own["vec_id"].to_numpy(), own["number"].to_numpy()))
                    a += n
                    if sum(len(h[1]) for h in held) == block_rows:
                        yield packed()
        if held:
            yield packed()

    return blocks


# --- the search ---------------------------------------------------------------

class Tree:
    """One block's R-tree, from its packed form."""

    def __init__(self, blob: bytes, dims: int):
        ids, numbers, x, low, high, self.first, self.last, leaves = C.unpack(blob)
        self.ids, self.numbers = ids, numbers
        low, high = (a.reshape(-1, dims).astype(np.float64) for a in (low, high))
        self.middle, self.half = (low + high) / 2, (high - low) / 2
        self.most = max((float(np.abs(a).max()) for a in (low, high) if a.size), default=0.0)
        self.x, self.leaves = x.reshape(-1, dims), int(leaves[0])
        self.opened = 0

    def scores(self, a: int, b: int, q: np.ndarray) -> np.ndarray:
        """Exact inner products of rows ``a`` to ``b``."""
        return self.x[a:b].astype(np.int64) @ q

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every node's inner products (never too narrow, whatever was rounded)."""
        q = q.astype(np.float64)
        centre, reach = self.middle @ q, self.half @ np.abs(q)
        slack = 1e-12 * self.most * np.abs(q).sum() * 2
        return centre - reach - slack, centre + reach + slack

    def search(self, q: np.ndarray, number: int, windows: list, k: int) -> list[list]:
        """For each window ``(low, high, floor)`` the ``k`` best rows, ``(score,
        vec_id, number)``, with scores in it and not below ``floor``."""
        least, most = self.intervals(q)
        found = [[] for _ in windows]  # min-heaps by (score, -vec_id, -number)
        floors = [max(lo, floor) for lo, _, floor in windows]

        def open_windows(node):
            return [w for w, (lo, hi, _) in enumerate(windows) if lo <= hi and most[node] >= floors[w] and least[node] <= hi]

        root = len(self.first) - 1
        queue = [(-most[root], root)]
        while queue:
            _, node = heapq.heappop(queue)
            meets = open_windows(node)
            if not meets:
                continue
            a, b = int(self.first[node]), int(self.last[node])
            if node >= self.leaves:
                for child in range(a, b):
                    if open_windows(child):
                        heapq.heappush(queue, (-most[child], child))
                continue
            self.opened += 1
            scores = self.scores(a, b, q)
            for w in meets:
                rows = np.flatnonzero((scores >= floors[w]) & (scores <= windows[w][1]) & (self.numbers[a:b] != number))
                if len(rows) > k:
                    rows = rows[np.lexsort((self.numbers[a + rows], self.ids[a + rows], -scores[rows]))[:k]]
                for i in rows:
                    row = int(scores[i]), -int(self.ids[a + i]), -int(self.numbers[a + i])
                    if len(found[w]) < k:
                        heapq.heappush(found[w], row)
                    elif row > found[w][0]:
                        heapq.heapreplace(found[w], row)
                    if len(found[w]) == k:
                        floors[w] = max(floors[w], found[w][0][0])
        return [[(s, -i, -n) for s, i, n in sorted(f, reverse=True)] for f in found]


def _search(dims: int, k: int):
    """Blocks in order of their number, the tree before its queries."""
    schema = pa.schema([("q", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("number", pa.int64())])

    def search(batches):
        tree, of = None, None
        for batch in batches:
            for block, label, blob, queries in zip(*(batch[c] for c in ("block", "label", "blob", "queries"))):
                if blob.is_valid:
                    tree, of = Tree(blob.as_py(), dims), block
                    continue
                assert of == block, "queries without their block"
                numbers, x, first, low, high, floor = C.unpack(queries.as_py())
                x, out = x.reshape(-1, dims).astype(np.int64), []
                for i, number in enumerate(numbers.tolist()):
                    own = slice(int(first[i]), int(first[i + 1]))
                    windows = list(zip(low[own].tolist(), high[own].tolist(), floor[own].tolist()))
                    for w, rows in enumerate(tree.search(x[i], number, windows, k)):
                        out += [(number, w, *r) for r in rows]
                if out:
                    yield C.table(schema, *zip(*out))

    return search


def _pack_queries(dims: int, scale: int, query_rows: int):
    """Blocks of queries of one label (rows come sorted by it)."""
    schema = pa.schema([("label", pa.int64()), ("shift", pa.int64()), ("queries", pa.binary())])

    def pack(batches):
        for batch in batches:
            labels = batch["label"].to_numpy()
            cut = np.flatnonzero(np.append(len(labels) > 0, labels[1:] != labels[:-1]))
            for a, b in zip(cut, np.append(cut[1:], len(labels))):
                for i in range(int(a), int(b), query_rows):
                    own = batch.slice(i, min(query_rows, int(b) - i))
                    numbers, windows = own["number"].to_numpy(), own["windows"].to_pylist()
                    first = np.append(0, np.cumsum([len(w) for w in windows]))
                    low, high, floor = (np.array([w[c] for ws in windows for w in ws], np.int64) for c in ("low", "high", "floor"))
                    blob = C.pack(numbers, _narrow(_integers(own["v"], dims, scale)).ravel(), first, low, high, floor)
                    yield C.table(schema, [int(labels[a])], [int(numbers[0]) & 0xFFFFFF], [blob])

    return pack


def _stride(n: int) -> int:
    """A step that visits ``n`` blocks, each once, far from the last."""
    step = max(1, int(n * 0.618))
    while np.gcd(step, n) != 1:
        step += 1
    return step


class Index:
    """Blocks numbered over all labels in order, with what each label has."""

    def __init__(self, rows: DataFrame, scale: int = SCALE, block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS, dims: int | None = None):
        spark = rows.sparkSession
        self.scale = scale
        self.dims = max(1, dims or rows.agg(F.max(F.size("v"))).first()[0] or 1)
        # ``number`` makes the sort key unique: no run of equal rows lands in one task.
        ranged = rows.withColumn("x0", F.coalesce(F.try_element_at("v", F.lit(1)), F.lit(0.0)))
        ranged = ranged.repartitionByRange(C.partitions(spark), "label", "x0", "number").sortWithinPartitions("label", "x0", "number")
        blocks = C.staged(spark, ranged.mapInArrow(_blocks(self.dims, scale, block_rows, leaf_rows), "part bigint, seq bigint, label bigint, blob binary"), "rtree-blocks")
        per_part = sorted(blocks.groupBy("part").count().collect())  # a row a task of the range partitioning
        before = np.cumsum([0] + [n for _, n in per_part]).tolist()
        self.n_blocks = before[-1]
        begins = spark.createDataFrame([(p, b) for (p, _), b in zip(per_part, before)], "part bigint, begin bigint")
        self.blocks = blocks.join(F.broadcast(begins), "part").select((F.col("begin") + F.col("seq")).alias("block"), "label", "blob")
        self.labels = self.blocks.groupBy("label").agg(F.min("block").alias("begin"), F.count("*").alias("size"))

    def _targets(self, packed: DataFrame, own_label: bool, done: int, upto: int) -> DataFrame:
        """Each block of queries, copied to its ``done``-th to ``upto``-th blocks."""
        if own_label:  # of its label; equal labels are neighbours in the order
            met = packed.join(self.labels, "label").where(F.col("size") > done)
            turn = F.expr(f"sequence({done}L, least({upto}L, size) - 1)")
            # An odd number of steps around the label's own blocks.
            met = met.select("label", "queries", "shift", "begin", "size", F.explode(turn).alias("i"))
            return met.select((F.col("begin") + F.pmod(F.col("i") + F.col("shift"), F.col("size"))).alias("block"), "label", "queries")
        n, step = self.n_blocks, _stride(self.n_blocks)
        turn = F.expr(f"sequence({done}L, {min(upto, n)}L - 1)")
        met = packed.select("label", "queries", "shift", F.explode(turn).alias("i"))
        return met.select(F.pmod(F.col("i") * step + F.col("shift"), F.lit(n)).alias("block"), "label", "queries")

    def search(self, queries: DataFrame, k: int, own_label: bool, growth: int = GROWTH, query_rows: int = QUERY_ROWS) -> DataFrame:
        """``q, w, score, vec_id, number``: of each query (``number, label, v, windows
        array<struct<low, high>>``) and window the ``k`` best rows of blocks of its own
        label, or of all others."""
        spark, n = queries.sparkSession, C.partitions(queries.sparkSession)
        best = Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id", "number")
        most = self.labels.agg(F.max("size")).first()[0] if own_label else self.n_blocks
        found, done, size = None, 0, 1
        while done < (most or 0):
            if found is None:
                floored = queries.withColumn("windows", F.transform("windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"), F.lit(LOWEST).alias("floor"))))
            else:
                kth = found.groupBy("q", "w").agg(F.min("score").alias("floor"), F.count("*").alias("held")).where(F.col("held") == k)
                kth = kth.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "floor"))).alias("floors"))  # a window each
                met = queries.join(kth, queries["number"] == kth["q"], "left")
                floor = lambda i: F.coalesce(F.try_element_at("floors", i.cast("int")), F.lit(LOWEST))
                floored = met.select("number", "label", "v", F.transform("windows", lambda w, i: F.struct(
                    w["low"].alias("low"), w["high"].alias("high"), floor(i).alias("floor"))).alias("windows"))
            packed = floored.repartitionByRange(n, "label", "number").sortWithinPartitions("label", "number").mapInArrow(
                _pack_queries(self.dims, self.scale, query_rows), "label bigint, shift bigint, queries binary")
            asked = self._targets(packed, own_label, done, done + size).select("block", "label", F.lit(None).cast("binary").alias("blob"), "queries")
            if not own_label:  # blocks of the queries' own label are left out
                of = self.labels.select("label", "begin", (F.col("begin") + F.col("size")).alias("end"))
                asked = asked.join(of, "label", "left").where("begin is null or block < begin or block >= end").select("block", "label", "blob", "queries")
            trees = self.blocks.select("block", "label", "blob", F.lit(None).cast("binary").alias("queries"))
            met = trees.unionByName(asked).repartition(n, "block").sortWithinPartitions("block", F.col("blob").isNull())
            new = met.mapInArrow(_search(self.dims, k), "q bigint, w int, score bigint, vec_id bigint, number bigint")
            new = new if found is None else new.unionByName(found)
            found = C.staged(spark, new.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place"), "rtree-found")
            done, size = done + size, size * growth
        return found if found is not None else spark.createDataFrame([], "q bigint, w int, score bigint, vec_id bigint, number bigint")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT,
                   high: int = HIGH_PERCENT, scale: int = SCALE, block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS,
                   growth: int = GROWTH, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``
    of the ``usable`` rows for those that ``anchors`` selects."""
    spark = rows.sparkSession
    shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    # Written once, so that a row's number stays with it.
    rows = C.staged(spark, rows.withColumn("number", F.monotonically_increasing_id()), "mining-rows")
    index = Index(rows, scale, block_rows, leaf_rows)
    if not index.n_blocks:
        return spark.createDataFrame([], shape)
    asked = rows.where(anchors)
    open_ = F.array(F.struct(F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    near = index.search(asked.select("number", "label", "v", open_.alias("windows")), positives, True, growth, query_rows)
    # low positive <= 100 negative <= high positive: rounded up and down to whole scores.
    below, above = F.col("score") * low, F.col("score") * high
    window = F.struct((F.expr(f"score * {low}L div 100") + F.when(below % 100 > 0, 1).otherwise(0)).alias("low"),
                      (F.expr(f"score * {high}L div 100") - F.when(above % 100 < 0, 1).otherwise(0)).alias("high"), "score", "vec_id", "number")
    sought = near.groupBy("q").agg(F.array_sort(F.collect_list(window)).alias("windows"))  # a few each
    sought = C.staged(spark, sought, "mining-windows")
    met = asked.join(sought, F.col("number") == F.col("q")).select("number", "label", "v", "windows")
    found = index.search(met, negatives, False, growth, query_rows)
    rank = F.row_number().over(Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id", "number"))
    found = found.select("q", "w", rank.alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = sought.select("q", F.posexplode("windows").alias("w", "p")).join(asked.select(F.col("number").alias("q"), F.col("vec_id").alias("anchor_id")), "q")
    out = found.join(named, ["q", "w"])
    return out.select("anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", "negative_id", F.col("p.score").alias("positive_score"), "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives(usable(C.read(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)
