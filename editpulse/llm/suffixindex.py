"""Substring deduplication with a logarithmic family of suffix arrays
(operator 2).

A suffix array of a batch lists the suffixes that start at the anchors of its
texts (the minimisers of all windows of 100 bytes: every window holds one, and
equal windows hold equal ones), in the order of their first 24 bytes.  It is
dealt out by anchor into buckets; a bucket's part is one sorted array.  A new
batch's array is merge-scanned, bucket by bucket, against the arrays of the
existing levels: the two sorted arrays merge in one pass, and suffixes that
agree far enough are seeds of long matches.  A window of 100 bytes that repeats
around an anchor has at least 38 of its other 76 bytes on one side of it, so two
suffixes are seeds if they agree in their first 62 bytes, or in 24 and the 38
bytes before (each suffix carries digests of both; suffixes whose run of windows
has its anchor several times need only the 24).  Then the batch becomes level 0, and two levels of equal size merge into the next, so a
corpus of ``b`` batches has at most ``log2(b) + 1`` levels and each suffix is
rewritten that often.

``windows.repeats`` follows the seeds: it cuts their strings from the texts
and sorts the windows around them, which leaves exactly the matches of 100
bytes or more.

Defined results: null text: empty; matches never cross texts and may overlap,
also within one text; null ``doc_id`` and repeated rows as in ``common``; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.llm import common as C
from editpulse.llm import windows as W
from editpulse.session import scratch_dir
from editpulse.sinks.versioned import delete_path

WINDOW_BYTES = 100
GRAM_BYTES = 24
#: Batches that a whole table is added in.
BATCHES = 3
#: Buckets a shuffle partition: a task handles one at a time, so it holds less of
#: the arrays at once.
PARTITION_BUCKETS = 4
#: Suffixes that a task gathers before it deals them out (42 bytes each).
SCAN_SUFFIXES = 400_000
#: Text bytes scanned at once (a single longer text goes whole); it takes some 90
#: bytes a byte.
SCAN_BYTES = 256 << 10

_SEED = pa.schema([("id", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("key", pa.int64())])
SEED = "id bigint, start int, n int, key bigint"


def _scan(window: int, n_buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    half = (window - GRAM_BYTES + 1) // 2

    def dealt(parts):
        *entry, key = (np.concatenate(x) for x in zip(*parts))
        parts.clear()  # copies are dropped as soon as the next is made
        rows = C.dealt(key % C.U(n_buckets), n_buckets, *entry)
        del entry, key
        return C.table(schema, *zip(*rows))

    def scan(batches):
        parts, held = [], 0
        for batch in batches:
            data, offsets = C.buffers(batch["text"])
            ids = batch["id"].to_numpy()
            for i, j in C.slices(offsets, SCAN_BYTES):
                first = offsets[i:j + 1] - offsets[i]
                own = C.overlapping_words(data[offsets[i]:offsets[j]], max(16, window))
                grams = W.gram_hashes_of_bytes(own, max(0, int(first[-1]) - GRAM_BYTES + 1))
                text, at, size, key = W.runs(grams, first, window, GRAM_BYTES)
                if len(at):
                    # The run's first anchor, and whether the same bytes stand
                    # in it again (a repeat inside the run): then n is negative.
                    around = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM_BYTES + 1)
                    anchor = at + (around[at] == key[:, None]).argmax(axis=1)
                    end = at + size - 1
                    last = end + window - GRAM_BYTES - (around[end] == key[:, None])[:, ::-1].argmax(axis=1)
                    size = np.where(last > anchor, -size, size)
                    parts.append((own[anchor].byteswap(), own[anchor + 8].byteswap(), own[anchor + 16].byteswap(),
                                  _digest(own, anchor + GRAM_BYTES, half), _digest(own, anchor - half, half), ids[i + text],
                                  (at - first[text]).astype(np.int32), size.astype(np.int16), key))
                    held += len(at)
                if held >= SCAN_SUFFIXES:
                    yield dealt(parts)
                    held = 0
        if parts:
            yield dealt(parts)

    return scan


def _digest(own: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """16-bit digest of the ``n`` bytes from each position on.  Where they leave
    the text (no window can then hold them all) any value will do."""
    out = np.zeros(len(at), np.uint64)
    for step in [*range(0, n - 8, 8), n - 8] if n >= 8 else ():
        out = C.mixed(out * C.MIX2 + own[np.maximum(at + step, 0)])
    return (out >> C.U(48)).astype(np.uint16)


def _in_order(rows: list[dict]) -> list[np.ndarray]:
    """Suffixes of several arrays in the order of their first 24 bytes."""
    arrays = C.joined(rows)
    order = np.lexsort(arrays[2::-1])
    return [a[order] for a in arrays]


def _merged(new: list[np.ndarray], old: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Two sorted arrays as one, and which of them (1, 2) each suffix is from.
    The stable sort finds the two ascending runs and merges them in one pass."""
    both = [np.concatenate(x) for x in zip(new, old)]
    begin = np.stack(both[:3], axis=1).astype(">u8").view(f"S{GRAM_BYTES}").ravel()
    order = np.argsort(begin, kind="stable")
    return [b[order] for b in both], np.repeat(np.uint8([1, 2]), [len(new[0]), len(old[0])])[order]


def _edges(*columns: np.ndarray) -> np.ndarray:
    """First index of each group of equal neighbours."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _agreeing(arrays: list[np.ndarray], source: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of a sorted array that agree with another one (of the other
    source, if given) far enough for a common window."""
    right, left, n = arrays[3], arrays[4], arrays[7]
    keep = np.zeros(len(n), bool)
    if not len(n):
        return keep

    def shared(first, size, source):
        return np.diff(np.append(first, size)) > 1 if source is None else np.bitwise_or.reduceat(source, first) == 3

    first = _edges(*arrays[:3])
    count = np.diff(np.append(first, len(n)))
    agree, twice = shared(first, len(n), source), np.logical_or.reduceat(n < 0, first)
    keep |= np.repeat(agree & twice, count)
    at = np.flatnonzero(np.repeat(agree & ~twice, count))
    group = np.repeat(np.arange(len(first), dtype=np.uint64), count)[at] << C.U(16)
    for side in (right, left) if len(at) else ():
        code = group | side[at]
        order = np.argsort(code, kind="stable")
        begin = _edges(code[order])
        hit = shared(begin, len(at), None if source is None else source[at][order])
        keep[at[order[np.repeat(hit, np.diff(np.append(begin, len(at))))]]] = True
    return keep


def _seeds(arrays, keep):
    high, mid, low, _, _, ids, start, n = (a[keep] for a in arrays)
    key = C.mixed(high * C.MIX1 ^ C.mixed(mid + C.MIX2) ^ low * C.MIX3).view(np.int64)
    for i in range(0, len(ids), 100_000):
        at = slice(i, i + 100_000)
        yield C.table(_SEED, ids[at], start[at], np.abs(n[at]).astype(np.int32), key[at])


def _sorted(batches):
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    for bucket, rows in C.by_key(batches):
        yield C.table(schema, [bucket], [C.pack(*_in_order(rows))])


def _scan_batch(batches):
    """Seeds inside one batch: suffixes that agree, and runs that repeat inside."""
    for batch in batches:
        for blob in batch["blob"]:
            arrays = C.unpack(blob.as_py())
            yield from _seeds(arrays, _agreeing(arrays) | (arrays[7] < 0))


def _merge_scan(batches):
    """Seeds between a new array and a level's array of one bucket."""
    for batch in batches:
        for new, old in zip(batch["blob"], batch["level"]):
            both, source = _merged(C.unpack(new.as_py()), C.unpack(old.as_py()))
            yield from _seeds(both, _agreeing(both, source))


def _merge(batches):
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    for batch in batches:
        for bucket, new, old in zip(batch["bucket"].to_pylist(), batch["blob"], batch["level"]):
            parts = [C.unpack(x.as_py()) for x in (new, old) if x.is_valid]
            yield C.table(schema, [bucket], [C.pack(*(_merged(*parts)[0] if len(parts) == 2 else parts[0]))])


class SuffixArrayFamily:
    """The levels of the index; each is a table in the shared folder with one
    sorted array of suffixes a bucket."""

    def __init__(self, spark: SparkSession, window: int = WINDOW_BYTES, n_buckets: int | None = None):
        if window < GRAM_BYTES:
            raise ValueError(f"window must be at least {GRAM_BYTES} bytes")
        self.spark, self.window = spark, window
        self.n_buckets = n_buckets or PARTITION_BUCKETS * C.partitions(spark)
        self.levels: dict[int, str] = {}

    def _write(self, df: DataFrame, name: str) -> str:
        path = scratch_dir(self.spark, name)
        with C.cleaned_shuffles(self.spark), C.small_batches(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return path

    def _level(self, path: str, blob: str = "blob") -> DataFrame:
        return self.spark.read.schema(f"bucket int, {blob} binary").parquet(path) if blob == "blob" else self._level(path).withColumnRenamed("blob", blob)

    def add(self, docs: DataFrame) -> DataFrame:
        """Add a batch (``common.keyed`` rows); its seeds, inside it and with
        all earlier batches, as a stored table."""
        places = docs.select("id", "text").mapInArrow(C.released(_scan(self.window, self.n_buckets)), "bucket int, blob binary")
        array = self._write(places.repartition(C.partitions(self.spark), "bucket").sortWithinPartitions("bucket").mapInArrow(
            C.released(_sorted), "bucket int, blob binary"), "suffix-array")
        new = self._level(array)
        seeds = new.mapInArrow(C.released(_scan_batch), SEED)
        for path in self.levels.values():
            seeds = seeds.unionByName(new.join(self._level(path, "level"), "bucket").mapInArrow(C.released(_merge_scan), SEED))
        found = C.staged_small(self.spark, seeds, "suffix-seeds")
        level = 0
        while level in self.levels:  # equal sizes merge
            old = self.levels.pop(level)
            both = self._level(array).join(self._level(old, "level"), "bucket", "full")
            merged = self._write(both.mapInArrow(C.released(_merge), "bucket int, blob binary"), "suffix-array")
            for path in (array, old):
                delete_path(self.spark, path)
            array, level = merged, level + 1
        self.levels[level] = array
        return found


    def drop(self) -> None:
        """Delete the levels; the seeds found so far are tables of their own."""
        for path in self.levels.values():
            delete_path(self.spark, path)
        self.levels = {}


def batches_of(docs: DataFrame, n: int) -> list[DataFrame]:
    """The documents in ``n`` batches of ascending ids (null ids in the last)."""
    doc_id = F.col("doc_id").cast("bigint")
    edges = docs.agg(F.percentile_approx(doc_id, [i / n for i in range(1, n)], 1000)).first()[0] if n > 1 else []
    edges = sorted(set(edges or []))
    if not edges:
        return [docs]
    return ([docs.where(doc_id <= edges[0])]
            + [docs.where((doc_id > a) & (doc_id <= b)) for a, b in zip(edges, edges[1:])]
            + [docs.where((doc_id > edges[-1]) | doc_id.isNull())])


def repeated_spans(docs: DataFrame, window: int = WINDOW_BYTES, n_batches: int = BATCHES, hot_runs: int = W.HOT_RUNS, rest: bool = False) -> DataFrame:
    """``common.keyed`` rows (``rest`` as there) with ``spans``: byte ranges covered by a string of
    ``window`` bytes that also starts earlier."""
    index, seeds = SuffixArrayFamily(docs.sparkSession, window), None
    for batch in batches_of(docs, n_batches):
        found = index.add(C.keyed(batch))
        seeds = found if seeds is None else seeds.unionByName(found)
    index.drop()
    hot = seeds.groupBy("key").count().where(F.col("count") >= hot_runs).select("key", F.lit(True).alias("is_hot"))
    seeds = seeds.join(hot, "key", "left").withColumn("hot", F.coalesce("is_hot", F.lit(False)))
    return W.repeats(C.keyed(docs, rest), seeds, window, of_words=False)


def _kept(with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
                       + [("kept", pa.string())] * with_text)

    def kept(batches):
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(x.to_pylist() for x in (batch["doc_id"], batch["text"].cast(pa.binary()), batch["spans"]))):
                gone = W.merged((s["a"], s["b"]) for s in spans or ())
                edges = [0, *(x for span in gone for x in span), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((doc_id, len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()) + (left.decode(errors="ignore"),) * with_text)
            if out:
                yield C.table(schema, *zip(*out))

    return kept


def dedup_substrings(docs: DataFrame, window: int = WINDOW_BYTES, n_batches: int = BATCHES, with_text: bool = True, hot_runs: int = W.HOT_RUNS) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the
    remaining bytes) and, with ``with_text``, ``kept``: the text without them
    (a character that lost some of its bytes goes as a whole)."""
    kept = repeated_spans(docs, window, n_batches, hot_runs).mapInArrow(C.released(_kept(with_text)), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * with_text)
    return C.staged_small(docs.sparkSession, kept, "suffix-kept")


def without_repeats(docs: DataFrame, window: int = WINDOW_BYTES, n_batches: int = BATCHES) -> DataFrame:
    """The documents, with all their columns, without the bytes that repeat;
    ``n_chars``, if there, follows the text."""
    rows = repeated_spans(docs, window, n_batches, rest=True)
    kind = rows.select("rest").schema["rest"].dataType

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["spans"].to_pylist()):
                edges = [0, *(x for span in W.merged((s["a"], s["b"]) for s in spans or ()) for x in span), len(text)]
                texts.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch["rest"]], names=["text", "rest"])

    cut_rows = rows.select("text", "spans", "rest").mapInArrow(C.released(cut), T.StructType([T.StructField("text", T.StringType()), T.StructField("rest", kind)]))
    own = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint").alias("n_chars")}
    return C.staged_small(docs.sparkSession, cut_rows.select(*[own.get(c, F.col(f"rest.`{c}`").alias(c)) for c in docs.columns]), "suffix-cut")


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(C.read(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
