"""Substring deduplication by super-k-mer partitioning (operator 8).

A window is 50 consecutive words of one document.  Each document is cut into
runs of windows that share a minimiser (the least hash of their 5-word
grams).  One pass deals the runs' keys and places out by key and finds the
keys that occur in more than one document, an exact pre-count: a window that
occurs in two documents has one key in both.  Those runs travel as packed
strings to the bucket of their key, where sorting their windows finds every
window that also starts in a document with a smaller id.

Defined results: null text or no words: nothing removed; fewer than 50 words:
no window; repeats inside one document are kept; null ``doc_id`` and repeated
rows as in ``common``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from editpulse.llm import common as C
from editpulse.llm import windows as W

WINDOW_WORDS = 50
GRAM_WORDS = 5


def _scan(window: int, k: int, n_buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def scan(batches):
        for batch in batches:
            data, offsets = C.buffers(batch["text"])
            ids = batch["id"].to_numpy()
            parts = []
            for i, j in C.slices(offsets):
                own = offsets[i:j + 1]
                text, start, size, key = W.word_runs(data[own[0]:own[-1]], own - own[0], window, k)
                parts.append((ids[i + text], start.astype(np.int32), size.astype(np.int16), key))
            if parts:
                parts = [np.concatenate(x) for x in zip(*parts)]
                rows = list(C.dealt(parts[-1] % C.U(n_buckets), n_buckets, *parts))
                if rows:
                    yield C.table(schema, *zip(*rows))

    return scan


def _shared(hot_runs: int):
    """Runs whose key occurs in documents of different ids."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("key", pa.int64()), ("hot", pa.bool_())])

    def shared(batches):
        for _, rows in C.by_key(batches):
            ids, start, n, key = C.joined(rows)
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
            count = np.diff(np.append(first, len(order)))
            by = ids[order]
            spread = np.minimum.reduceat(by, first) != np.maximum.reduceat(by, first)
            keep = order[np.repeat(spread, count)]
            hot = np.repeat(count >= hot_runs, count)[np.repeat(spread, count)]
            for i in range(0, len(keep), 100_000):
                at = keep[i:i + 100_000]
                yield C.table(schema, ids[at], start[at], n[at].astype(np.int32), key[at].view(np.int64), hot[i:i + 100_000])

    return shared


def shared_spans(docs: DataFrame, window: int = WINDOW_WORDS, k: int = GRAM_WORDS, hot_runs: int = W.HOT_RUNS) -> DataFrame:
    """``docs`` with ``spans``: ranges of words covered by a window that also starts
    in a document with a smaller id; ``docs`` from ``common.keyed``."""
    n = C.partitions(docs.sparkSession)
    places = docs.select("id", "text").mapInArrow(C.released(_scan(window, k, n)), "bucket int, blob binary")
    seeds = places.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(C.released(_shared(hot_runs)), W.SEED)
    return W.repeats(docs, seeds, window, of_words=True)


def _kept(with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.string())] * with_text)

    def kept(batches):
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(x.to_pylist() for x in (batch["doc_id"], batch["text"].cast(pa.binary()), batch["spans"]))):
                words = text.split()
                n = len(words)
                for a, b in reversed(W.merged((s["a"], s["b"]) for s in spans or ())):
                    del words[a:b]
                whole = b" ".join(words)
                out.append((doc_id, n, n - len(words), hashlib.sha256(whole).hexdigest()) + (whole.decode(errors="replace"),) * with_text)
            if out:
                yield C.table(schema, *zip(*out))

    return kept


def dedup_windows(docs: DataFrame, window: int = WINDOW_WORDS, k: int = GRAM_WORDS, with_text: bool = True,
                  hot_runs: int = W.HOT_RUNS) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256`` and, with
    ``with_text``, ``kept``: its words, joined by one space, without those
    covered by a repeated window."""
    kept = shared_spans(C.keyed(docs), window, k, hot_runs).mapInArrow(C.released(_kept(with_text)), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text)
    return C.staged_small(docs.sparkSession, kept, "windows-kept")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_windows(C.read(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
