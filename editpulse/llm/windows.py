"""Repeated windows of tokens over a corpus (tokens: bytes, or words).

Every window of ``window`` tokens is filed under its minimiser, the least
hash of its ``k``-token grams.  Consecutive windows that share it form a
*run* (a super-k-mer): one string of ``n + window - 1`` tokens.  Equal
windows have equal minimisers, so a window can only repeat inside the
strings filed under one key.  ``needed`` names the runs whose key occurs in
several places; ``repeats`` cuts just those strings, deals them out by key,
sorts all their windows and returns the tokens covered by repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

#: A run is split after so many windows, which bounds the strings that travel.
RUN_WINDOWS = 1024
#: A key with so many runs is hot: its windows travel one by one and are never
#: gathered.  The least place of each is aggregated on both sides of the shuffle,
#: and the others are joined with it by their text.
HOT_RUNS = 20_000
#: Bytes of strings a task matches at once (one key's strings stay together); it
#: takes some 50 bytes a byte.
PIECE_BYTES = 1 << 20


def runs(gram_hashes: np.ndarray, first: np.ndarray, window: int, k: int):
    """Runs of the texts whose tokens start at ``first`` (one more at the end):
    text index, start token (in all tokens), number of windows, key."""
    lens = np.diff(first)
    counts = np.maximum(lens - window + 1, 0)
    if not counts.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = C.sliding_min(gram_hashes, window - k + 1)
    at = C.ranges(first[:-1].astype(np.int64), counts)
    text = np.repeat(np.arange(len(counts)), counts)
    value = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    if size.max() > RUN_WINDOWS:
        parts = -(-size // RUN_WINDOWS)
        step = C.ranges(np.zeros(len(parts), np.int64), parts) * RUN_WINDOWS
        begin, size = np.repeat(begin, parts) + step, np.minimum(np.repeat(size, parts) - step, RUN_WINDOWS)
    return text[begin], at[begin], size, value[begin]


def word_runs(data: np.ndarray, offsets: np.ndarray, window: int, k: int):
    """Text index, start word within its text, windows and key of each run of words."""
    start, end, first = C.words_of(data, offsets)
    text, at, size, key = runs(C.grams(C.word_hashes(data, start, end), k), first, window, k)
    return text, at - first[text], size, key


def gram_hashes_of_bytes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the 24 bytes from each position on; ``words`` from ``overlapping_words``."""
    return C.mixed(words[:n] * C.MIX1 ^ C.mixed(words[8:n + 8] + C.MIX2) ^ words[16:n + 16] * C.MIX3)


SEED = "id bigint, start int, n int, key bigint, hot boolean"


def repeats(docs: DataFrame, seeds: DataFrame, window: int, of_words: bool) -> DataFrame:
    """``docs`` with ``spans``: token ranges ``(a, b)`` covered by a repeated window.

    ``docs`` from ``common.keyed``; ``seeds`` has the ``SEED`` columns, a row
    for each run that may hold a repeat.  With bytes, a window repeats if it
    also starts earlier (smaller ``(id, h)``, or earlier in the text); with
    words, if it also starts in a document of smaller ``id``.
    """
    n = C.partitions(docs.sparkSession)

    def cut(runs):
        wanted = runs.groupBy("id").agg(F.collect_set(F.struct("start", "n", "key", "hot")).alias("runs"))
        return docs.join(wanted, "id").mapInArrow(C.released(_cutter(window, of_words)), "key bigint, id bigint, h bigint, start int, s binary")

    found = cut(seeds.where("not hot")).repartition(n, "key").sortWithinPartitions("key").mapInArrow(
        C.released(_matcher(window, of_words)), "id bigint, h bigint, a int, b int")
    found = found.unionByName(_later(cut(seeds.where("hot")), window, of_words))
    found = found.groupBy("id").agg(F.collect_list(F.struct("h", "a", "b")).alias("spans"))
    # Both joins deal the texts out by id, so they travel once.
    return docs.join(found, "id", "left").withColumn("spans", F.filter("spans", lambda s: s["h"] == F.col("h")))


def _later(places: DataFrame, window: int, of_words: bool) -> DataFrame:
    """Ranges ``id, h, a, b`` of the single windows ``s`` that also start earlier."""
    least = places.groupBy("s").agg(F.min(F.struct("id", "h", "start")).alias("least"))
    later = F.col("id") > F.col("least.id") if of_words else F.struct("id", "h", "start") != F.col("least")
    return places.join(least, "s").where(later).select("id", "h", F.col("start").alias("a"), (F.col("start") + window).alias("b"))


def _cutter(window: int, of_words: bool):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("s", pa.binary())])

    def cut(batches):
        for batch in batches:
            row, start, size, key = _pieces(batch["runs"])
            end = start + size + window - 1
            ids, h = batch["id"].to_numpy()[row], batch["h"].to_numpy()[row]
            edges = np.searchsorted(row, np.arange(len(batch) + 1))
            from_, till, texts = start.tolist(), end.tolist(), batch["text"].cast(pa.binary())
            out, held, begin = [], 0, 0
            for i in range(len(batch)):
                tokens, lo, hi = texts[i].as_py(), edges[i], edges[i + 1]
                if of_words:
                    tokens = tokens.split()
                    own = [b" ".join(tokens[a:b]) + b" " for a, b in zip(from_[lo:hi], till[lo:hi])]
                else:
                    own = [tokens[a:b] for a, b in zip(from_[lo:hi], till[lo:hi])]
                # a run that goes beyond the text is of another text with this id
                out += own if not own or end[lo:hi].max() <= len(tokens) else [x if b <= len(tokens) else None for x, b in zip(own, till[lo:hi])]
                held += sum(map(len, own))
                if held > PIECE_BYTES or i + 1 == len(batch):
                    at, s = slice(begin, hi), pa.array(out, pa.binary())
                    yield C.table(schema, key[at], ids[at], h[at], start[at], s).filter(s.is_valid())
                    out, held, begin = [], 0, hi

    return cut


def _pieces(runs: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, windows and key of each run; a hot one comes as its single windows."""
    row = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
    start, n, key, hot = (x.to_numpy(zero_copy_only=False) for x in runs.flatten().flatten())
    parts = np.where(hot, n, 1)
    run = np.repeat(np.arange(len(row)), parts)
    step = C.ranges(np.zeros(len(parts), np.int64), parts)
    return row[run], (start[run] + step).astype(np.int32), np.where(hot, 1, n)[run], key[run]


def _parts(batches):
    """The batches in parts of about ``PIECE_BYTES``."""
    for batch in batches:
        step = max(1, len(batch) * PIECE_BYTES // max(1, batch.nbytes))
        for i in range(0, len(batch), step):
            yield batch.slice(i, step)


def _matcher(window: int, of_words: bool):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])

    def match(batches):
        held, size = [], 0
        for batch in _parts(batches):
            held.append(batch)
            size += batch.nbytes
            if size >= PIECE_BYTES:
                whole = pa.Table.from_batches(held).combine_chunks()
                key = whole["key"].to_numpy()
                edge = int(np.searchsorted(key, key[-1]))  # the last key may go on
                if edge:
                    yield C.table(schema, *covered(whole.slice(0, edge), window, of_words))
                held = whole.slice(edge).to_batches()
                size = sum(b.nbytes for b in held) if edge else 0
        if held:
            yield C.table(schema, *covered(pa.Table.from_batches(held), window, of_words))

    return match


def covered(strings: pa.Table, window: int, of_words: bool):
    """Token ranges ``(id, h, a, b)`` covered by windows that repeat among ``strings``."""
    ids, h, start = (strings[c].to_numpy() for c in ("id", "h", "start"))
    order = np.lexsort((start, h, ids))
    same = np.zeros(len(order), bool)
    same[1:] = (ids[order[1:]] == ids[order[:-1]]) & (h[order[1:]] == h[order[:-1]]) & (start[order[1:]] == start[order[:-1]])
    order = order[~same]  # rows given twice are one document
    ids, h, start = ids[order], h[order], start[order].astype(np.int64)
    data, offsets = C.buffers(strings["s"].combine_chunks().take(pa.array(order)))
    if of_words:
        begin, end, first = C.words_of(data, offsets)
        hashes = C.word_hashes(data, begin, end)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        exact = units.dictionary_encode().indices.to_numpy()  # equal numbers: equal words
        steps = range(window)
    else:
        first = offsets
        exact = C.overlapping_words(data, window)
        hashes = C.mixed(exact[:len(data)] + C.MIX2)
        steps = [*range(0, window - 8, 8), window - 8]
    counts = np.diff(first) - window + 1
    at = C.ranges(first[:-1].astype(np.int64), counts)
    string = np.repeat(np.arange(len(counts)), counts)
    seed = C.BASE
    while True:
        # Windows are numbered by document and position: the least number of
        # equal windows is the earliest one.
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * C.powers(seed, len(hashes)), out=sums[1:])
        inverse = C.powers(C.U(pow(int(seed), -1, 1 << 64)), len(hashes) + 1)
        # the first hash of bytes reads 8 of them: the last seven belong to the next window
        value = (sums[at + window - (0 if of_words else 7)] - sums[at]) * inverse[at]
        rank = np.argsort(value)
        ordered = value[rank]
        new = np.ones(len(rank), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        begin = np.flatnonzero(new)
        lead = np.empty(len(rank), np.int64)
        lead[rank] = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(rank)))) if len(rank) else rank
        other = np.flatnonzero(lead != np.arange(len(lead)))
        a, b = at[other], at[lead[other]]
        if all(bool((exact[a + j] == exact[b + j]).all()) for j in steps):
            break
        seed = C.U((int(seed) * 6364136223846793005 + 2) | 1)  # two texts with one hash: hash anew
    hit = other if not of_words else other[ids[string[other]] > ids[string[lead[other]]]]
    if not len(hit):
        return ids[:0], h[:0], start[:0], start[:0]
    hit = np.sort(hit)
    fresh = np.ones(len(hit), bool)
    fresh[1:] = (hit[1:] != hit[:-1] + 1) | (string[hit[1:]] != string[hit[:-1]])
    f = np.flatnonzero(fresh)
    last = hit[np.append(f[1:], len(hit)) - 1]
    hit = hit[f]
    row = string[hit]
    a = start[row] + at[hit] - first[row]
    return ids[row], h[row], a, a + (last - hit) + window


def merged(spans) -> list[tuple[int, int]]:
    """Sorted disjoint ranges that cover the same tokens (touching ones join)."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
