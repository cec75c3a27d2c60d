"""Packing documents into sequences by cutting-stock column generation
(operator 7).

A document longer than a sequence fills whole sequences first; what is left
over is a piece of 1 to ``capacity - 1`` tokens.  The histogram of the pieces'
lengths (at most ``capacity`` numbers, whatever the input's size) goes to the
driver.  There a linear program chooses how often to use each pattern, a set
of lengths that share a sequence; a knapsack dynamic program over the duals
prices new patterns until none gains, or until the program's value is proven to be within
``GAP``, and one sequence, of the least (by its duals, or by the tokens themselves, which no sequence
costs less than), or until as many new patterns as there are lengths save less than one sequence.  Counts are rounded down, and patterns for the pieces
left over are priced the same way on what is left.  If plain first-fit is not worse
in the end, it is taken.  Each pattern's places are
then ranges of ranks among the pieces of a length, and every piece finds its
sequence and offset from its rank, in parallel.

Defined results: null text: empty, one token (the end id); an added token of the
vocabulary that stands in a text is one id, as its library reads it; null and repeated
``doc_id``: each row is a document of its own; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import public_tokenizers
from editpulse.llm import bpe
from editpulse.llm import common as C

CAPACITY = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
#: Column generation ends when the program's value is proven to be this close to the
#: least, and one sequence: whole sequences cannot follow the program closer.
GAP = 0.002


def padded(fill, capacity: int = CAPACITY):
    """Length of a sequence that holds ``fill`` tokens, with its padding."""
    return fill if fill & (fill - 1) == 0 else capacity


def price(value: np.ndarray, lengths: np.ndarray, cost: np.ndarray) -> tuple[float, dict[int, int], float]:
    """The pattern of greatest value minus cost: knapsack over exact fills.

    ``cost[c]`` is that of a sequence with ``c`` tokens.  Returns the
    difference, the pattern as index of length -> how many, and the factor (at most 1)
    that scales the values until no pattern is worth more than it costs."""
    capacity = len(cost) - 1
    dense = np.full(capacity + 1, -np.inf)
    dense[lengths] = value
    index = np.zeros(capacity + 1, np.int64)
    index[lengths] = np.arange(len(lengths))
    best, last = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0
    for c in range(1, capacity + 1):
        total = dense[1:c + 1] + best[c - 1::-1][:c]
        k = int(total.argmax())
        best[c], last[c] = total[k], k + 1
    gain = best - cost
    gain[0] = -np.inf
    c = int(gain.argmax())
    found, pattern = float(gain[c]), {}
    worth = best > cost
    scale = float((cost[worth] / best[worth]).min()) if worth.any() else 1.0
    while c > 0:
        i = int(index[last[c]])
        pattern[i] = pattern.get(i, 0) + 1
        c -= int(last[c])
    return found, pattern, scale


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how many in a sequence) and how often each is used;
    together they hold exactly ``counts[i]`` pieces of ``lengths[i]``."""
    m = len(lengths)
    if not m:
        return []
    cost = np.array([padded(c, capacity) for c in range(capacity + 1)], float)
    columns, x = [{}] * m, np.zeros(m)
    inverse = np.eye(m)
    for ends, pattern, times in _start(lengths, counts, cost):
        columns[ends], x[ends] = pattern, times
        _pivot(inverse, ends, pattern)
    basic = np.array([cost[int(sum(lengths[i] * a for i, a in p.items()))] for p in columns])
    tokens, turn, before = float((lengths * counts).sum()), 0, np.inf
    while True:
        if turn % m == 0:
            if before - (basic * x).sum() < capacity:
                break
            before = (basic * x).sum()
        turn += 1
        duals = (basic[:, None] * inverse).sum(axis=0)
        gain, pattern, scale = price(duals, lengths, cost)
        # Scaled duals allow every pattern, so they bound the program from below.
        bound = max(tokens, scale * (duals * counts).sum())
        if gain <= 1e-7 or (basic * x).sum() <= bound * (1 + gap) + capacity:
            break
        column = _column(inverse, pattern)
        ratio = np.full(m, np.inf)
        up = column > 1e-9
        ratio[up] = x[up] / column[up]
        out = int(ratio.argmin())
        step = ratio[out]
        x -= step * column
        x[out] = step
        np.maximum(x, 0, out=x)
        _pivot(inverse, out, pattern)
        columns[out], basic[out] = pattern, cost[int(sum(lengths[i] * k for i, k in pattern.items()))]
    left, used = counts.astype(np.int64).copy(), []
    for k in range(m):
        times = min([int(x[k] + 1e-6), *(int(left[i] // a) for i, a in columns[k].items())])
        if times > 0:
            used.append((columns[k], times))
            for i, a in columns[k].items():
                left[i] -= a * times
    total = lambda rows: sum(cost[int(sum(lengths[i] * a for i, a in p.items()))] * t for p, t in rows)
    used += min(_priced(lengths, left, cost), _first_fit(lengths, left, capacity), key=total)
    used = min(used, _first_fit(lengths, counts, capacity), key=total)
    return [({int(lengths[i]): a for i, a in p.items()}, t) for p, t in used]


def _column(inverse: np.ndarray, pattern: dict[int, int]) -> np.ndarray:
    return sum(inverse[:, i] * k for i, k in pattern.items())


def _pivot(inverse: np.ndarray, out: int, pattern: dict[int, int]) -> None:
    """Put ``pattern`` into the basis in place of column ``out``."""
    column = _column(inverse, pattern)
    row = inverse[out] / column[out]
    inverse -= column[:, None] * row
    inverse[out] = row


def _start(lengths: np.ndarray, counts: np.ndarray, cost: np.ndarray):
    """A basic solution to start from: the knapsack priced by length, with a
    premium on long pieces, and its pattern used until a length runs out.
    Each pattern ends one length and later ones lack it, so the columns are
    independent.  Yields the length that ends, the pattern and its use."""
    left = counts.astype(float)
    value = lengths + 1e-3 * lengths.astype(float) ** 2 / (len(cost) - 1)
    open_ = np.ones(len(lengths), bool)
    while open_.any():
        own = np.flatnonzero(open_)
        if left[own].max() > 1e-9:
            own = own[left[own] > 1e-9]
            _, pattern, _ = price(value[own], lengths[own], cost)
            pattern = {int(own[i]): a for i, a in pattern.items()}
        else:  # lengths that ran out together: unused columns of their own
            pattern = {int(own[0]): 1}
        ends = min(pattern, key=lambda i: left[i] / pattern[i])
        times = left[ends] / pattern[ends]
        for i, a in pattern.items():
            left[i] = max(0.0, left[i] - a * times)
        left[ends], open_[ends] = 0.0, False
        yield ends, pattern, times


def _taken(left: np.ndarray, pattern: dict[int, int], out: list) -> None:
    """Use ``pattern`` as often as the pieces last."""
    times = int(min(left[i] // k for i, k in pattern.items()))
    out.append((pattern, times))
    for i, k in pattern.items():
        left[i] -= k * times


def _priced(lengths: np.ndarray, left: np.ndarray, cost: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Patterns for the pieces that are left: the knapsack priced by length, with a premium
    on long pieces, cut to the pieces there are and filled up with the longest that fit."""
    left, out = left.copy(), []
    value = lengths + 1e-3 * lengths.astype(float) ** 2 / (len(cost) - 1)
    while left.any():
        own = np.flatnonzero(left)
        _, best, _ = price(value[own], lengths[own], cost)
        pattern = {int(own[i]): int(min(k, left[own[i]])) for i, k in best.items()}
        room = len(cost) - 1 - sum(int(lengths[i]) * k for i, k in pattern.items())
        for i in own[::-1]:
            k = int(min(left[i] - pattern.get(int(i), 0), room // lengths[i]))
            if k:
                pattern[int(i)] = pattern.get(int(i), 0) + k
                room -= k * int(lengths[i])
        _taken(left, pattern, out)
    return out


def _first_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """The remaining pieces, longest first, each sequence filled greedily; equal
    sequences at once."""
    left, out = left.copy(), []
    order = np.argsort(-lengths, kind="stable")
    while left.any():
        room, pattern = capacity, {}
        for i in order:
            k = int(min(left[i], room // lengths[i]))
            if k:
                pattern[int(i)] = k
                room -= k * int(lengths[i])
        _taken(left, pattern, out)
    return out


def _with_specials(enc, special: dict[str, int], text: bytes) -> list[int]:
    """Ids of a text that holds added tokens of the vocabulary, as its library reads
    them: each is its own id, and what lies between is encoded by itself."""
    parts = re.split("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")", text.decode(errors="replace"))
    return [i for part in parts for i in ([special[part]] if part in special else enc.encode_ordinary(part))]


def _pieces(path: str, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("chunk", pa.int64()), ("place", pa.int64())])

    def pieces(batches):
        enc, special, known = bpe.encoder(path), bpe.added_tokens(path), {}
        marks = [t.encode() for t in special]
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            data, offsets = C.buffers(batch["text"])
            doc_ids = batch["doc_id"].to_pylist()
            for i, j in C.slices(offsets, 4 << 20):
                found, first = bpe.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                coded = found.dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                if len(known) > 400_000:  # bounds the task's memory; a word is encoded again
                    known.clear()
                new = [w for w in distinct if w not in known]
                known.update(zip(new, (np.array(enc.encode_ordinary(w.decode(errors="replace")), "<u4") for w in new)))
                ids = [known[w] for w in distinct]
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
                begin, which, out = np.cumsum(counts) - counts, coded.indices.to_numpy(), []
                marked = any(m in data[offsets[i]:offsets[j]].tobytes() for m in marks)
                for d in range(i, j):
                    own = which[first[d - i]:first[d - i + 1]]
                    whole = flat[C.ranges(begin[own], counts[own])]
                    if marked and any(m in (text := data[offsets[d]:offsets[d + 1]].tobytes()) for m in marks):
                        whole = np.array(_with_specials(enc, special, text), np.uint32)
                    whole = np.append(whole, np.uint32(END_ID)).astype("<u4")
                    for start in range(0, len(whole), capacity):
                        part = whole[start:start + capacity]
                        out.append((doc_ids[d], start, len(part), zlib.crc32(part.tobytes()), len(whole), task, int(seen[len(part)])))
                        seen[len(part)] += 1
                if out:
                    yield C.table(schema, *zip(*out))

    return pieces


def _places(patterns: list[tuple[dict[int, int], int]], capacity: int):
    """For each length: the first rank, first sequence, pieces a sequence and
    offset of each pattern that holds it."""
    sequence, by_length = 0, {}
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            k = pattern[length]
            rows = by_length.setdefault(length, [])
            rank = rows[-1][0] + rows[-1][4] if rows else 0
            rows.append((rank, sequence, k, offset, k * times))
            offset += k * length
        sequence += times
    tables = {length: np.array(rows, np.int64).T for length, rows in by_length.items()}
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def places(batches):
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            which, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                if value == capacity:
                    which[at] = sequence + rank[at]
                    continue
                first, begin, k, base, _ = tables[int(value)]
                row = np.searchsorted(first, rank[at], "right") - 1
                inside = rank[at] - first[row]
                which[at] = begin[row] + inside // k[row]
                offset[at] = base[row] + inside % k[row] * value
            yield C.table(schema, *(batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), which, offset)

    return places


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, gap: float = GAP) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark, path = docs.sparkSession, vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    with C.small_batches(spark):
        pieces = C.staged(spark, rows.mapInArrow(_pieces(path, capacity), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, chunk bigint, place bigint"), "pieces")
    per_chunk = pieces.groupBy("length", "chunk").count()
    histogram = sorted(per_chunk.where(F.col("length") < capacity).groupBy("length").agg(F.sum("count")).collect())  # fewer rows than capacity
    lengths, counts = (np.array([r[i] for r in histogram], np.int64) for i in (0, 1))
    patterns = solve(lengths, counts, capacity, gap)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    bases = per_chunk.withColumn("base", F.coalesce(before, F.lit(0))).select("length", "chunk", "base")
    ranked = pieces.join(bases, ["length", "chunk"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.mapInArrow(_places(patterns, capacity), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(C.read(spark, sf_dir, "documents"))
