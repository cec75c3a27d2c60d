"""Improbable-feature digests of documents (operator 9).

A feature is a window of 64 bytes.  Its entropy score is ranked by rarity: how
often that score occurs over all windows of the corpus, the rarest first, with
scores too low to tell texts apart last.  Of every 64 consecutive features the
rarest (the leftmost of equals) gains a point; a feature with enough points is
selected.  Selected features are hashed into a chain of Bloom filters of 2048
bits, 5 bits each, a new filter after every 160.  Two digests are compared
filter by filter: the overlap of their bits, less what chance gives, over the
greatest possible, each filter of the shorter digest with its best match.

The rarity table is counted over all documents: 1001 numbers, whatever the
input's size.

Defined results: null text: empty; an empty text has an empty digest, which is
like another empty one (1) and unlike all others (0); a text shorter than a
window is one feature of all its bytes; the order of documents is that of
``common`` (null ids come first when descending); a single document is its own
next one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

WINDOW = 64
NEIGHBOURS = 64
LEAST_POINTS = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
LEVELS = 1000
#: Scores under this are ranked last (runs of few different bytes).
LEAST_SCORE = 100
#: Share of the way from chance to the greatest overlap that counts as nothing.
MARGIN = 0.3

#: c * log2(c) in steps of 2**-16, so that sums are exact whatever their order.
_C_LOG_C = np.rint(np.array([0.0] + [c * np.log2(c) for c in range(1, WINDOW + 1)]) * 65536).astype(np.int64)


def entropy_scores(data: np.ndarray) -> np.ndarray:
    """Score (0 to ``LEVELS``) of the entropy of every 64-byte window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    ahead, behind = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[:-d] == data[d:]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    # sum of c log c over the window's byte counts: the first by counting, then
    # by what each step takes out and puts in
    out, put = ahead[:n - 1], behind[WINDOW:WINDOW + n - 1]
    steps = np.empty(n, np.int64)
    steps[0] = _C_LOG_C[np.bincount(data[:WINDOW])].sum()
    steps[1:] = _C_LOG_C[out - 1] - _C_LOG_C[out] + _C_LOG_C[put] - _C_LOG_C[put - 1]
    # a byte that leaves and enters at once: its count does not change
    steps[1:][data[:n - 1] == data[WINDOW:WINDOW + n - 1]] = 0
    total = _C_LOG_C[WINDOW]
    return ((total - np.cumsum(steps)) * LEVELS // total).astype(np.int16)


def _valid(first: np.ndarray, width: int):
    """Starts of all ranges of ``width`` inside one text, and their texts."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return C.ranges(first[:-1].astype(np.int64), counts), np.repeat(np.arange(len(counts)), counts)


def _histogram(batches):
    schema = pa.schema([("counts", pa.binary())])
    counts = np.zeros(LEVELS + 1, np.int64)
    for batch in batches:
        data, offsets = C.buffers(batch["text"])
        for i, j in C.slices(offsets):
            first = offsets[i:j + 1] - offsets[i]
            at, _ = _valid(first, WINDOW)
            if len(at):
                counts += np.bincount(entropy_scores(data[offsets[i]:offsets[j]])[at], minlength=LEVELS + 1)
    yield C.table(schema, [counts.tobytes()])


def rarity(docs: DataFrame) -> list[int]:
    """Rank of each entropy score (0: rarest), counted over all documents."""
    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_histogram, "counts binary")
    # the tasks' tables (8 KB each) are summed in a few tasks before the driver adds the last
    summed = parts.repartition(int(C.partitions(docs.sparkSession) ** 0.5)).mapInArrow(_sum, "counts binary")
    counts = sum((np.frombuffer(r["counts"], np.int64) for r in summed.collect()), np.zeros(LEVELS + 1, np.int64))
    key = counts.astype(float)
    key[:LEAST_SCORE] = np.inf
    rank = np.empty(LEVELS + 1, np.int64)
    rank[np.argsort(key, kind="stable")] = np.arange(LEVELS + 1)
    return rank.tolist()


def _sum(batches):
    total = np.zeros(LEVELS + 1, np.int64)
    for batch in batches:
        for c in batch["counts"]:
            total += np.frombuffer(c.as_py(), np.int64)
    yield C.table(pa.schema([("counts", pa.binary())]), [total.tobytes()])


def digests(data: np.ndarray, first: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """Filters of each text (rows of 32 words of 64 bits); ``first`` has the
    texts' offsets in ``data``, one more at the end."""
    n_texts = len(first) - 1
    chosen, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
    scores = entropy_scores(data)
    if len(scores):
        key = (rank[scores].astype(np.uint64) << C.U(40)) | np.arange(len(scores), dtype=np.uint64)
        features = np.maximum(np.diff(first) - WINDOW + 1, 0)
        least = C.sliding_min(key, NEIGHBOURS)
        at, text = _valid(np.append(first[:-1], first[-1]), WINDOW + NEIGHBOURS - 1)
        winner = (least[at] & C.U((1 << 40) - 1)).astype(np.int64)
        points = np.bincount(winner, minlength=len(scores))
        own = np.flatnonzero(points >= LEAST_POINTS)
        # texts too short for any to gain so many points: their rarest feature
        none = np.bincount(np.searchsorted(first, own, "right") - 1, minlength=n_texts) == 0
        few = np.array([first[t] + int(key[first[t]:first[t] + features[t]].argmin()) for t in np.flatnonzero(none & (features > 0))], np.int64)
        chosen = np.sort(np.concatenate([own, few]))
        owner = np.searchsorted(first, chosen, "right") - 1
    words = C.overlapping_words(data)
    h = np.zeros(len(chosen), np.uint64)
    for k in range(0, WINDOW, 8):
        h = C.mixed(h * C.BASE ^ words[chosen + k])
    # texts without a whole window: one feature of all their bytes
    lens = np.diff(first)
    tiny = np.flatnonzero((lens > 0) & (lens < WINDOW))
    if len(tiny):
        h = np.concatenate([h, C.word_hashes(data, first[tiny], first[tiny + 1])])
        owner = np.concatenate([owner, tiny])
    order = np.argsort(owner, kind="stable")
    h, owner = h[order], owner[order]
    begin = np.searchsorted(owner, np.arange(n_texts + 1))
    counts = np.diff(begin)
    filters = -(-counts // FILTER_FEATURES)
    base = np.cumsum(filters) - filters
    number = base[owner] + (np.arange(len(h)) - begin[owner]) // FILTER_FEATURES
    bits = np.zeros((int(filters.sum()), FILTER_BITS), np.uint8)
    for k in range(HASHES):
        bits[number, (h >> C.U(11 * k)) & C.U(FILTER_BITS - 1)] = 1
    packed = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return [packed[b:b + f] for b, f in zip(base, filters)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: how alike two digests are."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    common = np.bitwise_count(a[:, None, :] & b[None, :, :]).sum(2, dtype=np.int64) if len(a) * len(b) <= 4096 else np.array(
        [np.bitwise_count(x & b).sum(1, dtype=np.int64) for x in a])
    most = np.minimum(ones_a[:, None], ones_b[None, :])
    chance = ones_a[:, None] * ones_b[None, :] / FILTER_BITS
    floor = chance + MARGIN * (most - chance)
    score = np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1)
    # two filters with nearly no features of their own say little: whole digests
    # weigh each filter by its bits
    return float((score.max(1) * ones_a).sum() / ones_a.sum())


def text_of(digest: np.ndarray) -> str:
    """A digest as text: number of filters and their bits."""
    return f"{len(digest)}:" + base64.b64encode(digest.tobytes()).decode()


def digest_of(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text.partition(":")[2]), np.uint64).reshape(-1, FILTER_BITS // 64)


def _edited(text: bytes, after: bytes) -> tuple[int, bytes]:
    """Code points of ``text``, and it with its last half from ``after``'s start."""
    own, other = text.decode(errors="replace"), after.decode(errors="replace")
    half = len(own) // 2
    return len(own), (own[:len(own) - half] + other[:half]).encode()


def _compare(rank: list[int], with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())] + [("edited", pa.string())] * with_text)

    def block(texts: list[bytes]):
        offsets = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        return digests(np.frombuffer(b"".join(texts), np.uint8), offsets, ranks)

    def finish(rows):
        """Rows ``(doc_id, text, ours)`` in order; each but the last has its next behind it."""
        edits = [_edited(a[1], b[1]) for a, b in zip(rows, rows[1:])]
        own, changed = block([r[1] for r in rows]), block([e for _, e in edits])
        out = []
        for i, (n, e) in enumerate(edits):
            if rows[i][2]:
                out.append((rows[i][0], n, hashlib.sha256(e).hexdigest(), text_of(own[i]), text_of(changed[i]),
                            likeness(own[i], changed[i]), likeness(own[i], own[i + 1])) + (e.decode(),) * with_text)
        return out

    ranks = np.array(rank, np.int64)

    def compare(batches):
        held, size, part = [], 0, None
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for doc_id, text, ours, own_part in zip(batch["doc_id"].to_pylist(), texts, batch["ours"].to_pylist(), batch["part"].to_pylist()):
                if own_part != part or size > C.SLICE_BYTES:
                    if len(held) > 1:
                        out = finish(held)
                        if out:
                            yield C.table(schema, *zip(*out))
                    held, size = (held[-1:] if own_part == part else []), 0
                part = own_part
                held.append((doc_id, text.as_py(), ours))
                size += len(held[-1][1])
        if len(held) > 1:
            out = finish(held)
            if out:
                yield C.table(schema, *zip(*out))

    return compare


def _place(edges: list[int]):
    """Adds ``part``: how many of ``edges`` lie under the row's id."""
    def place(batches):
        for batch in batches:
            part = np.searchsorted(np.array(edges, np.int64), batch["id"].to_numpy(), "left").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], names=[*batch.schema.names, "part"])

    return place


def fingerprint_documents(docs: DataFrame, n_parts: int | None = None, with_text: bool = True) -> DataFrame:
    """Per document ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` and, with ``with_text``, ``edited``.

    Documents are dealt out by ranges of ids; the last of a range also needs the
    first of the next one, which travels twice."""
    spark, rank = docs.sparkSession, rarity(docs)
    parts = n_parts or 4 * C.partitions(spark)
    edges = C.keyed(docs).agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else []
    edges = sorted(set(edges or []))  # fewer than n_parts numbers
    placed = C.keyed(docs).mapInArrow(_place(edges), "doc_id bigint, id bigint, h bigint, text string, part bigint")
    # the greatest key of each part, which the part above needs; the greatest of
    # all goes to the least part
    tops = [r for r in placed.groupBy("part").agg(F.max(F.struct("id", "h")).alias("top")).orderBy("part").collect()]  # one row a part
    if not tops:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double" + ", edited string" * with_text)
    above = [(t["top"]["id"], t["top"]["h"], tops[(i + 1) % len(tops)]["part"]) for i, t in enumerate(tops)]
    guests = spark.createDataFrame(above, "id bigint, h bigint, part bigint")
    copies = C.keyed(docs).join(F.broadcast(guests), ["id", "h"]).dropDuplicates(["id", "h", "part"])  # a row a part
    both = placed.select("part", "doc_id", "id", "h", "text", F.lit(True).alias("ours")).unionByName(
        copies.select("part", "doc_id", "id", "h", "text", F.lit(False).alias("ours")))
    # descending inside a part; a guest comes last, also the one from the top
    sorted_ = both.repartition(C.partitions(spark), "part").sortWithinPartitions("part", F.desc("ours"), F.desc("id"), F.desc("h"))
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_.select("part", "doc_id", "text", "ours").mapInArrow(_compare(rank, with_text), schema + ", edited string" * with_text)


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(C.read(spark, sf_dir, "documents"), with_text=False)
