"""Set similarity join of documents' word shingles with set-relation skipping
(operator 6).

A document's set holds the 64-bit hashes of its distinct 5-word shingles.
Tokens are ordered rare first by a sketch of document frequencies counted over
all documents; two sets with a Jaccard similarity of 0.8 or more share a token
of their prefixes in that order.  Every prefix token's index list is sorted by
set size and position.

* Index level: the list is a sequence of blocks of one size; a probe skips
  blocks whose sizes cannot reach the threshold, and inside a block, sorted by
  position, everything behind the last position that still can.
* Answer level: in each of a few rounds every list has a centre, in later rounds a few (the
  least sets of its commonest group, by a hash that is the same everywhere, so that lists of
  the same sets choose the same ones) and a set is compared with the centres of another group that it
  meets most: at most ``WIDTHS`` comparisons a set and round, however large its group.  What
  links joins groups.  At last pairs whose sets lie in different groups are left: the lists
  that have such get the sketches of their sets, and a pair leaves its list only if these
  do not exclude that it links.  Their overlaps are derived from the centre's answers:
  ``|x & y| = |c & y| - |(c - x) & y| + |(x - c) & y|``, where ``|c & y|`` is
  counted once for all ``x`` that resemble ``c``, and ``c - x`` and ``x - c``, found when
  ``x`` and ``c`` were compared, are small.

A pair in one group is never needed, every other candidate pair is decided
exactly; components are found once, over all links.  Before sets travel, their sketches (256 counts) bound each pair's overlap.  Equal
sets are one: a task sends a set's tokens once, and a list keeps one of those with the same 128-bit signature.
Sets are never gathered: a centre's rows come sorted, the centre first, and
the others stream past it, in parts where there are many.

Defined results: A-Z are lower-cased; fewer than 5 words are one shingle; no
words or null text: an empty set, linked with nothing; null ids get a number
after all others (``common``); several texts under one ``doc_id`` are several
documents, each compared and linked for itself, and the component's id is the least
``doc_id`` in it; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import common as C
from editpulse.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
#: Counters of the frequency sketch: a fixed size, whatever the input's.
SLOT_BITS = 20
SLICE_SLOTS = 1 << 14
#: With how many sets of one other group a set is compared, round by round: in a group
#: where a pair in five links, 21 comparisons leave a set in a hundred outside.
WIDTHS = (1, 4, 16)
#: Members of a centre in one part, about.
PART_SETS = 2_000
#: Entries of index lists in one row, about (a list is never cut).
ROW_ENTRIES = 1 << 18
#: Ids of documents whose ``doc_id`` has several texts lie below this.
OWN_IDS = -(1 << 62)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS):
    """The sorted distinct shingle hashes of each text."""
    data = _LOWER[data]
    start, end, first = C.words_of(data, offsets)
    tokens = C.word_hashes(data, start, end)
    all_grams = C.grams(tokens, k)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            own = np.sort(all_grams[a:b - k + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            yield C.grams(np.append(tokens[a:b], C.U(b - a)), int(b - a + 1))
        else:
            yield all_grams[:0]


def _each_set(batch, k):
    data, offsets = C.buffers(batch["text"])
    for i, j in C.slices(offsets):
        yield from zip(range(i, j), sets_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k))


def _survey(k: int):
    """Per document its size and signature, and per task the sketch of frequencies."""
    schema = pa.schema([("doc_id", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])

    def survey(batches):
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            n, s1, s2 = (np.zeros(len(batch), t) for t in (np.int64, np.uint64, np.uint64))
            found, held = [], 0
            for i, own in _each_set(batch, k):
                n[i], s1[i], s2[i] = len(own), own.sum(), C.mixed(own).sum()
                found.append(own >> C.U(64 - SLOT_BITS))
                held += len(own)
                if held > 1 << 20:
                    counts += np.bincount(np.concatenate(found).astype(np.int64), minlength=len(counts))
                    found, held = [], 0
            if held:
                counts += np.bincount(np.concatenate(found).astype(np.int64), minlength=len(counts))
            if len(batch):
                none = pa.nulls(len(batch))
                yield C.table(schema, batch["doc_id"], batch["id"], batch["h"], n, C.mixed(s1).view(np.int64), C.mixed(s2).view(np.int64), none.cast(pa.int32()), none.cast(pa.binary()))
        if counts.any():
            slices = counts.reshape(-1, SLICE_SLOTS)
            none = pa.nulls(len(slices), pa.int64())
            yield C.table(schema, none, none, none, none, none, none, np.arange(len(slices), dtype=np.int32), [s.tobytes() for s in slices])

    return survey


def _sum_slices(batches):
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])
    for key, rows in C.by_key(batches, "slice"):
        yield C.table(schema, [key], [sum(np.frombuffer(r["counts"], np.int64) for r in rows).tobytes()])


def prefix_length(n, percent: int):
    """Tokens of which a set shares one with any set as similar as asked for."""
    return n + (percent * n) // -100 + 1


def _entries(frequency, k: int, percent: int, n_buckets: int):
    """Prefix tokens dealt out by hash: each with its set's number, and position.
    Of equal sets a task sends the first one's."""
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def entries(batches):
        df, seen = frequency.value, set()
        for batch in batches:
            ids = batch["id"].to_numpy()
            token, doc, pos, sig, size = [], [], [], np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.int64)
            for i, own in _each_set(batch, k):
                n = len(own)
                key = n, int(own.sum()), int(C.mixed(own).sum())
                if n and key not in seen:
                    seen.add(key)
                    p = int(prefix_length(n, percent))
                    rare = np.argsort(df[(own >> C.U(64 - SLOT_BITS)).astype(np.int64)], kind="stable")[:p]
                    token.append(own[rare])
                    doc.append(np.full(p, i, np.int64))
                    pos.append(np.arange(p))
                    sig[i], size[i] = C.mixed(own ^ C.MIX1).sum(), n
            if not token:
                continue
            token, doc, pos = (np.concatenate(x) for x in (token, doc, pos))
            bucket = (token % C.U(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                at = order[edges[b]:edges[b + 1]]
                own, number = np.unique(doc[at], return_inverse=True)
                rows.append((int(b), C.pack(ids[own], sig[own], C.narrow(size[own]), token[at], C.narrow(number), C.narrow(pos[at]))))
            yield C.table(schema, *zip(*rows))

    return entries


def _lists(percent: int):
    """Index lists of two or more different sets (the least id of each), packed: the
    lists' lengths, ids, sizes and positions."""
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def lists(batches):
        for bucket, rows in C.by_key(batches):
            parts = [C.unpack(r["blob"]) for r in rows]
            token = np.concatenate([p[3] for p in parts])
            ids, sig, n = (np.concatenate([p[c][p[4]] for p in parts]) for c in range(3))
            pos = np.concatenate([p[5] for p in parts])
            del parts
            order = np.argsort(token, kind="stable")
            new = np.append(True, token[order[1:]] != token[order[:-1]])
            count = np.diff(np.append(np.flatnonzero(new), len(order)))
            order = order[np.repeat(count > 1, count)]
            order = order[np.lexsort((ids[order], sig[order], n[order], token[order]))]
            token, ids, sig, n, pos = (a[order] for a in (token, ids, sig, n.astype(np.int64), pos.astype(np.int64)))
            if not len(token):
                continue
            keep = np.append(True, (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (sig[1:] != sig[:-1]))
            for _ in range(3):  # sets that lose their partners leave in turn
                token, ids, n, pos = (a[keep] for a in (token, ids, n, pos))
                keep = _has_partner(token, n, pos, percent)
            token, ids, n, pos = (a[keep] for a in (token, ids, n, pos))
            first = np.flatnonzero(np.append(len(token) > 0, token[1:] != token[:-1]))
            length = np.diff(np.append(first, len(token)))
            row = first // ROW_ENTRIES
            for k in np.unique(row):
                of = np.flatnonzero(row == k)
                at = slice(int(first[of[0]]), int(first[of[-1]] + length[of[-1]]))
                yield C.table(schema, [bucket], [C.pack(C.narrow(length[of]), ids[at], C.narrow(n[at]), C.narrow(pos[at]))])

    return lists


def _has_partner(token, n, pos, percent: int) -> np.ndarray:
    """Which sets may link to some set of their list: one of a fitting size, with
    tokens enough behind this one for the smallest such.  Sorted by token, size."""
    if not len(token):
        return np.zeros(0, bool)
    number = np.cumsum(np.append(0, token[1:] != token[:-1]))
    key = (number << 32) + n
    me = np.arange(len(n))
    low = np.searchsorted(key, (number << 32) + -(-percent * n // 100))
    above = np.minimum(me + 1, len(n) - 1)
    fits = (above > me) & (number[above] == number) & (percent * n[above] <= 100 * n)
    partner = np.where(low < me, low, above)
    need = -(-percent * (n + n[partner]) // (100 + percent))
    return ((low < me) | fits) & (n - pos >= need)


#: Counters of a set's sketch (its members by their first byte).
SKETCH = 256
#: Sketches compared with one at once.
SKETCHES = 1 << 13


def _sets(k: int):
    """Each set with its size and sketch (empty if a counter is too small for it)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("own", pa.binary())])

    def sets(batches):
        for batch in batches:
            ids, out = batch["id"].to_numpy(), []
            for i, own in _each_set(batch, k):
                counts = np.bincount((own >> C.U(56)).astype(np.int64), minlength=SKETCH)
                out.append((int(ids[i]), len(own), counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"", own.tobytes()))
                if len(out) == 2000:
                    yield C.table(schema, *zip(*out))
                    out = []
            if out:
                yield C.table(schema, *zip(*out))

    return sets


def _cells(column) -> np.ndarray:
    """A column of sketches, one a row; one that is empty has the largest counts."""
    data, offsets = C.buffers(column)
    cells = np.full((len(column), SKETCH), 255, np.uint8)
    cells[np.diff(offsets) > 0] = data.reshape(-1, SKETCH)
    return cells


def may_link(one: np.ndarray, two: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with sketches ``one`` and ``two`` and ``n`` members together can be
    as similar as asked for (two empty sketches tell nothing)."""
    most = np.minimum(one, two).sum(axis=1, dtype=np.int64)
    return (100 * most >= percent * (n - most)) | (most == 255 * SKETCH)


def _bounded(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bounded(batches):
        for batch in batches:
            if not len(batch):
                continue
            n = batch["na"].to_numpy() + batch["nb"].to_numpy()
            keep = may_link(_cells(batch["sa"]), _cells(batch["sb"]), n, percent)
            yield C.table(schema, *(batch[c].filter(pa.array(keep)) for c in ("a", "b")))

    return bounded


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (two columns of ids) that may link: two sets have at most the lesser
    of their counts in common in each cell of their sketches.  Sketches travel for
    it, and only what is left asks for the sets."""
    first, second = pairs.columns
    own = sets.select("id", "n", "sketch")
    met = pairs.toDF("a", "b").join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    return met.mapInArrow(_bounded(percent), "a bigint, b bigint").toDF(first, second)


def probes(n: np.ndarray, pos: np.ndarray, group: np.ndarray, percent: int):
    """Pairs ``(i, j)`` of a list's sets, in different groups, that can be as
    similar as asked for and first meet at this token."""
    for i, found in each_probe(n, pos, group, percent):
        yield from ((i, j) for j in found)


def each_probe(n: np.ndarray, pos: np.ndarray, group: np.ndarray, percent: int):
    """``probes``, each probing set ``i`` once, with all its ``j``.

    The list is sorted by size, then position, so sizes form blocks.  A probe
    ``i`` skips the blocks of sizes too small or too large for it, and takes of
    the others those positions that leave tokens enough.  Sets of the list's
    commonest group need not probe: all their pairs are found from outside."""
    order = np.lexsort((pos, n))
    n, pos, group = n[order].astype(np.int64), pos[order].astype(np.int64), group[order]
    first = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
    last = np.append(first[1:], len(n))
    sizes = n[first]
    roots, at, count = np.unique(group, return_inverse=True, return_counts=True)
    common = at == count.argmax()
    for i in np.flatnonzero(~common):
        low, high = np.searchsorted(100 * sizes, percent * n[i]), np.searchsorted(percent * sizes, 100 * n[i], "right")
        found = []
        for b in range(low, high):
            need = -((-percent * (n[i] + sizes[b])) // (100 + percent))
            if n[i] - pos[i] < need:
                continue
            j = np.arange(first[b], first[b] + np.searchsorted(pos[first[b]:last[b]], sizes[b] - need, "right"))
            found.append(j[(group[j] != group[i]) & (common[j] | (j > i))])
        if found:
            yield order[i], order[np.concatenate(found)]


def _priority(ids: np.ndarray, round_: int) -> np.ndarray:
    """The same order of sets in every list, another one each round."""
    return C.mixed(ids.view(np.uint64) + C.U((round_ + 1) * int(C.MIX2) & (1 << 64) - 1))


def _best_first(ids: np.ndarray, centers: np.ndarray, groups: np.ndarray, round_: int):
    """Of each of the distinct ``ids`` the centres that come most often, then those whose
    group has the least priority, at most the round's width (itself if there is no other),
    and their groups; sorted by id."""
    order = np.lexsort((centers, ids))
    ids, centers, groups = ids[order], centers[order], groups[order]
    first = np.flatnonzero(np.append(len(ids) > 0, (ids[1:] != ids[:-1]) | (centers[1:] != centers[:-1])))
    often = np.diff(np.append(first, len(ids)))
    ids, centers, groups = ids[first], centers[first], groups[first]
    often[centers == ids] = 0
    order = np.lexsort((centers, _priority(groups, round_), -often, ids))
    ids, centers, groups = ids[order], centers[order], groups[order]
    first = np.flatnonzero(np.append(len(ids) > 0, ids[1:] != ids[:-1]))
    place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    keep = (place == 0) | ((place < WIDTHS[round_]) & (centers != ids))
    return ids[keep], centers[keep], groups[keep]


def _lists_with_groups(batches):
    """Each row's bucket, lists (lengths, ids, sizes, positions) and the group of each
    id.  A bucket's groups come before its lists; without, a set is its own group."""
    of, labels, known = None, [], None
    for batch in batches:
        for bucket, kind, blob in zip(batch["bucket"].to_pylist(), batch["kind"].to_pylist(), batch["blob"]):
            if bucket != of:
                of, labels, known = bucket, [], None
            if kind == 0:
                labels.append(C.unpack(blob.as_py()))
                continue
            if labels:
                known, root = (np.concatenate(x) for x in zip(*labels))
                order = np.argsort(known)
                known, root, labels = known[order], root[order], []
            length, ids, n, pos = C.unpack(blob.as_py())
            yield bucket, length.astype(np.int64), ids, n.astype(np.int64), pos, ids if known is None else root[np.searchsorted(known, ids)]


def _commonest(number: np.ndarray, group: np.ndarray, round_: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each list the group with most of its sets (of several the least by the round's
    order), and how many; ``number`` is that of each set's list."""
    order = np.lexsort((group, number))
    first = np.flatnonzero(np.append(True, (number[order[1:]] != number[order[:-1]]) | (group[order[1:]] != group[order[:-1]])))
    count = np.diff(np.append(first, len(order)))
    of, root = number[order[first]], group[order[first]]
    best = np.lexsort((_priority(root, round_), -count, of))
    best = best[np.append(True, of[best[1:]] != of[best[:-1]])]
    return root[best], count[best]


def _stars(percent: int, n_buckets: int, round_: int):
    """For each set of each row of lists the centres of the lists' commonest groups
    (itself, if those are its own), dealt out by set; with the lists' bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def stars(batches):
        for bucket, length, ids, n, _, group in _lists_with_groups(batches):
            first, number = np.cumsum(length) - length, np.repeat(np.arange(len(length)), length)
            chosen, held = _commonest(number, group, round_)
            order = np.lexsort((_priority(ids, round_), group != chosen[number], number))
            met = [(ids, ids, group)]
            at = np.flatnonzero(group != chosen[number])
            for k in range(WIDTHS[round_]):  # sets of the list's commonest group, one after the other
                at = at[held[number[at]] > k]
                center = order[first[number[at]] + k]
                fits = 100 * np.minimum(n[at], n[center]) >= percent * np.maximum(n[at], n[center])
                met.append((ids[at[fits]], ids[center[fits]], group[center[fits]]))
            own, *least = _best_first(*map(np.concatenate, zip(*met)), round_)
            part = (C.mixed(own.view(np.uint64)) % C.U(n_buckets)).astype(np.int32)
            yield C.table(schema, *zip(*C.dealt(part, n_buckets, own, *least, np.full(len(own), bucket, np.int32))))

    return stars


def _picks(round_: int):
    """Each set with its centres, and the buckets where it has lists."""
    schema = pa.schema([("id", pa.int64()), ("centers", pa.list_(pa.int64())), ("buckets", pa.binary())])

    def picks(batches):
        for _, rows in C.by_key(batches):
            ids, *found, bucket = C.joined(rows)
            each, center, _ = _best_first(ids, *found, round_)
            own, first = np.unique(each, return_index=True)
            first = np.append(first, len(each))
            order = np.lexsort((bucket, ids))
            edges = np.append(np.searchsorted(ids[order], own), len(ids))
            bucket = bucket[order]
            for i in range(0, len(own), 4096):
                j = min(i + 4096, len(own))
                centers = [[c for c in center[first[k]:first[k + 1]].tolist() if c != own[k]] for k in range(i, j)]
                yield C.table(schema, own[i:j], centers, [np.unique(bucket[edges[k]:edges[k + 1]]).tobytes() for k in range(i, j)])

    return picks


def _dealt_rows(batch, n_buckets: int):
    """The batch's rows dealt out to the buckets where their sets have lists."""
    data, offsets = C.buffers(batch["buckets"])
    at = np.repeat(np.arange(len(batch)), np.diff(offsets) // 4)
    for b, blob in C.dealt(np.frombuffer(data.tobytes(), np.int32), n_buckets, at):
        yield b, C.unpack(blob)[0]


def _labels(n_buckets: int):
    """Each set's group, dealt out to the buckets where it has lists."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])

    def labels(batches):
        for batch in batches:
            ids, root = batch["id"].to_numpy(), batch["root"].to_numpy()
            out = [(b, 0, C.pack(ids[at], root[at])) for b, at in _dealt_rows(batch, n_buckets)]
            if out:
                yield C.table(schema, *zip(*out))

    return labels


def _mixed(batches):
    """The lists whose sets lie in different groups, packed: the lists' lengths, ids,
    sizes, positions and groups."""
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    for bucket, length, ids, n, pos, group in _lists_with_groups(batches):
        first = np.cumsum(length) - length
        several = np.minimum.reduceat(group, first) != np.maximum.reduceat(group, first)
        at = np.repeat(several, length)
        if several.any():
            yield C.table(schema, [bucket], [C.pack(C.narrow(length[several]), ids[at], C.narrow(n[at]), C.narrow(pos[at]), group[at])])


def _members(batches):
    """The sets of lists."""
    for batch in batches:
        if len(batch):
            yield C.table(pa.schema([("id", pa.int64())]), np.unique(np.concatenate([C.unpack(blob.as_py())[1] for blob in batch["blob"]])))


def _sketches(n_buckets: int):
    """Each set's sketch, dealt out to the buckets where it has lists."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])

    def sketches(batches):
        for batch in batches:
            ids, cells = batch["id"].to_numpy(), _cells(batch["sketch"])
            for b, at in _dealt_rows(batch, n_buckets):
                yield C.table(schema, [b], [0], [C.pack(ids[at], cells[at].ravel())])

    return sketches


def _lists_with_sketches(batches):
    """Each row's lists (lengths, ids, sizes, positions, groups), the bucket's sketches and
    the row of each id there.  A bucket's sketches come before its lists."""
    of, parts, known, cells = None, [], None, None
    for batch in batches:
        for bucket, kind, blob in zip(batch["bucket"].to_pylist(), batch["kind"].to_pylist(), batch["blob"]):
            if bucket != of:
                of, parts, known, cells = bucket, [], None, None
            if kind == 0:
                parts.append(C.unpack(blob.as_py()))
                continue
            if parts:
                known, cells = (np.concatenate(x) for x in zip(*parts))
                order, parts = np.argsort(known), []
                known, cells = known[order], cells.reshape(-1, SKETCH)[order]
            length, ids, n, pos, group = C.unpack(blob.as_py())
            yield length.astype(np.int64), ids, n.astype(np.int64), pos.astype(np.int64), group, cells, np.searchsorted(known, ids)


def _across(percent: int):
    """Candidate pairs of each list whose sets lie in different groups, and whose
    sketches leave that they link."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def across(batches):
        out, held = [], 0
        for length, ids, n, pos, group, cells, row in _lists_with_sketches(batches):
            for a, k in zip(np.cumsum(length) - length, length):
                at = slice(a, a + k)
                for i, others in each_probe(n[at], pos[at], group[at], percent):
                    for part in range(0, len(others), SKETCHES):
                        j = a + others[part:part + SKETCHES]
                        j = j[may_link(cells[row[a + i]], cells[row[j]], n[a + i] + n[j], percent)]
                        out.append(np.stack([np.minimum(ids[a + i], ids[j]), np.maximum(ids[a + i], ids[j])], axis=1))
                        held += len(j)
                    if held >= 200_000 or len(out) >= 200_000:  # a pair that meets in several lists leaves once
                        yield C.table(schema, *np.unique(np.concatenate(out), axis=0).T)
                        out, held = [], 0
        if held:
            yield C.table(schema, *np.unique(np.concatenate(out), axis=0).T)

    return across


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def _linked(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def _compare(percent: int):
    """Links of a centre with the sets that stream past it, and what differs."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("lost", pa.binary()), ("gained", pa.binary())])

    def compare(batches):
        c = center = None
        for batch in batches:
            out = []
            for kind, u, v, own in zip(batch["kind"].to_pylist(), batch["center"].to_pylist(), batch["id"].to_pylist(), batch["own"]):
                own = np.frombuffer(own.as_py(), np.uint64)
                if kind == 0:
                    c, center = u, own
                    continue
                assert c == u, "sets without their centre"
                common = overlap(center, own)
                if _linked(common, len(center), len(own), percent):
                    out.append((u, v, np.setdiff1d(center, own, True).tobytes(), np.setdiff1d(own, center, True).tobytes()))
            if out:
                yield C.table(schema, *zip(*out))

    return compare


def _derive(percent: int):
    """Links of sets ``y`` with those that resemble a centre: the centre (kind 0), the
    differences of its sets (1), then each ``y`` with the numbers of those to compare (2)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def derive(batches):
        c = center = None
        for batch in batches:
            out = []
            for kind, u, v, own, gained, xs in zip(*(batch[k].to_pylist() for k in ("kind", "center", "id", "own", "gained", "xs"))):
                if kind == 0:
                    c, center, differs = u, np.frombuffer(own, np.uint64), {}
                    differs[u] = center[:0], center[:0]
                    continue
                assert c == u, "sets without their centre"
                if kind == 1:
                    differs[v] = np.frombuffer(own, np.uint64), np.frombuffer(gained, np.uint64)
                    continue
                y = np.frombuffer(own, np.uint64)
                common = overlap(center, y)
                for x in xs:
                    lost, more = differs[x]
                    n = len(center) - len(lost) + len(more)
                    if _linked(common - overlap(lost, y) + overlap(more, y), n, len(y), percent):
                        out.append((x, v))
                        break  # all of them link to the centre: one link joins them
            if out:
                yield C.table(schema, *zip(*out))

    return derive


def _parted(pairs: DataFrame, of: str) -> DataFrame:
    """``pairs`` with the part of their centre that ``of`` falls in: as many as its sets
    ``of`` ask for."""
    sizes = pairs.select("center", of).distinct().groupBy("center").agg(F.ceil(F.count("*") / PART_SETS).cast("bigint").alias("parts")).where("parts > 1")
    return pairs.join(sizes, "center", "left").withColumn("part", F.pmod(F.xxhash64(of), F.coalesce("parts", F.lit(1)))).drop("parts")


def _joined_groups(groups: DataFrame, links: DataFrame, round_: int) -> DataFrame:
    """``groups (id, buckets, root)`` after the round's ``links (u, v)`` of centres ``u``:
    of two linked groups the one with fewer sets (of equal ones that of ``v``) goes to the
    other, each to the largest that it links to; followed twice.  Equal roots are one
    component; a component may have several (in a circle of equal groups roots only
    change places)."""
    root_of = groups.select("id", "root")
    met = links.join(root_of.toDF("u", "up"), "u").join(root_of.toDF("v", "at"), "v").where("at <> up").select("at", "up").distinct()
    met = met.withColumn("size", F.lit(1))
    if round_:  # before, each group is one set
        size = groups.groupBy("root").agg(F.count("*").alias("size"))
        met = met.drop("size").join(size.toDF("at", "m"), "at").join(size.toDF("up", "n"), "up")
        met = met.select(*(F.when(F.col("m") > F.col("n"), F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("up", "at", "at"), ("at", "up", "up"))),
                         F.greatest("m", "n").alias("size"))
    up = C.staged(groups.sparkSession, met.groupBy("at").agg(F.max_by("up", F.struct("size", "up")).alias("up")), "set-steps")
    for i in range(2):
        step = up.select(F.col("at").alias(f"at{i}"), F.col("up").alias(f"up{i}"))
        groups = groups.join(step, F.col("root") == F.col(f"at{i}"), "left").select("id", "buckets", F.coalesce(f"up{i}", "root").alias("root"))
    return groups


def _with_centers(parts: DataFrame, rows: DataFrame, sets: DataFrame, n: int, *columns: str) -> DataFrame:
    """``rows`` by part of their centre, whose own set comes first; ``parts`` has all
    centres and parts (what makes the rows is not in the plan a second time)."""
    centers = parts.select("center", "part").distinct().join(sets.select(F.col("id").alias("center"), "own"), "center")
    centers = centers.select("center", "part", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"), "own")
    both = centers.unionByName(rows, allowMissingColumns=True).select("center", "part", "kind", "id", "own", *columns)
    return both.repartition(n, "center", "part").sortWithinPartitions("center", "part", "kind")


def star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``u, v, lost, gained`` of the pairs ``(center, id)`` that link."""
    n = C.partitions(pairs.sparkSession)
    met = _parted(pairs, "id")
    rows = met.join(sets.select("id", "own"), "id").select("center", "part", F.lit(1).alias("kind"), "id", "own")
    return _with_centers(met, rows, sets, n).mapInArrow(_compare(percent), "u bigint, v bigint, lost binary, gained binary")


def derived_links(pairs: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``u, v`` of the pairs ``(x, y)`` that link, by the answers of the centre that
    ``links`` gives ``x`` (itself if it has none); of a centre's ``x`` in one part, which
    all link to it, the first for each ``y``."""
    n = C.partitions(pairs.sparkSession)
    of = links.groupBy(F.col("v").alias("x")).agg(F.min_by(F.struct("u", "lost", "gained"), "u").alias("c"))
    first = links.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("u"))
    met = pairs.join(first, "x", "left").select(F.coalesce("u", "x").alias("center"), "x", "y")
    met = C.staged(pairs.sparkSession, met, "set-met")  # four times in the plan of what follows
    met = C.staged(pairs.sparkSession, _parted(met, "x"), "set-parted")
    differs = met.where("center <> x").select("center", "part", "x").distinct().join(of, "x")
    differs = differs.select("center", "part", F.lit(1).alias("kind"), F.col("x").alias("id"), F.col("c.lost").alias("own"), F.col("c.gained").alias("gained"))
    asked = met.groupBy("center", "part", "y").agg(F.collect_list("x").alias("xs")).join(sets.select(F.col("id").alias("y"), "own"), "y")
    asked = asked.select("center", "part", F.lit(2).alias("kind"), F.col("y").alias("id"), "own", "xs")
    rows = differs.unionByName(asked, allowMissingColumns=True)
    return _with_centers(met, rows, sets, n, "gained", "xs").mapInArrow(_derive(percent), "u bigint, v bigint")


def similar_groups(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id``."""
    return groups_of(C.keyed(docs), percent, k).select("doc_id", "n_shingles", "component_id")


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """The rows, with all their columns, of each group's first document (least id,
    then least hash of the text); of a row given several times one.  Texts without
    words are in no group and stay, and so do different texts under one id
    that are no near copies."""
    rows = C.keyed(docs, rest=True)
    found = groups_of(rows, percent, k).where("n_shingles > 0").select("root", "id", "h").distinct()
    first = found.groupBy("root").agg(F.min(F.struct("id", "h")).alias("first"))
    gone = found.join(first, "root").where(F.struct("id", "h") != F.col("first")).select("id", "h")
    kept = rows.join(gone, ["id", "h"], "left_anti")
    kept = kept.withColumn("copy", F.row_number().over(Window.partitionBy("id", "h").orderBy("h"))).where("copy = 1")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns])


def _own_ids(survey: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``survey`` and ``rows`` with a ``node``: ``id``, or a number of its own for each
    text of an id that has several."""
    spark = survey.sparkSession
    several = survey.where("slice is null").groupBy("id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("id")
    texts = C.staged(spark, survey.where("slice is null").join(several, "id").select("id", "h").distinct()
                     .withColumn("own", F.lit(OWN_IDS) - F.monotonically_increasing_id()), "set-ids")
    if texts.isEmpty():
        return survey.withColumn("node", F.col("id")), rows.withColumn("node", F.col("id"))
    named = lambda df: df.join(texts, ["id", "h"], "left").withColumn("node", F.coalesce("own", "id")).drop("own")
    return named(survey), named(rows)


def groups_of(rows: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, id, h, n_shingles, root, component_id`` of ``common.keyed`` rows;
    documents of one component have one ``root``."""
    spark, rows = rows.sparkSession, rows.select("doc_id", "id", "h", "text")
    n = C.partitions(spark)
    survey = C.staged(spark, rows.mapInArrow(
        _survey(k), "doc_id bigint, id bigint, h bigint, n bigint, s1 bigint, s2 bigint, slice int, counts binary"), "set-survey")
    slices = survey.where("slice is not null").select("slice", "counts").repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(_sum_slices, "slice int, counts binary")
    frequency = np.zeros((1 << SLOT_BITS) // SLICE_SLOTS * SLICE_SLOTS, np.int64).reshape(-1, SLICE_SLOTS)
    for r in slices.collect():  # 2**20 counters, whatever the input's size
        frequency[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    frequency = spark.sparkContext.broadcast(np.minimum(frequency.ravel(), (1 << 32) - 1).astype(np.uint32))
    known, rows = _own_ids(survey, rows)
    known = known.where("slice is null")

    lists = C.staged(spark, rows.select(F.col("node").alias("id"), "text").mapInArrow(_entries(frequency, k, percent, n), "bucket int, blob binary")
                     .repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_lists(percent), "bucket int, blob binary"), "set-lists")
    lists = lists.select("bucket", F.lit(1).alias("kind"), "blob")

    def grouped_lists(groups):
        labels = groups.mapInArrow(_labels(n), "bucket int, kind int, blob binary")
        return labels.unionByName(lists).repartition(n, "bucket").sortWithinPartitions("bucket", "kind")

    met, groups, sets, links = lists, None, None, None
    for round_ in range(len(WIDTHS)):
        picks = met.mapInArrow(_stars(percent, n, round_), "bucket int, blob binary").repartition(n, "bucket").sortWithinPartitions("bucket")
        picks = C.staged(spark, picks.mapInArrow(_picks(round_), "id bigint, centers array<bigint>, buckets binary"), "set-picks")
        if groups is None:
            groups = picks.select("id", "buckets", F.col("id").alias("root"))
            least = rows.select(F.col("node").alias("id"), "text").join(groups.select("id"), "id")
            sets = C.staged(spark, least.mapInArrow(_sets(k), "id bigint, n bigint, sketch binary, own binary").dropDuplicates(["id"]), "sets")
        asked = C.staged(spark, plausible(picks.select(F.explode("centers").alias("center"), "id"), sets, percent), "set-asked")
        new = C.staged(spark, star_links(asked, sets, percent), "set-links")
        links = new if links is None else links.unionByName(new)
        groups = C.staged(spark, _joined_groups(groups, new, round_), "set-groups")
        met = grouped_lists(groups)
    mixed = C.staged(spark, met.mapInArrow(_mixed, "bucket int, blob binary"), "set-mixed")
    asked = mixed.mapInArrow(_members, "id bigint").distinct()
    sketches = groups.select("id", "buckets").join(asked, "id").join(sets.select("id", "sketch"), "id").mapInArrow(_sketches(n), "bucket int, kind int, blob binary")
    met = sketches.unionByName(mixed.withColumn("kind", F.lit(1))).repartition(n, "bucket").sortWithinPartitions("bucket", "kind")
    pairs = C.staged(spark, met.mapInArrow(_across(percent), "x bigint, y bigint").distinct(), "set-pairs")
    more = C.staged(spark, derived_links(pairs, links, sets, percent), "set-derived")

    copies = known.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v <> w").drop("w")
    copies = known.join(copies, ["s1", "s2", "n"]).select(F.col("node").alias("u"), "v").where("u <> v")
    final = components(copies.unionByName(links.select("u", "v")).unionByName(more))
    own = known.join(final.withColumnRenamed("v", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    component = F.col("root")
    if known.where(F.col("node") <= OWN_IDS).limit(1).count():  # a root may be no doc_id
        own = own.join(own.groupBy("root").agg(F.min("id").alias("least")), "root")
        component = F.col("least")
    return own.select("doc_id", "id", "h", F.col("n").alias("n_shingles"), "root", component.alias("component_id"))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_groups(C.read(spark, sf_dir, "documents"))
